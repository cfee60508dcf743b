"""Substring dedup by difference-cover anchors.

Windows are ``width`` consecutive words of one document. COVER is a set of
residues modulo PERIOD in which every difference occurs, so for any two
positions there is a shift below PERIOD that takes both to cover positions: two
equal windows share an anchor, ``width - PERIOD + 1`` words that begin at a
cover position of either document. Only anchors (len(COVER) / PERIOD of all positions) are hashed and shuffled:

1. whole copies of a smaller document (exact_dedup) are set aside: all their
   windows start there too;
2. anchors are dealt by hash and sorted; runs that hold two documents are shared;
3. each document's shared positions are joined to its text, and the match is
   extended: all windows that hold such an anchor are hashed (96 bits), which
   settles equality of the whole window;
4. windows are dealt by hash and sorted by document; those after the run's
   smallest document are repeats;
5. the words that repeats cover are removed.

Hot groups: anchors that are frequent in a sample of the documents (a hint for
dealing alone; at most HEAVY of them are broadcast) are taken as shared and
dealt by document. Windows that hold one of them at any of their PERIOD offsets
(so whether a window does depends on its own words alone, not on where its
document's cover positions fall) are dealt by hash and document, into SALTS runs
a hash, and only the smallest document of each of these runs goes on to a second
round. Runs are streamed, never held. No pair of documents is formed.

Windows are judged on the input. Nulls and ties: null text has no words; a row
with a null id is left whole and takes nothing from others; rows that share an
id are one document to each other (neither takes from the other; each keeps its
own text). Texts of
fewer than ``width`` words stay whole. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.exact_dedup import exact_dedup, normalised
from sifter.llm.words import blocks, span_hashes, spans, text_bytes, window_hashes
from sifter.session import checkpoint_dir

WIDTH = 50
#: A perfect difference set: fixed values.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
#: One in SAMPLE documents shows which anchors are frequent: those with FREQUENT rows there.
SAMPLE, FREQUENT, HEAVY, SALTS = 16, 8, 50_000, 64
_SECOND = 0xD6E8FEB86659FD93
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts(batch: pa.RecordBatch):
    """(first row, end, word hashes, first word of each row) of blocks of rows.
    Rows that are copies or have no id have no words here."""
    text = batch["text"]
    if "copy" in batch.schema.names:
        skip = pc.or_(pc.fill_null(batch["copy"], False), pc.is_null(batch["doc_id"]))
        text = pc.if_else(skip, pa.scalar(None, text.type), text)
    data, offsets = text_bytes(text)
    for a, b in blocks(offsets):
        part = data[offsets[a]:offsets[b]]
        starts, ends, first = spans(part, offsets[a:b + 1] - offsets[a])
        yield a, b, span_hashes(part, starts, ends) if len(starts) else np.zeros(0, np.uint64), first


def _anchors(width: int):
    """(anchor, doc_id, pos) of all anchors."""
    size, cover = width - PERIOD + 1, np.isin(np.arange(PERIOD), COVER)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, words, first in _texts(batch):
                n = np.diff(first)
                within = np.arange(len(words)) - np.repeat(first[:-1], n)
                long = np.repeat(n, n)
                at = np.flatnonzero(cover[within % PERIOD] & (within + size <= long) & (long >= width))
                if len(at):
                    h = window_hashes(words, at, size) >> np.uint64(16)  # 48 bits: candidates alone depend on them
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch["doc_id"].take(pa.array(np.repeat(np.arange(a, b), n)[at])),
                                                      pa.array(within[at].astype(np.int32))], names=["anchor", "doc_id", "pos"])

    return found


def _runs(keys: list[np.ndarray]) -> np.ndarray:
    """Whether each row begins a run of equal keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (heavy, anchor, doc_id, pos), where heavy anchors and anchors in two documents are."""
    held = None  # rows of the run the last batch broke off in, as far as they are undecided (one document's)
    for batch in batches:
        heavy = batch["heavy"].to_numpy(zero_copy_only=False)
        a, d, p = (batch[c].to_numpy() for c in ("anchor", "doc_id", "pos"))
        more = False
        if held is not None:
            heavy, a, d, p = (np.concatenate([x, y]) for x, y in zip(held[0], (heavy, a, d, p), strict=True))
            more = held[1]
        run = np.cumsum(_runs([heavy, a])) - 1
        two = np.zeros(run[-1] + 1, bool)
        two[run[1:][(d[1:] != d[:-1]) & (run[1:] == run[:-1])]] = True
        if more:
            two[0] = True
        ok = two[run] | heavy
        open_ = run == run[-1]
        if not ok[-1]:
            held = ((heavy[open_], a[open_], d[open_], p[open_]), False)
        else:  # its rows are out; one stays to know the run by, marked as known
            held = ((heavy[-1:], a[-1:], d[-1:], p[-1:]), True)
        if more:
            ok[0] = False  # the row that was kept to know the run by
        if ok.any():
            yield pa.RecordBatch.from_arrays([pa.array(d[ok]), pa.array(p[ok])], names=["doc_id", "pos"])


def _is_in(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each value is in a sorted array."""
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values if len(of) else np.zeros(len(values), bool)


def _windows(width: int, heavy: np.ndarray):
    """(h1, h2, doc_id, pos, salt) of the windows that hold a shared anchor; salt
    -1 unless one of ``heavy`` (sorted anchors) is in the window, at whatever offset."""
    size = width - PERIOD + 1

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = batch["at"]
            for a, b, words, first in _texts(batch):
                any_ = np.zeros(len(words) + 1, np.int64)
                for row in range(a, b):  # they begin up to PERIOD - 1 words before it
                    lo, hi = first[row - a], first[row - a + 1]
                    at = shared[row].values.to_numpy()
                    at = at[at <= hi - lo - size]  # another row's, where an id repeats
                    if hi - lo < width:
                        continue
                    np.add.at(any_, np.maximum(at + lo - PERIOD + 1, lo), 1)
                    np.add.at(any_, np.minimum(at + lo + 1, hi - width + 1), -1)
                at = np.flatnonzero(np.cumsum(any_) > 0)
                if len(at):
                    row = np.searchsorted(first, at, "right") - 1
                    doc = batch["doc_id"].take(pa.array(row + a))
                    hot = np.zeros(len(words) - size + 2, np.int64)  # how many heavy anchors begin before each word
                    inner = window_hashes(words, np.arange(len(words) - size + 1), size) >> np.uint64(16)
                    np.cumsum(_is_in(inner.view(np.int64), heavy), out=hot[1:])
                    salt = np.where(hot[at + PERIOD] > hot[at], doc.to_numpy() % SALTS, -1)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(window_hashes(words, at, width).view(np.int64)), pa.array(_check(words, at, width)), doc,
                        pa.array((at - first[row]).astype(np.int32)), pa.array(salt.astype(np.int32))], names=["h1", "h2", "doc_id", "pos", "salt"])

    return found


def _check(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    return (window_hashes(words, at, width, _SECOND) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (h1, h2, salt, doc_id, pos), all but those of a run's first
    document; these too, as undecided, where the run is salted."""
    last, least = None, None
    for batch in batches:
        h1, h2, salt, d = (batch[c].to_numpy() for c in ("h1", "h2", "salt", "doc_id"))
        new = _runs([h1, h2, salt])
        if last == (h1[0], h2[0], salt[0]):
            new[0] = False
        starts = np.flatnonzero(new)
        first = np.concatenate([[least if least is not None else d[0]], d[starts]])[np.cumsum(new)]
        last, least = (h1[-1], h2[-1], salt[-1]), first[-1]
        after = d > first
        ok = pa.array(after | (salt >= 0))
        yield pa.RecordBatch.from_arrays([batch[c].filter(ok) for c in ("h1", "h2", "doc_id", "pos")] + [pa.array(after).filter(ok)],
                                         names=["h1", "h2", "doc_id", "pos", "after"])


def _kept(width: int):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_words, n_removed = [], [], []
            for text, doc, copy, gone in zip(batch["text"].to_pylist(), batch["doc_id"], batch["copy"].to_pylist(), batch["gone"], strict=True):
                words = _WORD.findall(text or "")
                n_words.append(len(words))
                if copy and len(words) >= width:
                    words = []
                elif gone.is_valid and doc.is_valid and len(words) >= width:
                    p, h = gone.values.field("pos").to_numpy(), gone.values.field("h2").to_numpy()
                    p, h = p[ok := p <= len(words) - width], h[ok]
                    for _, _, hashes, _ in _texts(pa.RecordBatch.from_pydict({"text": pa.array([text], pa.large_string())})):
                        p = p[_check(hashes, p.astype(np.int64), width) == h]  # not another row's, where an id repeats
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, p, 1)
                    np.add.at(cover, p + width, -1)
                    words = [w for w, s in zip(words, (np.cumsum(cover[:-1]) == 0).tolist(), strict=True) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(" ".join(words))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(kept, pa.string()), pa.array(n_words, pa.int64()),
                                              pa.array(n_removed, pa.int64())], names=["doc_id", "kept", "n_words", "n_removed"])

    return found


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per input row: doc_id, kept (words joined by a space), n_words, n_removed."""
    if width < PERIOD:
        raise ValueError(f"width must be at least {PERIOD}")
    spark = docs.sparkSession
    checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    anchors = "anchor bigint, doc_id bigint, pos int"
    some = d.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).mapInArrow(_anchors(width), anchors)
    heavy = (some.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT)
                 .orderBy(F.desc("n"), "anchor").limit(HEAVY).select("anchor", F.lit(True).alias("is_heavy")).checkpoint())
    hot = np.array(sorted(r["anchor"] for r in heavy.collect()), np.int64)  # at most HEAVY
    # of the text the digest's first 60 bits: tells rows that share an id apart
    key = lambda sha: F.conv(F.substr(sha, F.lit(1), F.lit(15)), 16, 10).cast("bigint")
    copies = (exact_dedup(d).where("keep_id < id").groupBy(F.coalesce("id", F.lit(0)).alias("row"))
                            .agg(F.collect_set(key(F.col("text_sha256"))).alias("keys")))
    # One exchange of the texts, by a column that is never null, serves the three joins below.
    e = d.withColumn("row", F.coalesce("doc_id", F.xxhash64("text"))).withColumn("key", key(F.sha2(normalised(F.col("text")), 256)))
    e = e.join(copies, "row", "left").withColumn("copy", F.array_contains("keys", F.col("key")))

    a = e.select("doc_id", "text", "copy").mapInArrow(_anchors(width), anchors).join(F.broadcast(heavy), "anchor", "left")
    a = a.withColumn("heavy", F.coalesce("is_heavy", F.lit(False))).drop("is_heavy")
    a = a.withColumn("deal", F.when(F.col("heavy"), F.xxhash64("doc_id")).otherwise(F.col("anchor")))
    a = a.repartition(parts, "deal").sortWithinPartitions("heavy", "anchor", "doc_id").select("heavy", "anchor", "doc_id", "pos")
    at = (a.mapInArrow(_shared, "doc_id bigint, pos int").groupBy(F.coalesce("doc_id", F.lit(0)).alias("row"))
           .agg(F.collect_set("pos").alias("at")))

    w = e.join(at, "row").select("doc_id", "text", "copy", "at").mapInArrow(_windows(width, hot), "h1 bigint, h2 int, doc_id bigint, pos int, salt int")
    found = "h1 bigint, h2 int, doc_id bigint, pos int, after boolean"
    dealt = lambda x: x.repartition(parts, "h1", "salt").sortWithinPartitions("h1", "h2", "salt", "doc_id").mapInArrow(_repeats, found)
    one = dealt(w)
    two = dealt(one.where(~F.col("after")).select("h1", "h2", "doc_id", "pos", F.lit(-1).alias("salt")))
    gone = (one.where("after").unionByName(two).groupBy(F.coalesce("doc_id", F.lit(0)).alias("row"))
               .agg(F.collect_set(F.struct("pos", "h2")).alias("gone")))
    return e.join(gone, "row", "left").select("doc_id", "text", "copy", "gone").mapInArrow(
        _kept(width), "doc_id bigint, kept string, n_words bigint, n_removed bigint")
