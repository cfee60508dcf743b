"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A paragraph (a line with other than white space, white runs as one space) is
hashed to a wide vector; a document's fingerprint is the sum of its paragraphs'
vectors. Two sections add side by side:

- EQUAL lanes modulo 2^64: uniform words drawn from the paragraph's BLAKE2b
  digest. Equal multisets of paragraphs agree whatever their order; different
  ones agree with negligible probability.
- LIKE lanes modulo 2^32: a count sketch of the paragraph's three-word
  shingles (every shingle adds +1 or -1 to one lane). Sums of sketches estimate
  the squared distance of shingle counts, from which ``likeness`` follows.

``add`` and ``subtract`` insert and delete a paragraph in a fingerprint without
the document. Likeness lanes count to 2^31 before they wrap, which is more than
one text has shingles, however often it repeats one.

Each text is fingerprinted alone, in its own row: no shuffle (only the
comparison with the next document needs an order). Null text counts as empty; the empty text has the all-zero fingerprint; the likeness of two
empty texts is 1, of an empty and another text 0.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.llm.words import blocks, mixed, span_hashes, spans, text_bytes, window_hashes

EQUAL, LIKE = 16, 128
SHINGLE = 3
_SPACE = re.compile(r"[\x20\x09\x0B-\x0D]+")


def paragraphs(text: str) -> list[str]:
    return [p for line in text.split("\n") if (p := _SPACE.sub(" ", line).strip(" "))]


def _equal(text: str) -> np.ndarray:
    total = np.zeros(EQUAL, np.uint64)
    for p in paragraphs(text):
        raw = p.encode(errors="replace")
        wide = b"".join(hashlib.blake2b(raw, digest_size=64, salt=bytes([k])).digest() for k in range(EQUAL // 8))
        total += np.frombuffer(wide, "<u8")
    return total


def _like(column: pa.Array) -> np.ndarray:
    """LIKE lanes of each text; shingles don't cross lines."""
    data, offsets = text_bytes(column)
    out = np.zeros((len(column), LIKE), np.int64)
    for a, b in blocks(offsets):
        part, at = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        lines = np.union1d(at, np.flatnonzero(part == 10) + 1)
        starts, ends, first = spans(part, lines)
        if not len(starts):
            continue
        words = span_hashes(part, starts, ends)
        n = np.diff(first)
        # lines of fewer words are one shingle
        width = np.minimum(n, SHINGLE)
        many = np.repeat(np.arange(len(n)), np.where(n > 0, n - width + 1, 0))
        within = np.arange(len(many)) - np.repeat(np.cumsum(np.where(n > 0, n - width + 1, 0)) - np.where(n > 0, n - width + 1, 0), np.where(n > 0, n - width + 1, 0))
        begin = first[:-1][many] + within
        full = width[many] == SHINGLE
        h = np.zeros(len(many), np.uint64)
        h[full] = window_hashes(words, begin[full], SHINGLE)
        for w in (1, 2):
            short = width[many] == w
            h[short] = window_hashes(words, begin[short], w)
        h = mixed(h)
        doc = np.searchsorted(at, lines[:-1], "right")[many] - 1
        lane = (h % np.uint64(LIKE)).astype(np.int64)
        sign = 1.0 - 2.0 * (h >> np.uint64(63)).astype(np.float64)
        out[a:b] += np.bincount(doc * LIKE + lane, sign, (b - a) * LIKE).astype(np.int64).reshape(-1, LIKE)
    return out


def fingerprints(column: pa.Array) -> list[bytes]:
    """The fingerprint of each text of a string column."""
    like = (_like(column) & 0xFFFFFFFF).astype("<u4")
    return [_equal(t or "").astype("<u8").tobytes() + like[i].tobytes() for i, t in enumerate(column.to_pylist())]


def _lanes(fp: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(fp[:8 * EQUAL], "<u8"), np.frombuffer(fp[8 * EQUAL:], "<u4")


def add(a: bytes, b: bytes) -> bytes:
    """The fingerprint of both texts' paragraphs together."""
    (ae, al), (be, bl) = _lanes(a), _lanes(b)
    return (ae + be).tobytes() + (al + bl).tobytes()


def subtract(a: bytes, b: bytes) -> bytes:
    """The fingerprint of the first text's paragraphs without the second's."""
    (ae, al), (be, bl) = _lanes(a), _lanes(b)
    return (ae - be).tobytes() + (al - bl).tobytes()


def likeness(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """0 to 1, from fingerprints alone: 1 where they are equal, else what the
    texts' shingle counts share of both (estimated, below 1)."""
    x = np.frombuffer(b"".join(f[8 * EQUAL:] for f in a), "<i4").reshape(-1, LIKE).astype(np.float64)
    y = np.frombuffer(b"".join(f[8 * EQUAL:] for f in b), "<i4").reshape(-1, LIKE).astype(np.float64)
    apart, whole = ((x - y) ** 2).sum(1), (x ** 2).sum(1) + (y ** 2).sum(1)
    out = np.clip(1 - apart / np.maximum(whole, 1), 0, 1)
    same = np.array([f == g for f, g in zip(a, b, strict=True)], bool)
    return np.where(same, 1.0, np.minimum(out, np.nextafter(1, 0)))


@F.pandas_udf(T.BinaryType())
def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The fingerprint of a text."""
    for s in texts:
        yield pd.Series(fingerprints(pa.array(s, pa.large_string(), from_pandas=True)))


@F.pandas_udf(T.DoubleType())
def near(a: pd.Series, b: pd.Series) -> pd.Series:
    """Likeness of two fingerprints; null where one is missing."""
    out = np.full(len(a), np.nan)
    ok = (a.notna() & b.notna()).to_numpy()
    if ok.any():
        out[ok] = likeness([bytes(x) for x in a[ok]], [bytes(x) for x in b[ok]])
    return pd.Series(out).where(ok)


#: Rows fingerprinted at once.
ROWS = 1000
EDITED = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited(text: str, following: str) -> str:
    """The last floor(n/4) code points replaced by the first as many (or all) of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def in_runs(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(part, guard, doc_id, text): rows dealt into ``parts`` ranges of ids,
    each sorted and closed by a guard, a copy of the row that follows the
    range (after the last: the first row of all). The bounds come from the id
    column alone; texts are shuffled once."""
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id"))
    bounds = np.array(sorted(set(ids.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.25 / parts))), np.float64)

    @F.pandas_udf("int")
    def part(i: pd.Series) -> pd.Series:  # null ids come first
        return pd.Series(np.where(i.isna(), 0, np.searchsorted(bounds, i.fillna(0).to_numpy(np.float64), "right")))

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    heads = (ids.groupBy(part("doc_id").alias("part")).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("h"))
                .orderBy("part").collect())  # one row a part
    after = [(heads[i]["part"], heads[(i + 1) % len(heads)]["h"]["doc_id"]) for i in range(len(heads))]
    guards = docs.sparkSession.createDataFrame(after, "part int, first bigint")
    g = (d.join(F.broadcast(guards), F.col("doc_id").eqNullSafe(F.col("first")))
          .groupBy("part", "doc_id").agg(F.min("text").alias("text")))
    d = d.select(part("doc_id").alias("part"), F.lit(0).alias("guard"), "doc_id", "text")
    d = d.unionByName(g.select("part", F.lit(1).alias("guard"), "doc_id", "text"))
    return d.repartition(parts, "part").sortWithinPartitions("part", "guard", F.asc_nulls_first("doc_id"), "text")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            t = pa.Table.from_batches([batch.slice(at, ROWS)])
            t = t if held is None else pa.concat_tables([held, t])
            n = t.num_rows - 1
            held = t.slice(n)
            column = t["text"].combine_chunks()
            texts, own = column.to_pylist(), fingerprints(column)
            rows = [i for i, guard in enumerate(t["guard"].to_pylist()[:n]) if not guard]
            if not rows:
                continue
            other = [edited(texts[i], texts[i + 1]) for i in rows]
            mine, theirs = [own[i] for i in rows], fingerprints(pa.array(other, pa.large_string()))
            yield pa.RecordBatch.from_pydict({
                "doc_id": t["doc_id"].combine_chunks().take(pa.array(rows)),
                "n_chars": pa.array([len(texts[i]) for i in rows], pa.int64()),
                "edited_sha256": [hashlib.sha256(x.encode(errors="replace")).hexdigest() for x in other],
                "fingerprint": [f.hex() for f in mine], "edited_fingerprint": [f.hex() for f in theirs],
                "near_edited": likeness(mine, theirs), "near_next": likeness(mine, [own[i + 1] for i in rows])})


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with its fingerprint, that of its edited text, and how like its
    fingerprint is to that one and to the next row's (by ascending id, null
    first, then text; after the last comes the first)."""
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], EDITED)
    return in_runs(docs, id_col, text_col, parts).mapInArrow(_compared, EDITED)
