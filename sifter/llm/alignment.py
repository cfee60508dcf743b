"""Cross-tokenizer alignment by merge_asof.

Both tokenizers cut the same bytes, a space and the text. Per batch, two pandas
merge_asof, keyed by document, find for each token start of one side the token
of the other that covers it; the union of both directions is every overlapping
pair. Offsets where both sides end cut the tokens into groups.

Texts are tokenized by segments that start at a space between two characters
that are not white space: neither tokenizer joins anything across such a place
(the first one's pre-tokenizer starts a piece there; no piece of the second
has a space behind another character, which is checked). A task tokenizes each
segment once as long as its cache holds it (CACHE entries, then it starts anew).

``align`` gives tokens, ends, groups and links of each document.
``link_counts`` counts over all documents how many hold a pair of ids linked:
each document's distinct pairs are written with their numbers, then summed by
Spark, partially first. ``link_scores`` brings the counts back: the table of
pairs is broadcast if it has at most MOST rows (it is counted first), else
joined, with the pairs that many documents hold dealt over sub-keys.

Nulls and ties: null and empty texts, and texts that a tokenizer does not give
back byte by byte (it reads U+2581 as a space), have no tokens: zeros, empty
lists, '' as digest. Rows that share an id are documents of their own. A very
long text is worked on in one piece of its task, about 100 bytes of memory a
byte of text; one segment of many millions of characters is one call of the
tokenizers. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.skew import salted_join
from sifter.llm.words import text_bytes
from sifter.session import checkpoint_dir, ensure_parallelism, scratch_path

#: Pairs of ids broadcast at most (about 60 bytes each).
MOST = 2_000_000
#: Segments a worker remembers.
CACHE = 150_000
#: Bytes of text worked on at once (one text is never cut).
PIECE = 1 << 19
_KEPT: dict[tuple[str, str], "Tokenizers"] = {}
_WIDE_BYTES = frozenset((0xC2, 0xE1, 0xE2, 0xE3))  # first bytes of white space beyond ASCII
_WIDE = np.array(sorted(_WIDE_BYTES), np.uint8)


class Tokenizers:
    """A byte-level BPE (A) and a piece model (B), their tokens' bytes, and segments already tokenized."""

    def __init__(self, path_a: str, path_b: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.n_a, self.n_b = max(vocabulary.values()) + 1, self.b.get_piece_size()
        back = byte_of()
        self.bytes_a = [b""] * self.n_a
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.ranked = _ranked(path_a, vocabulary, self.bytes_a)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.n_b) for p in [self.b.id_to_piece(i)]]
        if any(" " in p.decode().lstrip(" ") for i, p in enumerate(self.bytes_b) if not self.b.is_byte(i)):
            raise ValueError("a piece has a space behind another character: texts cannot be cut at spaces")
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        a, b = [str(i) for i in range(self.n_a)], [str(i) for i in range(self.n_b)]
        #: Ids as they stand in the text of the groups: A inside, A last, B inside, B last.
        self.shown = pa.array([x + "," for x in a] + [x + "|" for x in a] + [x + "," for x in b] + [x + ";" for x in b], pa.large_binary())
        self.table_a, self.table_b = pa.array(self.bytes_a, pa.large_binary()), pa.array(self.bytes_b, pa.large_binary())
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.flat_a, self.flat_b = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.count_a, self.count_b, self.same = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def numbers(self, segments: list[bytes]) -> np.ndarray:
        """Places of segments in ``count_a``, ``count_b``, ``same`` (both
        tokenizers give the segment back); flat_a, flat_b: their ids, end to end."""
        if len(self.number) > CACHE:
            self._forget()
        new = [s for s in segments if s not in self.number]
        if new:
            self._learn(new)
        return np.fromiter(map(self.number.__getitem__, segments), np.int64, len(segments))

    def _learn(self, new: list[bytes]) -> None:
        # what starts with a space and something else may stand behind anything: one call for all of these
        joins = [len(s) > 1 and s[1] > 0x20 and s[1] not in _WIDE_BYTES for s in new]
        new = [s for s, j in zip(new, joins) if j] + [s for s, j in zip(new, joins) if not j]
        n, size = sum(joins), np.fromiter(map(len, new), np.int64, len(new))
        texts = [s.decode("utf-8", "replace") for s in new]
        joined = "".join(texts[:n])
        a = np.array(self.ranked.encode_ordinary(joined) if self.ranked else self.a.encode_batch_fast([joined], add_special_tokens=False)[0].ids if n else [], np.int64)
        ends, bounds = np.cumsum(self.len_a[a]), np.cumsum(size[:n])
        if not np.isin(bounds, ends, assume_unique=True).all():
            n, a, ends, bounds = 0, a[:0], ends[:0], bounds[:0]
        count = np.diff(np.searchsorted(ends, bounds) + 1, prepend=0) if n else np.zeros(0, np.int64)
        odd = [e.ids for e in self.a.encode_batch_fast(texts[n:], add_special_tokens=False)]
        a = np.concatenate([a, np.fromiter(chain.from_iterable(odd), np.int64)])
        count_a = np.concatenate([count, np.fromiter(map(len, odd), np.int64, len(odd))])
        got = self.b.encode([t[1:] for t in texts], num_threads=1)
        b, count_b = np.fromiter(chain.from_iterable(got), np.int64), np.fromiter(map(len, got), np.int64, len(got))
        same = _gives_back(self.table_a, self.len_a, a, count_a, new, size) & _gives_back(self.table_b, self.len_b, b, count_b, new, size)
        self.number.update(zip(new, range(len(self.same), len(self.same) + len(new))))
        self.flat_a, self.flat_b = np.concatenate([self.flat_a, a.astype(np.int32)]), np.concatenate([self.flat_b, b.astype(np.int32)])
        self.count_a, self.count_b, self.same = np.concatenate([self.count_a, count_a]), np.concatenate([self.count_b, count_b]), np.concatenate([self.same, same])


def _gives_back(table: pa.Array, length: np.ndarray, ids: np.ndarray, count: np.ndarray, segments: list[bytes], size: np.ndarray) -> np.ndarray:
    """Whether the tokens' bytes are the segment's, for each segment."""
    of = np.repeat(np.arange(len(count)), count)
    same = np.bincount(of, length[ids], len(count)).astype(np.int64) == size
    got = table.take(pa.array(ids[same[of]]))
    raw = np.frombuffer(got.buffers()[2], np.uint8) if len(got) else np.zeros(0, np.uint8)
    want = np.frombuffer(b"".join([s for s, ok in zip(segments, same.tolist()) if ok]), np.uint8)
    wrong = np.flatnonzero(raw[:len(want)] != want)
    at = np.flatnonzero(same)
    same[at[np.unique(np.searchsorted(np.cumsum(size[at]), wrong, "right"))]] = False
    return same


def _ranked(path: str, vocabulary: dict[str, int], token: list[bytes]):
    """The same byte-level BPE by ranks, several times as fast on words not met
    before, if the file is one whose merges stand in the order of their ids and
    whose pre-tokenizer is the byte-level one; else None."""
    import json

    import tiktoken
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    merges = [m.split(" ") if isinstance(m, str) else m for m in d["model"].get("merges", [])]
    made = [vocabulary.get(a + b, -1) for a, b in merges]
    if d["model"]["type"] != "BPE" or d.get("normalizer") or not plain.items() <= (d.get("pre_tokenizer") or {}).items() or sorted(set(made)) != made or made[:1] != [256]:
        return None
    special = {x["id"] for x in d.get("added_tokens", [])}
    # fixed value: the byte-level pre-tokenizer's pattern
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks={x: i for i, x in enumerate(token) if i not in special}, special_tokens={})


def byte_of() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    Latin-1 bytes for themselves, the others, in order, from U+0100 on."""
    own = [x for x in range(256) if 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x]
    rest = [x for x in range(256) if x not in own]
    return {chr(x): x for x in own} | {chr(256 + k): x for k, x in enumerate(rest)}


def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    """Loaded once a worker."""
    if (path_a, path_b) not in _KEPT:
        _KEPT[path_a, path_b] = Tokenizers(path_a, path_b)
    return _KEPT[path_a, path_b]


def cuts(data: np.ndarray) -> np.ndarray:
    """Places of spaces between two characters that surely are not white space."""
    at = np.flatnonzero(data[1:-1] == 0x20) + 1 if len(data) > 2 else np.zeros(0, np.int64)
    before, after = data[at - 1], data[at + 1]
    ok = (before > 0x20) & (after > 0x20) & ~np.isin(after, _WIDE)
    high = before >= 0x80  # the end of a character of several bytes, maybe of a wide space
    ok &= ~(high & ((data[at - 2] == 0xC2) | np.isin(data[np.maximum(at - 3, 0)], _WIDE)))
    return at[ok]




class Block:
    """The tokens of some documents, end to end. ``good``: documents with
    tokens. a, b: ids; ends_a, ends_b: ends in bytes, counted on over the good
    documents; doc_a, doc_b: their documents; last_a, last_b: tokens that end a
    group; link_a, link_b: token numbers of all overlapping pairs."""

    def __init__(self, t: Tokenizers, data: np.ndarray, offsets: np.ndarray):
        self.n = len(offsets) - 1
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets[:-1]], begins[-1] = True, False
        begins[cuts(data)] = True
        starts = np.flatnonzero(begins)
        doc = np.searchsorted(offsets, starts, "right") - 1
        ends = np.append(starts, len(data)).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
        coded = column.dictionary_encode()
        number = t.numbers(coded.dictionary.to_pylist())
        code = number[coded.indices.to_numpy()]
        self.good = (np.diff(offsets) > 0) & (np.bincount(doc, ~t.same[code], self.n) == 0)
        at = self.good[doc]
        code, doc = code[at], doc[at]
        self.a, self.doc_a = _spread(t.flat_a, t.count_a, code, doc)
        self.b, self.doc_b = _spread(t.flat_b, t.count_b, code, doc)
        self.ends_a, self.ends_b = np.cumsum(t.len_a[self.a]), np.cumsum(t.len_b[self.b])
        self.last_a = np.isin(self.ends_a, self.ends_b, assume_unique=True)
        self.last_b = np.isin(self.ends_b, self.ends_a, assume_unique=True)
        self._link(self.ends_a - t.len_a[self.a], self.ends_b - t.len_b[self.b])

    def _link(self, starts_a: np.ndarray, starts_b: np.ndarray) -> None:
        a = pd.DataFrame({"start": starts_a, "doc": self.doc_a, "a": np.arange(len(starts_a)), "from_a": starts_a})
        b = pd.DataFrame({"start": starts_b, "doc": self.doc_b, "b": np.arange(len(starts_b)), "from_b": starts_b})
        forth = pd.merge_asof(a, b, on="start", by="doc")
        back = pd.merge_asof(b, a, on="start", by="doc")
        back = back[back["from_a"] != back["from_b"]]  # the union: equal starts are found from both sides
        self.link_a = np.concatenate([forth["a"], back["a"]]).astype(np.int64)
        self.link_b = np.concatenate([forth["b"], back["b"]]).astype(np.int64)

    def per_doc(self, doc: np.ndarray, chosen: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(doc if chosen is None else doc[chosen], minlength=self.n).astype(np.int64)

    def group_digests(self, t: Tokenizers) -> list[str]:
        """SHA-256 of each document's groups as ``a1,a2|b1;a3|b2,b3``; '' without tokens."""
        end_a, end_b = np.flatnonzero(self.last_a), np.flatnonzero(self.last_b)
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        place_a = np.arange(len(self.a)) + np.concatenate([[0], end_b + 1])[group_a]  # behind B's tokens of earlier groups
        place_b = np.arange(len(self.b)) + (end_a + 1)[group_b]  # behind A's tokens up to its own
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[place_a] = self.a + np.where(self.last_a, t.n_a, 0)
        order[place_b] = 2 * t.n_a + self.b + np.where(self.last_b, t.n_b, 0)
        text = t.shown.take(pa.array(order))
        offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
        raw = memoryview(text.buffers()[2]) if len(text) else memoryview(b"")
        upto = offsets[np.cumsum(self.per_doc(self.doc_a) + self.per_doc(self.doc_b))]
        out, begin = [], int(offsets[0])
        for end, good in zip(upto.tolist(), self.good.tolist()):
            out.append(hashlib.sha256(raw[begin:end - 1]).hexdigest() if good else "")
            begin = end
        return out

    def distinct_links(self, t: Tokenizers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents, pairs as a * n_b + b, how often) by document and pair."""
        pair = self.a[self.link_a].astype(np.int64) * t.n_b + self.b[self.link_b]
        key = np.sort(self.doc_a[self.link_a] * (t.n_a * t.n_b) + pair)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key, n = key[first], np.diff(first, append=len(key))
        return key // (t.n_a * t.n_b), key % (t.n_a * t.n_b), n


def _spread(flat: np.ndarray, n: np.ndarray, code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the segments in order, and their documents."""
    m = n[code]
    at = np.repeat((np.cumsum(n) - n)[code] - (np.cumsum(m) - m), m)
    at += np.arange(len(at))
    return flat[at], np.repeat(doc, m)


def _blocks(batch: pa.RecordBatch, t: Tokenizers):
    """(ids, Block) of the texts of a batch (id, text), about PIECE bytes each."""
    text = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
    spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string()))
    column = pc.if_else(pc.equal(pc.binary_length(text), 0), text, spaced)
    data, offsets = text_bytes(column)
    last = 0
    while last < len(column):
        first, last = last, max(last + 1, int(np.searchsorted(offsets, offsets[last] + PIECE, "right")) - 1)
        yield batch.column(0).slice(first, last - first), Block(t, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    checkpoint_dir(docs.sparkSession)
    return ensure_parallelism(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id``; ``a``, ``b``: token ids; ``ends_a``, ``ends_b``: their
    ends in bytes of the space and the text; ``cuts``: ends of the groups;
    ``link_a``, ``link_b``: token numbers of all overlapping pairs, by ``link_a``, ``link_b``."""
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()

    def run(batches):
        t = tokenizers(path_a, path_b)
        for batch in batches:
            for ids, k in _blocks(batch, t):
                n_a, n_b = k.per_doc(k.doc_a), k.per_doc(k.doc_b)
                first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
                base = np.concatenate([[0], k.ends_a])[first_a]
                order = np.lexsort([k.link_b, k.link_a])
                link_a, link_b = k.link_a[order], k.link_b[order]
                doc = k.doc_a[link_a]
                yield pa.RecordBatch.from_arrays([
                    ids, _lists(k.a, n_a, pa.int32()), _lists(k.ends_a - base[k.doc_a], n_a, pa.int64()),
                    _lists(k.b, n_b, pa.int32()), _lists(k.ends_b - base[k.doc_b], n_b, pa.int64()),
                    _lists((k.ends_a - base[k.doc_a])[k.last_a], k.per_doc(k.doc_a, k.last_a), pa.int64()),
                    _lists(link_a - first_a[doc], k.per_doc(doc), pa.int32()), _lists(link_b - first_b[doc], k.per_doc(doc), pa.int32()),
                ], ["id", "a", "ends_a", "b", "ends_b", "cuts", "link_a", "link_b"])

    ints, longs = "array<int>", "array<bigint>"
    return _texts(docs, id_col, text_col).mapInArrow(run, f"id {kind}, a {ints}, ends_a {longs}, b {ints}, ends_b {longs}, cuts {longs}, link_a {ints}, link_b {ints}")


def linked(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``row`` (a number of its own), ``id``, ``n_a``, ``n_b``,
    ``n_groups``, ``n_links``, ``groups_sha256``, and its distinct linked
    ``pairs`` with their ``times``. Written once, in the checkpoint folder."""
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext
        t, row = tokenizers(path_a, path_b), TaskContext.get().partitionId() << 33
        for batch in batches:
            for ids, k in _blocks(batch, t):
                doc, pair, n = k.distinct_links(t)
                count = lambda *x: pa.array(k.per_doc(*x))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(k.n)), ids, count(k.doc_a), count(k.doc_b), count(k.doc_a, k.last_a), count(k.doc_a[k.link_a]),
                    pa.array(k.group_digests(t), pa.string()), _lists(pair, k.per_doc(doc), pa.int64()), _lists(n, k.per_doc(doc), pa.int32()),
                ], ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
                row += k.n

    path = scratch_path(docs.sparkSession, "alignment")
    schema = f"row bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
    _texts(docs, id_col, text_col).mapInArrow(run, schema).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def link_counts(table: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): how many documents hold the pair of ids linked, and
    whether no pair of the same A id has more. An A id has at most n_b pairs."""
    n = table.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    a = F.call_function("floor", F.col("pair") / F.lit(n_b)).cast("bigint")
    most = n.groupBy(a.alias("_a")).agg(F.max("n").alias("_most"))
    return n.withColumn("_a", a).join(most, "_a").select("pair", "n", (F.col("n") == F.col("_most")).alias("best")).checkpoint()


def link_scores(table: DataFrame, counts: DataFrame, most_pairs: int = MOST) -> DataFrame:
    """(row, n_best, count_sum): links whose pair is its A id's best, and the sum of the pairs' counts."""
    links = table.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").cast("bigint").alias("times"))
    if counts.count() <= most_pairs:
        scored = links.join(F.broadcast(counts), "pair")
    else:
        scored = salted_join(links, counts.withColumnRenamed("n", "held"), "pair", counts.select("pair", "n")).withColumnRenamed("held", "n")
    return scored.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))


def score_alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", most_pairs: int = MOST) -> DataFrame:
    """Per row: ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``."""
    table = linked(docs, path_a, path_b, id_col, text_col)
    n_b = tokenizers(path_a, path_b).n_b
    scores = link_scores(table, link_counts(table, n_b), most_pairs)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return table.drop("pairs", "times").join(scores, "row", "left").select("id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
