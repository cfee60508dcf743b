"""Packing documents into sequences by order-preserving dynamic programming.

The documents of a task, in their order, form one stream of tokens, each ended
by ``end_id``. Windows of at most ``length`` tokens cover it in order, cut at
document ends (free), sentence ends (SENTENCE) or within long sentences and the
stream's last window (HARD). The cost of a window is its
padding, ``length`` less its tokens, or nothing if that number is a power of
two, plus the penalty of the cut that ends it. The least total is found by

    f[j] = penalty[j] + length - at[j] + min(f[i] + at[i]),  at[j] - at[i] <= length

whose minimum over the sliding range of i is kept by a monotone queue, and by a
look at the boundaries that lie a power of two before j (below SHORT only where
the stream ends).

Tokens are never shuffled: each task tokenises, packs and cuts its own rows in
their order (a file's rows in file order), so the order within a task is kept
and only the last window of a task can be short. A stream is solved whenever
about ``block`` tokens are there; its last window is then taken up again with
the tokens that follow, so memory is bounded by a block and the longest text.
``sequence_id`` is (task << 32) + number in the task. Rows read from files are
replayed alike when a task is repeated; give rows in an order of their own
(e.g. written as a table), not straight from a shuffle.

Nulls and ties: a null text counts as empty and is its end token alone; rows
that repeat are packed again; null ids are kept. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 4096
BLOCK = 1 << 20
SENTENCE, HARD = 4.0, 64.0
#: A sentence of more than GAP tokens may be cut at every STEP-th.
GAP, STEP = 64, 16
#: Windows of a power of two below this are tried for the end of a stream alone; elsewhere they would only add windows.
SHORT = 256
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint")
#: Words that aren't taken apart and parts of words whose ids a worker keeps, and new ones tokenised at once.
KEPT, KEPT_PARTS, AT_ONCE = 600_000, 1_000_000, 20_000
#: Words whose ids are put in a row at once.
SLICE = 1 << 16
_TOKENIZERS: dict[str, tuple] = {}


class Words:
    """The ids of words. White space always parts tokens of the word
    vocabularies used here, so a text's ids are its words' ids in a row; and
    where a lower-casing vocabulary takes letters and marks apart (which is
    tried on a sample at the start), a word of Latin letters and marks is put
    together from its lower-cased letters and its marks, which repeat more."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a sentence if they end a word
        self.ends[[i for t, i in vocabulary.items() if t.removesuffix("</w>")[-1:] in (".", "!", "?")]] = True
        ids = lambda s: self.tokenizer.encode(s, add_special_tokens=False).ids
        self.ranked = _ranked(path)
        self.splits = all(ids(a + w + b) == ids(a) + ids(w.lower()) + ids(b) for w in ("Straße", "ÉTÉ", "s", "Internationale")
                          for a in ("", "(", "$$$", "_") for b in ("", ".", "...", "?!", "'", "###", "_", ",;:"))

    def _encoded(self, words: list[str]) -> Iterator[bytes]:
        for at in range(0, len(words), AT_ONCE):
            for e in self.tokenizer.encode_batch_fast(words[at:at + AT_ONCE], add_special_tokens=False):
                yield array("I", e.ids).tobytes()

    def _encoded_parts(self, parts: list[str]) -> Iterator[bytes]:
        """Letters or marks alone, lower-cased: the vocabulary doesn't take them apart before it merges."""
        if not self.ranked:
            return self._encoded(parts)
        merged = self.ranked._core_bpe.encode_single_piece
        return (array("I", merged(p.encode() + _END)).tobytes() if p else b"" for p in parts)

    def arrays(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words in a row, number of each word's ids)."""
        whole, of_word = found, np.full((len(found), 3), -1)  # up to three parts of each word
        parts = pa.array([], pa.string())
        if self.splits:
            taken = pc.extract_regex(pc.if_else(pc.match_substring(found, "<|"), "", found), _SIMPLE)
            simple = pc.is_valid(taken)
            whole, taken = found.filter(pc.invert(simple)), taken.filter(simple)
            a, b, c = taken.flatten()
            coded = pa.concat_arrays([a, pc.utf8_lower(b), c]).dictionary_encode()
            parts, simple = coded.dictionary, simple.to_numpy(zero_copy_only=False)
            of_word[simple] = coded.indices.to_numpy().reshape(3, -1).T
            of_word[~simple, 0] = np.arange(len(whole)) + len(parts)
        else:
            of_word[:, 0] = np.arange(len(whole))
        ids = [*_known(self.parts, parts, KEPT_PARTS, self._encoded_parts), *_known(self.words, whole, KEPT, self._encoded), b""]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        return _in_a_row(np.frombuffer(b"".join(ids), np.uint32), size, of_word.ravel()), size[of_word].sum(1)

    def of(self, found: list[str]) -> list[bytes]:
        """The ids of each word, packed."""
        ids, size = self.arrays(pa.array(found, pa.string()))
        return [ids[e - n:e].tobytes() for e, n in zip(np.cumsum(size).tolist(), size.tolist(), strict=True)]


def _known(kept: dict[str, bytes], found: pa.Array, most: int, encoded: Callable[[list[str]], Iterator[bytes]]) -> list[bytes]:
    """What is kept for each of ``found``; new ones are encoded."""
    found = found.to_numpy(zero_copy_only=False).tolist()
    ids = list(map(kept.get, found))
    new = [w for w, i in zip(found, ids, strict=True) if i is None]
    if new:
        if len(kept) > most:
            kept.clear()
        made = list(encoded(new))
        kept.update(zip(new, made, strict=True))
        rest = iter(made)
        ids = [next(rest) if i is None else i for i in ids]
    return ids


def _in_a_row(ids: np.ndarray, size: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The ids of the words numbered ``word``, where ``ids`` are those of words 0, 1, ... with ``size`` ids each."""
    begin, out = np.cumsum(size) - size, [ids[:0]]
    for at in range(0, len(word), SLICE):
        w = word[at:at + SLICE]
        n = size[w]
        first = np.cumsum(n) - n
        out.append(ids[np.repeat(begin[w] - first, n) + np.arange(first[-1] + n[-1])])
    return np.concatenate(out)


_END = b"\xff"  # stands for the end of a word: a byte that no UTF-8 text holds


def _ranked(path: str):
    """A byte-level BPE with word ends by ranks, many times as fast on a word
    not met before: the end of a word is a byte of its own, which the vocabulary's
    256 last bytes of words take in first. None if the file is of another kind."""
    import json

    import tiktoken

    from sifter.llm.alignment import byte_of
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    model, back, suffix = d["model"], byte_of(), d["model"].get("end_of_word_suffix")
    vocabulary, added = model.get("vocab", {}), {x["id"] for x in d.get("added_tokens", [])}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    made = [vocabulary.get(a + b, -1) for a, b in merges]
    if model["type"] != "BPE" or not suffix or not made or made != list(range(512, 512 + len(made))):
        return None
    ranks = {bytes(back[c] for c in t.removesuffix(suffix)) + (_END if t.endswith(suffix) else b""): i for t, i in vocabulary.items() if i not in added}
    return tiktoken.Encoding("ranked", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


#: Marks, letters, marks; an apostrophe before letters can belong to them, and "<|" can open a special token.
_SIMPLE = r"^(?P<a>[!-&(-/:-@\[-`{-~]*)(?P<b>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<c>[!-/:-@\[-`{-~]*)$"


def _words(path: str) -> Words:
    """One for each worker process; it outlives tasks where workers are reused."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Words(path)
    return _TOKENIZERS[path]


def _split(texts: pa.Array) -> pa.ListArray:
    """The words of each text, and empty ones beside white space at its ends."""
    # Unicode's white space parts words, as in the vocabularies; of it, four control characters don't
    control = pc.match_substring_regex(texts, "[\x1c-\x1f]")
    if not pc.any(control).as_py():
        return pc.utf8_split_whitespace(texts)
    return pc.if_else(control, pc.ascii_split_whitespace(texts), pc.utf8_split_whitespace(texts))


def tokenized(texts: pa.Array, words: Words, end_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of the texts in a row, each text's followed by ``end_id``; positions after
    the texts; ascending positions after the words that end a sentence). A word is
    looked up once a call, however often it occurs; no text may be null."""
    found = _split(texts)
    distinct = found.flatten().dictionary_encode()
    ids, size = words.arrays(distinct.dictionary)
    closes = words.ends[np.append(ids, 0)[np.maximum(np.cumsum(size), 1) - 1]] & (size > 0)
    ids, size, closes = np.append(ids, np.uint32(end_id)), np.append(size, 1), np.append(closes, False)
    last = np.cumsum(pc.list_value_length(found).to_numpy())  # the end of a text is a word more
    word = np.insert(distinct.indices.to_numpy(), last, len(size) - 1)
    after = np.cumsum(size[word])
    return _in_a_row(ids, size, word), after[last + np.arange(len(last))], after[closes[word]]


def cuts(at: np.ndarray, penalty: np.ndarray, length: int = LENGTH) -> list[int]:
    """Numbers of the boundaries that end windows, in order. ``at``: ascending
    positions, the first 0 and the last the end, gaps at most ``length``;
    ``penalty``: of a cut there, not negative."""
    n = len(at)
    number = np.full(at[-1] + 1, -1, np.int32)
    number[at] = np.arange(n)
    ends, begins, sizes = [], [], []
    k = 1
    while k < length:  # boundaries that lie a power of two before another; one ``length`` before is no better than the queue's
        some = np.flatnonzero(at >= (k if k >= min(SHORT, length // 16) else max(k, at[-1] - length)))  # short windows: only near the end
        i = number[at[some] - k]
        ends.append(some[i >= 0])
        begins.append(i[i >= 0])
        sizes.append(np.full(len(begins[-1]), k))
        k *= 2
    order = np.argsort(np.concatenate(ends), kind="stable")
    exact = zip(*(np.concatenate(x)[order].tolist() for x in (ends, begins, sizes)), strict=True)
    end, e, k = next(exact, (n, 0, 0))
    pos = at.tolist()
    g, back = [0.0], [0]  # g: f + at, least cost up to a boundary if all windows of a power of two were paid by their tokens, others by ``length``
    queue, head, until = [0], 0, length  # from head on g rises; no g that follows is as low as the head's, which holds up to ``until``
    for j, here, cut in zip(range(1, n), pos[1:], penalty[1:].tolist(), strict=True):
        while here > until:
            head += 1
            until = pos[queue[head]] + length
        i = queue[head]
        best = g[i] + length
        while end == j:
            if g[e] + k < best:
                best, i = g[e] + k, e
            end, e, k = next(exact, (n, 0, 0))
        best += cut
        g.append(best)
        back.append(i)
        while g[queue[-1]] >= best:
            queue.pop()
        queue.append(j)
    out, j = [], n - 1
    while j:
        out.append(j)
        j = back[j]
    return out[::-1]


class _Stream:
    """Documents waiting to be packed: ids, tokens, and where the stream may be cut."""

    def __init__(self, task: int, length: int):
        self.length, self.sequence = length, task << 32
        self.docs: list[tuple] = []  # (doc_id, ids, first token still to pack, sentence ends)
        self.size = 0

    def add(self, doc_id, ids: np.ndarray, ends: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0, ends))
        self.size += len(ids)

    def _boundaries(self, last: bool) -> tuple[np.ndarray, np.ndarray]:
        kind = np.full(self.size + 1, HARD)
        may = np.zeros(self.size + 1, bool)
        may[0] = True
        at = 0
        for _, ids, first, ends in self.docs:
            own = at + ends[ends > first] - first
            may[own] = True
            kind[own] = SENTENCE
            at += len(ids) - first
            may[at] = True
            kind[at] = 0.0
        pos = np.flatnonzero(may)
        for a, b in zip(pos[:-1][gap := np.diff(pos) > GAP], pos[1:][gap], strict=True):
            may[a + STEP:b:STEP] = True
        if last:  # a short end may be parted into powers of two
            may[max(0, self.size - self.length):] = True
        pos = np.flatnonzero(may)
        return pos, kind[pos]

    def pack(self, last: bool) -> Iterator[tuple]:
        """Pieces of all windows; unless ``last``, the tokens of the last window stay."""
        if not self.size:
            return
        at, penalty = self._boundaries(last)
        ends = at[cuts(at, penalty, self.length)].tolist()
        stop = ends[-1] if last else ([0] + ends)[-2]
        ends = [e for e in ends if e <= stop]
        begin, w, window, rest = 0, 0, 0, []
        for doc_id, ids, first, sentence in self.docs:
            total = len(ids)
            while first < total and begin < stop:
                take = min(total - first, ends[w] - begin)
                yield (doc_id, first, take, zlib.crc32(ids[first:first + take]), total, self.sequence, begin - window)
                first, begin = first + take, begin + take
                if begin == ends[w]:
                    w, window, self.sequence = w + 1, begin, self.sequence + 1
            if first < total:
                rest.append((doc_id, ids, first, sentence))
        self.docs, self.size = rest, self.size - stop


def pack(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
         length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, stream = _words(tokenizer), _Stream(TaskContext.get().partitionId(), length)

        def out(last: bool) -> Iterator[pa.RecordBatch]:
            rows = list(stream.pack(last))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for b in batches:
            if not len(b):
                continue
            ids, after, ends = tokenized(pc.fill_null(b["text"], ""), words, end_id)
            before = np.concatenate([[0], after[:-1]])
            mine = np.searchsorted(ends, after).tolist()
            for doc_id, s, e, i, j in zip(b["doc_id"].to_pylist(), before.tolist(), after.tolist(), [0, *mine[:-1]], mine, strict=True):
                stream.add(doc_id, ids[s:e], ends[i:j] - s)
                if stream.size >= block:
                    yield from out(False)
        yield from out(True)

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(packed, PIECES)
