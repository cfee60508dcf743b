"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed 1- to 3-grams of lower-cased code points per
language, in partial sums per task and batch, over a bounded, repeatable sample
of the labelled rows: per language the rows whose id and text hash below
``per_language`` / (its rows), so about ``per_language`` rows each. The model is
a log-probability matrix of languages x BUCKETS (Laplace-smoothed) and log
priors; its size depends on the number of languages alone, and it is broadcast.
Scoring counts the n-grams of a batch as a sparse matrix and multiplies it with
the model in numpy.
Runs of anything but letters count as one space, at the ends of a text too.

``lang_pred`` is the language of the highest posterior (ties: the first by
name) and ``score`` that posterior. A text that is null or has no letter is
``und`` with score 0, and so is every text if nothing could be learned. Rows
without language or text teach nothing. More than MOST_LANGUAGES labels are an
error. Extra columns are kept, but for those named as the two results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
ORDERS = 3
PER_LANGUAGE = 4000
ALPHA = 0.5
#: Labels learned at most (a matrix of 256 KB each); more is an error.
MOST_LANGUAGES = 256
#: N-grams of a batch scored at once, and probabilities gathered at once.
GRAMS, CELLS = 1 << 20, 1 << 22
#: Code points hashed at once (a longer text is summed in pieces).
PIECE = 1 << 18
_LETTER: list[np.ndarray] = []
_MULTIPLY = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def _grams(c: np.ndarray) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of normalised code points, in pieces."""
    for at in range(0, len(c), PIECE):
        p = c[at:at + PIECE + ORDERS - 1]
        h = np.zeros(len(p), np.uint32)
        for k in range(ORDERS):
            if len(p) <= k:
                break
            h = (h[:len(p) - k] + p[k:]) * np.uint32(_MULTIPLY[k])
            own = h[:PIECE]  # those that begin in this piece
            yield ((own ^ (own >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)


def normalised(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, each run of others as one space
    and one at either end; empty without a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    c = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "replace"), np.uint32)
    letter = _LETTER[0][c]
    if not letter.any():
        return c[:0]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.concatenate([np.array([32], np.uint32), np.where(letter, c, np.uint32(32))[keep]])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """(languages, matrix): row of each language, its last column the log prior."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    found = known.groupBy(F.col(lang_col).alias("l")).agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} labels in {lang_col}: not a column of languages")
    rows = {r["l"]: r["n"] for r in found}
    names = sorted(rows)
    number = {n: i for i, n in enumerate(names)}
    if not names:
        return [], np.zeros((0, BUCKETS + 1), np.float32)
    share = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(min(1.0, per_language / rows[n])))])
    u = F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)), F.lit(1 << 20)) / float(1 << 20)
    sample = known.where(u < share[F.col(lang_col)]).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), BUCKETS), np.int64)
        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True):
                for g in _grams(normalised(text)):
                    total[number[lang]] += np.bincount(g, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "n": pa.array(total.ravel()[at], pa.int64())})

    counts = np.zeros(len(names) * BUCKETS, np.float64)
    for r in [sample.mapInArrow(counted, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()]:
        counts[r["at"].to_numpy()] = r["n"].to_numpy()
    counts = counts.reshape(len(names), BUCKETS) + ALPHA
    prior = np.log(np.array([rows[n] for n in names], np.float64) / sum(rows.values()))
    return names, np.hstack([np.log(counts / counts.sum(1, keepdims=True)), prior[:, None]]).astype(np.float32)


def posterior(texts: list[str | None], names: list[str], matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, its posterior) of each text. The texts' n-grams make a sparse
    matrix (text, n-gram, count) of at most about GRAMS entries at once, whose
    product with the log probabilities is added up by text."""
    table, known = np.ascontiguousarray(matrix[:, :-1].T), np.zeros(len(texts), bool)
    log = np.tile(matrix[:, -1].astype(np.float64), (len(texts), 1))
    step = max(1, CELLS // max(len(names), 1))
    held: list[tuple[int, np.ndarray]] = []

    def add() -> None:
        key = np.concatenate([i * BUCKETS + g.astype(np.int64) for i, g in held])
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        text, gram = np.divmod(key[first], BUCKETS)
        count = np.diff(first, append=len(key))
        for at in range(0, len(first), step):
            of = text[at:at + step]
            begin = np.flatnonzero(np.diff(of, prepend=-1))
            part = table[gram[at:at + step]].astype(np.float64) * count[at:at + step, None]
            log[of[begin]] += np.add.reduceat(part, begin, axis=0)
        held.clear()

    size = 0
    for i, t in enumerate(texts):
        s = normalised(t)
        if not len(s) or not names:
            continue
        known[i] = True
        for g in _grams(s):
            held.append((i, g))
            size += len(g)
            if size > GRAMS:
                add()
                size = 0
    if held:
        add()
    if not known.any():
        return ["und"] * len(texts), np.zeros(len(texts))
    best = log.argmax(1)
    score = 1.0 / np.exp(log - log.max(1, keepdims=True)).sum(1)
    return [names[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())], np.where(known, score, 0.0)


def identify(docs: DataFrame, names: list[str], matrix: np.ndarray, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, in place of columns of these names; reads ``text_col`` alone."""
    model = docs.sparkSession.sparkContext.broadcast((names, matrix))

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, matrix = model.value
        for s in texts:
            pred, score = posterior(list(s), names, matrix)
            yield pd.DataFrame({"lang_pred": pred, "score": score})

    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")], predicted(F.col(text_col)).alias("_language_of_text")).select("*", "_language_of_text.*").drop("_language_of_text")


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0 (a null id: that of the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0
