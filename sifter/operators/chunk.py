"""Chunkers: text column -> ``array<string>`` column, and the frame-level
split that explodes chunks while carrying the document's other columns.

Packing contract (shared by every separator-based chunker), on the running
positions ``at`` of the pieces with their separators: a chunk that starts at
piece ``s`` ends at the last piece within ``size`` of it, or after one piece
that is longer; the next chunk starts at the first piece that is within
``overlap`` of that end and leaves room for the piece after it. Chunks are
joined by the separator and stripped; empty ones are left out. Both limits are
found by bisection.

Cutting is sequential inside one document, parallel across documents, so it
runs as an Arrow-batched ``pandas_udf`` (one Python call per batch of rows).
The token chunker is a pure SQL expression.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence
from itertools import accumulate, groupby, pairwise

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from sifter.functions.text import words

# Separator ladder of the recursive chunker, tried in order.
RECURSIVE_SEPARATORS = ("\n\n", "\n", " ", "")
SENTENCE_END = re.compile(r"(?<=[.!?])\s+")


# --------------------------------------------------------------------------
# Python core (runs inside Arrow batches on executors)
# --------------------------------------------------------------------------

def pack(pieces: Sequence[str], size: int, overlap: int, sep: str = "",
         length: Callable[[str], int] = len) -> list[str]:
    """``length`` measures pieces and the separator (X3: characters by
    default; a token counter makes ``size`` a token budget)."""
    gap = length(sep)
    at = [0, *accumulate(length(p) + gap for p in pieces)]
    chunks, start, end = [], 0, 0
    while end < len(pieces):
        end = max(start + 1, bisect_right(at, at[start] + gap + size) - 1)
        chunks.append(sep.join(pieces[start:end]).strip())
        if end < len(pieces):
            near, room = bisect_left(at, at[end] - gap - overlap), bisect_left(at, at[end + 1] - gap - size)
            start = max(start, min(end, max(near, room)))
    return [c for c in chunks if c]


def _headed(text: str, sep: str) -> list[str]:
    """The pieces between separators, each after the first with its separator in front."""
    if not sep:
        return list(text)
    cuts = [0, *(m.start() for m in re.finditer(re.escape(sep), text)), len(text)]
    return [text[a:b] for a, b in pairwise(cuts) if a < b]


def split_recursive(text: str, size: int = 500, overlap: int = 80,
                    separators: Sequence[str] = RECURSIVE_SEPARATORS,
                    length: Callable[[str], int] = len) -> list[str]:
    """Pieces at the first separator that occurs; runs of short pieces are
    packed, each long one is split at the separators that follow."""
    found = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    finer = separators[found + 1:] if separators[found] else ()
    chunks: list[str] = []
    for short, run in groupby(_headed(text, separators[found]), key=lambda p: length(p) < size):
        if short:
            chunks += pack(list(run), size, overlap, "", length)
        else:
            for piece in run:
                chunks += split_recursive(piece, size, overlap, finer, length) if finer else [piece]
    return chunks


def split_separator(text: str, size: int = 1000, overlap: int = 200, separator: str = "\n\n",
                    length: Callable[[str], int] = len) -> list[str]:
    pieces = [p for p in text.split(separator) if p] if separator else list(text)
    return pack(pieces, size, overlap, separator, length)


def split_sentences(text: str, size: int = 4000, overlap: int = 200, separator: str = "\n\n") -> list[str]:
    pieces = [s.strip() for s in SENTENCE_END.split(text)]
    return pack([s for s in pieces if s], size, overlap, separator)


# --------------------------------------------------------------------------
# Column -> Column chunkers
# --------------------------------------------------------------------------

def _as_pandas_udf(fn: Callable[[str], list[str]]):
    @F.pandas_udf(ArrayType(StringType()))
    def _udf(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else fn(t))
    # flagged so the optimizer never duplicates the call into a pushed-down filter
    return _udf.asNondeterministic()


def recursive_chunker(size: int = 500, overlap: int = 80, separators: Sequence[str] = RECURSIVE_SEPARATORS,
                      length: Callable[[str], int] = len) -> Callable[[Column], Column]:
    seps = tuple(separators)
    return _as_pandas_udf(lambda t: split_recursive(t, size, overlap, seps, length))


def separator_chunker(size: int = 1000, overlap: int = 200, separator: str = "\n\n",
                      length: Callable[[str], int] = len) -> Callable[[Column], Column]:
    return _as_pandas_udf(lambda t: split_separator(t, size, overlap, separator, length))


def sentence_chunker(size: int = 4000, overlap: int = 200, separator: str = "\n\n") -> Callable[[Column], Column]:
    return _as_pandas_udf(lambda t: split_sentences(t, size, overlap, separator))


def token_chunker(size: int = 1024, overlap: int = 0) -> Callable[[Column], Column]:
    """Windows of ``size`` whitespace tokens, ``size - overlap`` apart; the
    last window ends at the last token. Pure SQL (no Python worker)."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    step = size - overlap

    def chunker(c: Column) -> Column:
        toks = words(c)
        n = F.size(toks)
        m = F.when(n == 0, F.lit(0)).otherwise(
            F.lit(1) + F.ceil(F.greatest(n - F.lit(size), F.lit(0)) / F.lit(step)).cast("int"))
        starts = F.when(m == 0, F.array().cast("array<int>")).otherwise(
            F.transform(F.sequence(F.lit(0), m - 1), lambda j: j * F.lit(step)))
        return F.when(c.isNotNull(), F.transform(starts, lambda s: F.array_join(F.slice(toks, s + 1, size), " ")))

    return chunker


# --------------------------------------------------------------------------
# Frame-level split (documents -> chunks)
# --------------------------------------------------------------------------

def split_documents(df: DataFrame, chunker: Callable[[Column], Column], text_col: str = "text",
                    keep: Sequence[str] | None = None, out_col: str = "chunk_text",
                    pos_col: str = "chunk_pos") -> DataFrame:
    """One row per chunk; ``keep`` columns (default: all but the text) are
    inherited by every chunk of the document. Null text yields no chunk."""
    keep = [c for c in (keep if keep is not None else df.columns) if c != text_col]
    arr = chunker(F.col(text_col))
    # no isNotNull filter: posexplode(null) yields no row, and a predicate on
    # a derived text would be pushed below the exchange and computed twice
    return (df.select(*keep, F.posexplode(arr).alias(pos_col, out_col))
              .withColumn(pos_col, F.col(pos_col).cast("long")))
