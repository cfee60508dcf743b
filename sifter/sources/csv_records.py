"""Records of CSV files whose quoted fields may hold newlines, one file in many tasks.

Spark's own multi-line reader gives a whole file to one task, since a byte
range does not tell whether it starts inside quotes. Here files are read as
lines, which Spark splits by byte ranges, and each range is read as a function
of what it starts with:

1. a pass gives, for each range and both beginnings (outside and inside a
   quoted field), what it ends with, and the first and last line that begins a
   record;
2. the functions of a file's ranges are composed in their order (a row for each
   range: 128 MB of the file by default), which tells how each really starts;
3. records that lie in one range are put together there; the few lines of
   those that go across a boundary are picked out and joined by record.

A quote opens a field only at its start; two in a quoted field stand for one;
behind a closing quote all up to the next delimiter belongs to the field, as in
Spark's reader. A line ends with a newline; a carriage return before it is
dropped at the end of a record. Empty lines outside quotes are no records.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGES = ("file bigint, start bigint, ends_n boolean, ends_q boolean, first_n bigint, first_q bigint, last_n bigint, last_q bigint")


def _patterns(delimiter: str) -> tuple[str, str]:
    """Lines that end outside quotes, when they begin outside and inside."""
    d = re.escape(delimiter)
    rest = f'([^"{d}][^{d}]*)?'  # behind a closing quote
    field = f'("([^"]|"")*"{rest}|{rest})'
    return f"(?s)^{field}({d}{field})*$", f'(?s)^([^"]|"")*"{rest}({d}{field})*$'


def _open_before(lines: pa.Array, is_open: bool, patterns: tuple[str, str]) -> tuple[np.ndarray, bool]:
    """Whether each line begins inside quotes, and whether the last one ends so."""
    at = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    some = lines.take(pa.array(at))
    after_n, after_q = (~pc.match_substring_regex(some, p).to_numpy(zero_copy_only=False) for p in patterns)
    states = np.empty(len(at) + 1, bool)
    states[0] = is_open
    for i, (n, q) in enumerate(zip(after_n.tolist(), after_q.tolist())):
        states[i + 1] = is_open = q if is_open else n
    return states[np.searchsorted(at, np.arange(len(lines)), "left")], is_open


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, m, line): m grows with the place of a line in its range."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("m"), F.col("value").alias("line"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """A batch by ranges, in order."""
    file, start = batch.column("file").to_numpy(), batch.column("start").to_numpy()
    cut = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
    for i, j in zip([0, *cut], [*cut, len(file)]):
        if j > i:
            yield (int(file[i]), int(start[i])), batch.slice(i, j - i)


def _ranges(lines: DataFrame, patterns: tuple[str, str]) -> DataFrame:
    """A row for each range, as a function of how it begins."""
    def read(batches):
        at, row = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*at, *row[:2])] + [pa.array([x], pa.int64()) for x in row[2:]],
                                              ["file", "start", "ends_n", "ends_q", "first_n", "first_q", "last_n", "last_q"])
        for batch in batches:
            for key, part in _runs(batch):
                if key != at:
                    if at:
                        yield out()
                    at, row = key, [False, True, None, None, None, None]
                m = part.column("m").to_numpy()
                for j in (0, 1):
                    before, row[j] = _open_before(part.column("line"), row[j], patterns)
                    begins = m[~before]
                    if len(begins):
                        row[2 + j] = int(begins[0]) if row[2 + j] is None else row[2 + j]
                        row[4 + j] = int(begins[-1])
        if at:
            yield out()

    return lines.mapInArrow(read, RANGES)


def _composed(ranges: pd.DataFrame) -> pd.DataFrame:
    """How the ranges of one file begin, in order, and where the record that goes into and out of each began."""
    ranges, is_open, owner, out = ranges.sort_values("start"), False, None, []
    for r in ranges.itertuples():
        first, last = (r.first_q, r.last_q) if is_open else (r.first_n, r.last_n)
        ends = r.ends_q if is_open else r.ends_n
        some = not pd.isna(first)
        into = owner if is_open else None
        owner = (r.start if some else owner) if ends else None
        out.append((r.file, r.start, is_open, into, owner if ends and some else None, int(first) if some else None, int(last) if some else None))
        is_open = ends
    return pd.DataFrame(out, columns=["file", "start", "is_open", "into", "outof", "first", "last"]).astype({c: "Int64" for c in ("into", "outof", "first", "last")})


def read_records(spark: SparkSession, path: str, delimiter: str = ",", header: bool = True) -> DataFrame:
    """(record): the text of each record of the files at ``path``, but each file's first with ``header``."""
    patterns, lines = _patterns(delimiter), _lines(spark, path)
    how = _ranges(lines, patterns).groupBy("file").applyInPandas(
        _composed, "file bigint, start bigint, is_open boolean, into bigint, outof bigint, first bigint, last bigint")
    # a row for each 128 MB of the files
    placed = lines.join(F.broadcast(how), ["file", "start"])
    # null compares as unknown: a range without a beginning of a record lies in one
    head = F.col("is_open") & F.coalesce(F.col("m") < F.col("first"), F.lit(True))
    tail = F.col("outof").isNotNull() & (F.col("m") >= F.col("last"))
    inside = placed.where(~(F.coalesce(head, F.lit(False)) | F.coalesce(tail, F.lit(False)))).select("file", "start", "m", "line")

    def whole(batches):
        at, held = None, []
        for batch in batches:
            for key, part in _runs(batch):
                out = []
                if key != at:
                    if held:
                        out.append("\n".join(held))
                    at, held, is_open, first = key, [], False, header and key[1] == 0
                before, is_open = _open_before(part.column("line"), is_open, patterns)
                text, begins = part.column("line").to_pylist(), np.flatnonzero(~before).tolist()
                if begins:
                    ends = [*begins[1:], len(text)]
                    head = [*held, *text[:begins[0]]]
                    done = (["\n".join(head)] if head else []) + ["\n".join(text[i:j]) if j - i > 1 else text[i] for i, j in zip(begins[:-1], ends[:-1])]
                    held = text[begins[-1]:]
                    if first and done:
                        done, first = done[1:], False
                    out += done
                else:
                    held += text
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])
        if held and not first:
            yield pa.RecordBatch.from_arrays([pa.array(["\n".join(held)], pa.string())], ["record"])

    across = placed.where(F.coalesce(head, F.lit(False)) | F.coalesce(tail, F.lit(False)))
    across = across.select("file", F.when(F.coalesce(head, F.lit(False)), F.col("into")).otherwise(F.col("outof")).alias("owner"), F.struct("start", "m", "line").alias("x"))
    # the lines of one record; the header is the first record of the range that begins its file
    across = (across.groupBy("file", "owner").agg(F.array_sort(F.collect_list("x")).alias("x"))
              .join(how.select("file", F.col("start").alias("owner"), "first"), ["file", "owner"]))
    if header:
        across = across.where(~((F.col("owner") == 0) & (F.col("x")[0]["m"] == F.col("first"))))
    across = across.select(F.array_join(F.transform("x", lambda l: l["line"]), "\n").alias("record"))
    records = inside.mapInArrow(whole, "record string").unionByName(across)
    return records.select(F.regexp_replace("record", "\r$", "").alias("record")).where("record != ''")
