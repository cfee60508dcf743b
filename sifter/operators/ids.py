"""Dense global positions without a single-partition window.

Rows are range-partitioned and sorted by the full order key, numbered inside
their partition, and written to the shared checkpoint folder, so that every
later read sees the same partitions. One total per partition is then prefix
summed (as many rows as there are partitions) and added. Rows that tie in the
whole key cannot be told apart by it and share a partition: give a key that
ends in something distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.session import checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in the partition below


def _in_order(df: DataFrame, order: list[str | Column]) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    m = (df.repartitionByRange(*order).sortWithinPartitions(*order)
           .withColumn("_m", F.monotonically_increasing_id()).checkpoint(eager=True))
    return m.withColumn("_part", F.shiftright("_m", _ROW_BITS)).withColumn("_row", F.col("_m").bitwiseAND((1 << _ROW_BITS) - 1)).drop("_m")


def _before(ordered: DataFrame, total: Column) -> DataFrame:
    """(_part, _off): the total of all partitions before each one."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ordered.groupBy("_part").agg(total.alias("_total"))
    return F.broadcast(totals.select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_off")))


def dense_index(df: DataFrame, order: list[str | Column], out_col: str = "index") -> DataFrame:
    """Numbers the rows 0..N-1 in the order of ``order`` (names or columns)."""
    o = _in_order(df, order)
    return (o.join(_before(o, F.count(F.lit(1))), "_part")
             .withColumn(out_col, (F.col("_off") + F.col("_row")).cast("long")).drop("_part", "_row", "_off"))


def running_offsets(df: DataFrame, order_col, count_col: str, out_col: str = "offset") -> DataFrame:
    """Gives every row the sum of ``count_col`` over the rows before it in the
    order of ``order_col`` (a name or a list). Rows are shuffled twice: pass
    the key and the count only, and join the offsets to what needs them."""
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    o = _in_order(df, order)
    local = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (o.withColumn("_local", F.coalesce(F.sum(count_col).over(local), F.lit(0)))
             .join(_before(o, F.sum(count_col)), "_part")
             .withColumn(out_col, (F.col("_off") + F.col("_local")).cast("long"))
             .drop("_part", "_row", "_off", "_local"))


def dense_chunk_ids(docs: DataFrame, chunks_col: str, order_col: str, id_col: str = "chunk_id",
                    pos_col: str = "chunk_pos", text_col: str = "chunk_text",
                    as_string: bool = False) -> DataFrame:
    """Documents holding an ``array<string>`` of chunks -> one row per chunk
    with ids 0..N-1 in (``order_col``, chunk position) order."""
    keep = [c for c in docs.columns if c != chunks_col]
    out = dense_index(docs.select(*keep, F.posexplode(chunks_col).alias(pos_col, text_col))
                          .withColumn(pos_col, F.col(pos_col).cast("long")), [order_col, pos_col], id_col)
    out = out.select(*keep, pos_col, text_col, id_col)
    return out.withColumn(id_col, F.col(id_col).cast("string")) if as_string else out


def chunk_offsets(docs: DataFrame, chunks_col: str, order_col: str) -> tuple[DataFrame, DataFrame]:
    """For documents holding chunk arrays: (the documents, cut from their
    lineage once; a slim ``(order_col, offset)`` frame). The dense id of
    chunk ``p`` of a document is ``offset + p`` — attach it only to the rows
    that need it (e.g. a top-k result) instead of numbering every chunk."""
    checkpoint_dir(docs.sparkSession)
    cut = docs.checkpoint(eager=True)
    slim = cut.select(order_col, F.size(chunks_col).alias("_n"))
    return cut, running_offsets(slim, order_col, "_n").select(order_col, "offset")
