"""Exact dedup by a tree merge of digest runs [native].

Every row gets a digest of its normalised text (SHA-256; verified by byte
length and an independent 64-bit hash, which belong to the merge key, so that
two texts meet only if all three agree) and a leaf run, a hash of its row
number. Up the tree: a run is reduced to one entry per digest (smallest
identifier, count), then 2^FAN runs at a time are merged, keeping the smallest
identifier of each digest, until one run is left. A run is spread over tasks by
its digests, and entries are combined before they are shuffled, so no task
holds a run, a digest's copies or the whole list. Down the tree: each level
takes its winners from the level above, and the rows from the leaves. A digest
with a third of all rows has at most 2^FAN entries below one parent and its
rows are spread over all leaf runs. Texts are never shuffled.

Nulls and ties: a null text counts as empty. The smallest ``id`` of equal
texts stays, null ids last; of rows that repeat that id too, one stays.
Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.session import checkpoint_dir

#: Runs merged at once: 2^FAN.
FAN = 4
WHITE = r"[\x20\x09-\x0D]+"
DIGEST = ["sha", "size", "check"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, row (numbers rows that share an id), run, and the digest columns."""
    d = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), normalised(F.col(text_col)).alias("norm"))
    return d.select("id", "row", F.unhex(F.sha2("norm", 256)).alias("sha"), F.octet_length("norm").alias("size"),
                    F.xxhash64("norm").alias("check"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaf_bits: int | None = None) -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``. ``leaf_bits``: 2^leaf_bits leaf runs; by default as many
    as there are shuffle partitions, rounded up."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    bits = leaf_bits or max(FAN, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    rows = digests(docs, id_col, text_col).withColumn("run", F.pmod(F.xxhash64("row"), F.lit(1 << bits))).checkpoint()
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("best")
    levels = [rows.groupBy("run", *DIGEST).agg(best, F.count(F.lit(1)).alias("n"))]
    steps = [FAN] * (bits // FAN) + ([bits % FAN] if bits % FAN else [])
    for step in steps:
        levels.append(_merged(levels[-1], step))
    won = levels.pop()
    for step in reversed(steps):
        won = _handed_down(levels.pop(), won, step)
    out = rows.join(won, ["run", *DIGEST])
    return out.select("id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
                      (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def _merged(runs: DataFrame, step: int) -> DataFrame:
    """2^step runs become one: the smallest entry of each digest stays."""
    return (runs.withColumn("run", F.shiftright("run", step)).groupBy("run", *DIGEST)
                .agg(F.min("best").alias("best"), F.sum("n").alias("n")))


def _handed_down(runs: DataFrame, won: DataFrame, step: int) -> DataFrame:
    """The winners above, for each entry of the runs below them."""
    low = runs.select("run", *DIGEST, F.shiftright("run", step).alias("up"))
    return low.join(won.withColumnRenamed("run", "up"), ["up", *DIGEST]).drop("up")
