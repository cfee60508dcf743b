"""Joins to a table with one row per key when a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it has more rows than 1/SHARE of a partition's even share.
SHARE = 4
SALTS = 64


def salted_join(big: DataFrame, keyed: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """``big`` left join ``keyed`` on ``key`` (null matches nothing). ``counts``
    is (key, n), the rows of each key in ``big``. Rows of hot keys are dealt
    over SALTS sub-keys, and only their few rows of ``keyed`` are repeated. At
    most SHARE keys a partition can be hot, so that list alone is broadcast."""
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(counts.where(F.col("n") * parts * SHARE > F.lit(total)).select(F.col(key).alias("_hot")))
    deal = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS))).otherwise(F.lit(0))
    left = big.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", deal).drop("_hot")
    salts = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<bigint>")
    right = keyed.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return left.join(right, [key, "_salt"], "left").drop("_salt")
