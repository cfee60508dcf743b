"""Sharding by a Feistel permutation of global row numbers [native].

Rows are numbered 0..n-1 in the order of their ids. A Feistel network over
pairs (left in Z_a, right in Z_b; a * b is n or a little more, less than
n + a) permutes the numbers; a number that leaves 0..n-1 walks on along its cycle until it is
back. Number p of the permutation lies in shard p mod ``shards`` at slot
p div ``shards``: counts differ by one at most, slots have no gaps, and where a
row goes is computed from its number, n and the seed alone, either way
(``located`` and ``number_at``).

Only ids, sizes and hashes are sorted; texts stay where they are.
``write_shards`` brings the rows themselves to their shards.

Nulls and ties: a null text counts as empty (size 1, CRC 0); null ids come
first. Rows that share an id are ordered by a hash of all their columns; rows
equal in all of them are interchangeable, and are dealt over tasks. Very long
texts are hashed in place. Extra columns go along in ``write_shards``; its
result has columns ``shard`` and ``slot`` of its own, which replace columns of
the same names. An empty table has no rows in any shard.
"""

from __future__ import annotations

import hashlib
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.operators.ids import dense_index
from sifter.session import checkpoint_dir

SEED = "shard-1"
#: Rounds of the network, two to a step; the modulus and factors of its round function.
ROUNDS, PRIME, FACTORS = 6, 2147483647, (1103515245, 747796405)


def shape(n: int) -> tuple[int, int]:
    """(a, b) with n <= a * b < n + a, as near to a square as can be."""
    a = isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def round_keys(seed: str) -> list[int]:
    return [int(hashlib.md5(f"{seed}:{j}".encode()).hexdigest()[:7], 16) for j in range(ROUNDS)]


def _mixed(x: Column, key: Column) -> Column:
    t = (x + key) % PRIME * FACTORS[0] % PRIME
    t = t.bitwiseXOR(F.shiftright(t, 15)) * FACTORS[1] % PRIME
    return t.bitwiseXOR(F.shiftright(t, 13))


def _steps(seed: str, backward: bool = False) -> Column:
    k = round_keys(seed)
    pairs = list(zip(k[::2], k[1::2]))
    return F.array(*[F.struct(F.lit(x).cast("bigint").alias("x"), F.lit(y).cast("bigint").alias("y")) for x, y in (pairs[::-1] if backward else pairs)])


def once(p: Column, n: int, seed: str = SEED) -> Column:
    """The network applied once: a permutation of 0..a*b-1."""
    a, b = shape(n)

    def step(s: Column, k: Column) -> Column:
        left = (s["l"] + _mixed(s["r"], k["x"])) % a
        return F.struct(left.alias("l"), ((s["r"] + _mixed(left, k["y"])) % b).alias("r"))

    return F.aggregate(_steps(seed), F.struct(_div(p, b).alias("l"), (p % b).alias("r")), step, lambda s: s["l"] * b + s["r"])


def back_once(p: Column, n: int, seed: str = SEED) -> Column:
    """The inverse of ``once``."""
    a, b = shape(n)

    def step(s: Column, k: Column) -> Column:
        right = F.pmod(s["r"] - _mixed(s["l"], k["y"]), F.lit(b))
        return F.struct(F.pmod(s["l"] - _mixed(right, k["x"]), F.lit(a)).alias("l"), right.alias("r"))

    return F.aggregate(_steps(seed, backward=True), F.struct(_div(p, b).alias("l"), (p % b).alias("r")), step, lambda s: s["l"] * b + s["r"])


def _div(p: Column, b: int) -> Column:
    return F.call_function("div", p, F.lit(b))


def _walk(p: Column, n: int, steps: int, one) -> Column:
    """``one`` applied again, ``steps`` times at most, while p is not below n."""
    if not steps:
        return p
    on = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), p, lambda s, _: F.when(s >= n, one(s)).otherwise(s))
    return F.when(p < n, p).otherwise(on)


def walk_length(numbers: DataFrame, n: int, seed: str = SEED) -> int:
    """How many further steps the farthest of (number) rows needs. Fewer than a
    rows leave 0..n-1 at all, and none comes to the same place twice, so this ends."""
    away = numbers.select(once(F.col("number"), n, seed).alias("number")).where(F.col("number") >= n).checkpoint()
    steps = 0
    while not away.isEmpty():
        away = away.select(once(F.col("number"), n, seed).alias("number")).where(F.col("number") >= n).checkpoint()
        steps += 1
    return steps


def located(number: Column, n: int, shards: int, steps: int, seed: str = SEED) -> tuple[Column, Column]:
    """(shard, slot) of a row number."""
    p = _walk(once(number, n, seed), n, steps, lambda s: once(s, n, seed))
    return (p % shards).cast("int"), _div(p, shards)


def number_at(shard: Column, slot: Column, n: int, shards: int, steps: int, seed: str = SEED) -> Column:
    """The number of the row at a shard's slot."""
    p = slot.cast("bigint") * shards + shard
    return _walk(back_once(p, n, seed), n, steps, lambda s: back_once(s, n, seed))


def _hashable(docs: DataFrame) -> list[Column]:
    return [F.to_json(f.name) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema.fields]


def _identified(docs: DataFrame, text_col: str) -> list[Column]:
    """Size, CRC and a hash of all columns: what tells rows of one id apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [(F.octet_length(text) + 1).cast("bigint").alias("_size"), F.crc32(text).alias("_crc"),
            F.xxhash64(*[x for c in _hashable(docs) for x in (c.isNull(), c)]).alias("_tie")]


def shard_rows(docs: DataFrame, shards: int = 8, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, ``size`` (UTF-8 bytes of the text plus 1),
    ``text_crc32``, ``tie``, ``number`` (its global row number), ``shard``, ``slot``."""
    checkpoint_dir(docs.sparkSession)
    slim = docs.select(F.col(id_col).alias("id"), *_identified(docs, text_col)).toDF("id", "size", "text_crc32", "tie").checkpoint()
    n = slim.count()
    # the last key spreads rows that are equal in all columns
    numbered = dense_index(slim.withColumn("_again", F.monotonically_increasing_id()), ["id", "tie", "size", "text_crc32", "_again"], "number").drop("_again")
    shard, slot = located(F.col("number"), n, shards, walk_length(numbered.select("number"), n, seed), seed)
    return numbered.select("id", "size", "text_crc32", "tie", "number", shard.alias("shard"), slot.alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the rows as Parquet under ``path``, one folder ``shard=k`` a
    shard, its files in the order of ``slot``; a shard is written by several
    tasks. Equal rows travel once, and are repeated where they are written."""
    key = ["_size", "_crc", "_tie"]
    plan = shard_rows(docs, shards, seed, id_col, text_col).select(F.col("size").alias("_size"), F.col("text_crc32").alias("_crc"), F.col("tie").alias("_tie"), "shard", "slot").checkpoint()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *_identified(docs, text_col))
    again = plan.groupBy(key).count().where("count > 1").select(key)
    once_each = rows.join(again, key, "left_anti").unionByName(rows.join(again, key, "left_semi").groupBy(key).agg(F.any_value("_row").alias("_row")).select(rows.columns))
    out = plan.join(once_each, key).select(*[F.col("_row")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")], "slot", "shard")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
