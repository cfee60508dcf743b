"""Weighted random choice as a grouped aggregation.

Efraimidis-Spirakis: every candidate gets the key ``-ln(u) / w`` with ``u``
uniform, taken from a hash of the seed, the draw, the group and the
candidate's values, so
that picks repeat on any partition layout and in any engine with md5; the candidate with the smallest key is a draw with
probability proportional to ``w``. ``min_by`` per (group, draw) is a
partial-aggregating group-by, so a hot group never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DRAWS_AT_ONCE = 32


def weighted_choice(df: DataFrame, weight_col: str, value_cols: Sequence[str], group_cols: Sequence[str] = (),
                    draws: int = 1, seed: int = 17) -> DataFrame:
    """``draws`` independent picks (with replacement) per group:
    (*group_cols, draw, *value_cols). Rows with weight <= 0 or null are never
    picked."""
    d = df.where(F.col(weight_col) > 0)
    out = None
    for first in range(0, draws, DRAWS_AT_ONCE):  # a column for each draw of one aggregation
        part = range(first, min(draws, first + DRAWS_AT_ONCE))
        picked = d.groupBy(*group_cols).agg(*[F.min_by(F.struct(*value_cols), _key(seed, i, group_cols, value_cols, weight_col)).alias(f"_v{i}") for i in part])
        each = F.posexplode(F.array(*[F.col(f"_v{i}") for i in part])).alias("draw", "_v")
        picked = picked.select(*group_cols, each).select(*group_cols, (F.col("draw") + first).cast("long").alias("draw"), "_v.*")
        out = picked if out is None else out.unionByName(picked)
    return out


def _key(seed: int, draw: int, group_cols, value_cols, weight_col: str):
    name = F.concat_ws(":", F.lit(str(seed)), F.lit(str(draw)), *[F.col(c).cast("string") for c in (*group_cols, *value_cols)])
    u = (F.conv(F.substr(F.md5(name), F.lit(1), F.lit(13)), 16, 10).cast("bigint") + 1) / F.lit(float(16 ** 13))
    return -F.log(u) / F.col(weight_col).cast("double")
