"""Vector expressions over ``array<float>`` / ``array<double>`` columns.

Spark 4.1 has no built-in vector distance, so these fold with higher-order
functions; every product is taken in double. They are the SQL form used in
row-wise scoring (one pair per row). Nearest-neighbour search over many pairs
uses the blocked matrix form in ``sifter.operators.knn`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    prods = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a, b) -> Column:
    """``1 - cos(a, b)``; null when either vector has zero norm."""
    den = norm(a) * norm(b)
    return F.when(den > 0, F.lit(1.0) - dot(a, b) / den)


def squared_l2(a, b) -> Column:
    diffs = F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(diffs, F.lit(0.0).cast("double"), lambda acc, v: acc + v * v)


def distance(a, b, metric: str = "cosine") -> Column:
    if metric == "cosine":
        return cosine_distance(a, b)
    if metric == "l2":
        return squared_l2(a, b)
    raise ValueError(f"unknown metric {metric!r}")


def round_distance(c, digits: int = 6) -> Column:
    """Round and fold ``-0.0`` into ``0.0`` so equal results hash equal."""
    return F.round(_c(c), digits) + F.lit(0.0)


def l2_normalize(a) -> Column:
    n = norm(a)
    return F.when(n > 0, F.transform(_c(a), lambda x: (x.cast("double") / n).cast("float")))
