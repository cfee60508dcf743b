"""Registry of every query the driver runs, and of their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from sifter.session import checkpoint_dir, ship_package
        ship_package(spark)
        checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Query]:
    from sifter.plans import misc, pages, rag, retrieval, sources, streams
    out: dict[str, Query] = {}
    for mod in (retrieval, pages, rag, sources, streams, misc):
        out.update({k: _shipped(v) for k, v in mod.QUERIES.items()})
    return out


def all_oracle_sql() -> dict[str, str]:
    from sifter.plans.oracle_sql import SQL
    names = all_queries()
    return {k: v for k, v in SQL.items() if k in names and v}
