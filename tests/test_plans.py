"""Plan-shape checks for the scale properties the design relies on."""

import __spark_entry__ as E

from conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_knn_has_no_pair_join_and_limits_before_the_shuffle(spark):
    p = _plan(E.queries()["knn_topk_sweep"](spark, SF001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "MapInPandas" in p and p.count("WindowGroupLimit") >= 2  # partial + final top-k


def test_grid_has_no_cross_join(spark):
    p = _plan(E.queries()["benchmark_grid"](spark, SF001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scans_read_only_needed_columns(spark):
    p = _plan(E.queries()["keywords_topn"](spark, SF001))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p
    p2 = _plan(E.queries()["knn_l2"](spark, SF001))
    assert "n_chars" not in p2
