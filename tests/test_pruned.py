"""Exact search with skipped blocks against the plain exact search."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sifter.operators import knn as K
from sifter.operators import pruned
from sifter.operators.knn import knn


@pytest.mark.parametrize("metric,clustered", [("cosine", True), ("l2", True), ("l2", False)])
def test_pruned_equals_exact(spark, tmp_path, metric, clustered):
    rng = np.random.default_rng(12)
    centers = rng.normal(size=(25, 8)) * (4 if clustered else 0)
    m = centers[rng.integers(0, 25, 3000)] + rng.normal(size=(3000, 8)) * 0.2
    m[50:80] = m[50]  # ties beyond k
    rows = [(i, [float(x) for x in v], f"r{i}") for i, v in enumerate(m)] + [(9000, None, "none"), (9001, [0.0] * 8, "zero")]
    corpus = spark.createDataFrame(rows, "id long, embedding array<double>, label string")
    pruned.build(corpus, f"{tmp_path}/p", metric=metric, carry=["label"], n_pivots=20, block_rows=60)
    qs = corpus.where("id < 60 or id >= 9000").select(F.col("id").alias("qid"), "embedding")
    got, looked = pruned.search(spark, f"{tmp_path}/p", qs, 4, carry=["label"])
    want = knn(qs, corpus, 4, metric=metric, carry=["label"])
    key = lambda r: (r.qid, r["rank"], r.id, r.distance, r.label)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert not clustered or pruned.skipped(looked) > 0.7


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_many_questions_are_not_copied_for_their_blocks(spark, tmp_path, monkeypatch, metric):
    """Without structure a question looks at nearly all blocks: it has a bit for each, and rows and questions meet where they are."""
    monkeypatch.setattr(pruned, "COPIED_BYTES", 1 << 10)
    monkeypatch.setattr(K, "_BLOCK", 150)
    scored, plain = [], pruned._ranked
    monkeypatch.setattr(pruned, "_ranked", lambda cand, *a: scored.append(cand) or plain(cand, *a))
    rng = np.random.default_rng(14)
    m = rng.normal(size=(900, 8))
    m[50:80] = m[50]  # ties beyond k
    rows = [(i, [float(x) for x in v], f"r{i}") for i, v in enumerate(m)] + [(9000, None, "none"), (9001, [0.0] * 8, "zero")]
    corpus = spark.createDataFrame(rows, "id long, embedding array<double>, label string")
    pruned.build(corpus, f"{tmp_path}/p", metric=metric, carry=["label"], n_pivots=5, block_rows=30)
    qs = corpus.select(F.col("id").alias("qid"), "embedding")
    got, looked = pruned.search(spark, f"{tmp_path}/p", qs, 4, carry=["label"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, knn(qs, corpus, 4, metric=metric, carry=["label"]).collect()))
    assert pruned.skipped(looked) < 0.5 and "_asked" not in scored[0]._jdf.queryExecution().toString()


def test_pruned_with_fewer_rows_than_k_and_none(spark, tmp_path):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "qid long, embedding array<double>")
    for i, (rows, want) in enumerate([([], []), ([(5, None)], []), ([(5, [1.0, 0.1]), (3, [1.0, 0.1])], [(1, 1, 3), (1, 2, 5)])]):
        pruned.build(spark.createDataFrame(rows, "id long, embedding array<double>"), f"{tmp_path}/{i}")
        got, _ = pruned.search(spark, f"{tmp_path}/{i}", q, 3)
        assert [(r.qid, r["rank"], r.id) for r in sorted(got.collect())] == want


def test_questions_of_a_block_are_scored_as_they_come():
    rng = np.random.default_rng(3)
    m, taken = rng.normal(size=(40, 4)), []

    def batch(first: int, n: int, ring: int, asked: bool) -> pa.RecordBatch:
        i = np.arange(first, first + n)
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_pydict({"id": none if asked else pa.array(i), "_vec": pa.array([list(m[j % 40]) for j in i]), "qid": pa.array(i) if asked else none,
                                           "_pivot": pa.array([0] * n, pa.int64()), "_ring": pa.array([ring] * n, pa.int64()), "_asked": pa.array([asked] * n)})

    def given():
        for x in [batch(0, 15, 0, False), batch(15, 15, 0, False), *[batch(b, 10, 0, True) for b in range(0, 90, 10)], batch(30, 10, 1, False), batch(0, 10, 1, True)]:
            taken.append(x)
            yield x

    out = pruned.block_scorer("qid", ["id"], [], 4, 2, "l2")(given())
    got = [next(out)]
    assert len(taken) == 3  # the block's two batches and the first of its questions
    got = pa.Table.from_batches([*got, *out]).to_pandas()
    assert len(taken) == 13 and len(got) == 2 * 100
    for r in got.itertuples():
        assert abs(((m[r.qid % 40] - m[r.id]) ** 2).sum() - r.distance) < 1e-9
    own = got[got["distance"] == 0]
    assert set(own["qid"]) == {q for q in range(90) if q % 40 < 30} and (own["id"] == own["qid"] % 40).all()
