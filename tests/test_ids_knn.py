import numpy as np
import pytest
from pyspark.sql import functions as F

from sifter.operators import knn as K
from sifter.operators import quantized
from sifter.operators.ann import ann_knn, build_index, recall, search
from sifter.operators.ids import dense_chunk_ids, dense_index, running_offsets
from sifter.operators.knn import knn
from sifter.session import checkpoint_dir


def test_running_offsets_equal_global_row_order(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), int(n)) for i, n in zip(rng.permutation(500), rng.integers(0, 5, 500))]
    df = spark.createDataFrame(rows, "k long, n long")
    got = {r.k: r.offset for r in running_offsets(df, "k", "n").collect()}
    acc = 0
    for k, n in sorted(rows):
        assert got[k] == acc
        acc += n


def test_dense_chunk_ids_are_0_to_n(spark):
    df = spark.createDataFrame([(3, ["a", "b"]), (1, ["c"]), (2, []), (7, ["d", "e", "f"])], "doc long, chunks array<string>")
    out = dense_chunk_ids(df, "chunks", "doc").orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.doc, r.chunk_pos) for r in out] == [(0, 1, 0), (1, 3, 0), (2, 3, 1), (3, 7, 0), (4, 7, 1), (5, 7, 2)]


def _vectors(spark, n, dim, seed):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim)).astype(np.float32)
    m[5] = m[4]  # an exact duplicate: tie broken by id
    rows = [(i, [float(x) for x in m[i]]) for i in range(n)]
    rows.append((n, None))  # null vector is skipped
    return spark.createDataFrame(rows, "id long, embedding array<float>"), m


def _brute(m, q, k, metric):
    M, Q = m.astype(np.float64), q.astype(np.float64)
    if metric == "cosine":
        d = 1 - (Q / np.linalg.norm(Q, axis=1)[:, None]) @ (M / np.linalg.norm(M, axis=1)[:, None]).T
    else:
        d = ((Q[:, None, :] - M[None, :, :]) ** 2).sum(-1)
    d = np.round(d, 6) + 0.0
    return {(qi, r + 1): int(j) for qi in range(len(Q))
            for r, j in enumerate(sorted(range(len(M)), key=lambda j: (d[qi, j], j))[:k])}


def test_knn_plans_equal_brute_force(spark):
    corpus, m = _vectors(spark, 300, 8, 1)
    qdf, q = _vectors(spark, 20, 8, 2)
    qdf = qdf.withColumnRenamed("id", "qid").where(F.col("qid") < 20)
    for metric in ("cosine", "l2"):
        want = _brute(m, q[:20], 4, metric)
        for plan in ("broadcast", "tiled"):
            got = knn(qdf, corpus, 4, q_id="qid", c_id="id", metric=metric, plan=plan).collect()
            assert {(r.qid, r["rank"]): r.id for r in got} == want, (metric, plan)


def test_ann_recall(spark):
    corpus, m = _vectors(spark, 400, 8, 5)
    qdf = corpus.where(F.col("id") < 40).withColumnRenamed("id", "qid")
    exact = knn(qdf, corpus, 5, q_id="qid", c_id="id")
    full = ann_knn(qdf, corpus, 5, q_id="qid", c_id="id", nlist=4, nprobe=4, block_rows=30)
    assert recall(full, exact, "qid", "id") == 1.0  # every cell probed, cells split in blocks
    part = ann_knn(qdf, corpus, 5, q_id="qid", c_id="id", nlist=8, nprobe=3)
    assert recall(part, exact, "qid", "id") >= 0.4


def test_dense_index_with_many_partitions_and_a_constant_first_key(spark):
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.createDataFrame([("same", f"k{i:04d}", i) for i in range(1000)][::-1], "a string, b string, n long")
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        got = {r.b: r.at for r in dense_index(df, ["a", "b"], "at").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
    assert got == {f"k{i:04d}": i for i in range(1000)}


@pytest.mark.parametrize("plan", ["broadcast", "tiled"])
def test_knn_ranks_small_distances_and_wide_ids(spark, plan):
    corpus = spark.createDataFrame([(2**44 + 5, 0, [0.0006, 0.0]), (5, 0, [0.0001, 0.0]), (5, 1, None)], "doc long, pos long, embedding array<double>")
    q = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "qid long, embedding array<double>")
    got = knn(q, corpus, 2, c_id=("doc", "pos"), metric="l2", plan=plan).collect()
    assert [(r.qid, r["rank"], r.doc, r.pos, r.distance) for r in sorted(got)] == [(1, 1, 5, 0, 0.0), (1, 2, 2**44 + 5, 0, 0.0)]


@pytest.mark.parametrize("plan", ["broadcast", "tiled", "ann"])
def test_questions_without_vectors_match_nothing(spark, plan):
    corpus, _ = _vectors(spark, 40, 6, 2)
    q = spark.createDataFrame([(1, None), (2, None)], "qid long, embedding array<float>")
    got = ann_knn(q, corpus, 3, nlist=2) if plan == "ann" else knn(q, corpus, 3, plan=plan)
    assert got.collect() == []


def test_running_topk_keeps_k_for_each_question():
    import pandas as pd
    rng = np.random.default_rng(1)
    Q = rng.normal(size=(10, 4))
    batches = [pd.DataFrame({"id": range(i * 500, i * 500 + 500), "v": list(rng.normal(size=(500, 4)))}) for i in range(8)]
    prepared, q_sq, _ = K._prepare(Q, "cosine")
    out = list(K._running_topk((K._scored(b, "v", ["id"], [], "qid", np.arange(10), prepared, q_sq, 2, "cosine") for b in batches), "qid", ["id"], 2))
    assert len(out) == 1 and len(out[0]) == 20  # one frame a task: k for each question
    allv = np.vstack([np.stack(b["v"]) for b in batches])
    d = 1 - (allv / np.linalg.norm(allv, axis=1, keepdims=True)) @ prepared.T
    assert {(r.qid, r.id) for r in out[0].itertuples()} == {(j, int(i)) for j in range(10) for i in np.argsort(d[:, j])[:2]}


def test_stored_index_is_reopened_and_pruned(spark, tmp_path):
    corpus, m = _vectors(spark, 400, 8, 9)
    build_index(corpus, f"{tmp_path}/ix", nlist=8)
    one = spark.createDataFrame([(7, [float(x) for x in m[7]])], "qid long, embedding array<float>")
    hit = search(spark, f"{tmp_path}/ix", one, 3, nprobe=2)
    assert hit.first()["id"] == 7
    plan = hit._jdf.queryExecution().toString()
    assert "PartitionFilters: [_cell" in plan.replace("isnotnull(_cell", "[_cell") or "_cell#" in plan and "PartitionFilters: []" not in plan
    everything = corpus.select(F.col("id").alias("qid"), "embedding")
    exact = knn(everything, corpus, 5)
    assert recall(search(spark, f"{tmp_path}/ix", everything, 5, nprobe=6), exact, "qid", "id") >= 0.9


def test_quantized_search_at_two_sizes(spark):
    """Nine in ten neighbours on the queries' own rows; rows scored in full grow slower than the corpus."""
    from conftest import SF01

    from sifter.plans.misc import q_knn_ann
    need = {}
    for sf in (SF01, SF01.replace("0.01", "0.1")):
        emb = spark.read.parquet(f"{sf}/embeddings.parquet")
        exact = knn(emb.select(F.col("vec_id").alias("qid"), "embedding"), emb, 5, q_id="qid", c_id="vec_id")
        assert recall(q_knn_ann(spark, sf), exact, "qid", "vec_id") >= 0.9
        path = f"{checkpoint_dir(spark)}/quantized-{emb.count()}"
        quantized.build(emb, path, "vec_id")
        s = quantized.settings(spark, path)
        need[s["n"]] = s["rerank"]
    (small, few), (large, more) = sorted(need.items())
    assert few * 4 <= small and more * 4 <= large and more / few < large / small


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_quantized_search_in_clusters_probes_few_cells(spark, tmp_path, metric):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(40, 12)) * 3
    m = centers[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 12)) * 0.2
    rows = [("a", f"k{i}", [float(x) for x in v], i) for i, v in enumerate(m)] + [("a", "none", None, -1), ("a", "zero", [0.0] * 12, -2), ("b", "k4", [float(x) for x in m[4]], 4)]
    corpus = spark.createDataFrame(rows, "part string, key string, embedding array<float>, label long")
    quantized.build(corpus, f"{tmp_path}/q", ["part", "key"], metric=metric, carry=["label"], nlist=20)
    s = quantized.settings(spark, f"{tmp_path}/q")
    assert s["nprobe"] <= 5 and s["rerank"] < 1000
    qs = corpus.where("label < 100").select(F.concat("part", "key").alias("qid"), "embedding")
    exact = knn(qs, corpus, 6, c_id=["part", "key"], metric=metric, carry=["label"])
    got = quantized.search(spark, f"{tmp_path}/q", qs, 6, c_id=["part", "key"], carry=["label"]).collect()
    want = {(r.qid, r.part, r.key): (r.distance, r.label) for r in exact.collect()}
    found = [r for r in got if (r.qid, r.part, r.key) in want]
    assert len(found) >= 0.9 * len(want) and all(want[r.qid, r.part, r.key] == (r.distance, r.label) for r in found)
    whole = quantized.search(spark, f"{tmp_path}/q", qs, 6, c_id=["part", "key"], carry=["label"], nprobe=20, rerank=5000).collect()
    assert {(r.qid, r["rank"], r.part, r.key) for r in whole} == {(r.qid, r["rank"], r.part, r.key) for r in exact.collect()}


@pytest.mark.parametrize("nprobe", [1, 3, 6])
def test_many_questions_meet_cells_without_copies(spark, monkeypatch, nprobe):
    """The same rows as from a copy of each question for each block it is scored in."""
    from sifter.operators import ann
    emb, _ = _vectors(spark, 500, 8, 21)
    emb = emb.union(emb.where("id < 20"))  # ids that repeat
    args = dict(c_id="id", nlist=6, nprobe=nprobe, block_rows=20)
    qs = emb.select(F.col("id").alias("qid"), "embedding").where("qid >= 20")
    want = sorted(map(tuple, ann_knn(qs, emb, 4, **args).collect()))
    monkeypatch.setattr(ann, "COPIED_BYTES", 1 << 10)
    monkeypatch.setattr(ann, "tile_scorer", None)  # scores copies
    monkeypatch.setattr(K, "_BLOCK", 70)
    assert sorted(map(tuple, ann_knn(qs, emb, 4, **args).collect())) == want


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_many_questions_meet_blocks_of_codes(spark, tmp_path, monkeypatch, metric):
    """Beyond QUESTION_BYTES there is no scan for each block of questions, and no row for each candidate."""
    def refused(*a):
        raise AssertionError("candidates are joined to the vectors")
    monkeypatch.setattr(quantized, "QUESTION_BYTES", 1 << 10)
    monkeypatch.setattr(quantized, "_search_block", refused)
    monkeypatch.setattr(K, "_BLOCK", 300)
    rng = np.random.default_rng(9)
    m = rng.normal(size=(8, 12))[rng.integers(0, 8, 1500)] + rng.normal(size=(1500, 12)) * 0.3
    rows = [("a", f"k{i}", [float(x) for x in v], i) for i, v in enumerate(m)] + [("a", "none", None, -1), ("a", "zero", [0.0] * 12, -2), ("b", "k4", [float(x) for x in m[4]], 4)]
    corpus = spark.createDataFrame(rows, "part string, key string, embedding array<float>, label long")
    quantized.build(corpus, f"{tmp_path}/q", ["part", "key"], metric=metric, carry=["label"], nlist=10)
    qs = corpus.select(F.concat("part", "key").alias("qid"), "embedding")
    want = {tuple(r) for r in knn(qs, corpus, 6, c_id=["part", "key"], metric=metric, carry=["label"]).collect()}
    args = dict(c_id=["part", "key"], carry=["label"])
    got = quantized.search(spark, f"{tmp_path}/q", qs, 6, **args).collect()
    assert len(got) == len({tuple(r) for r in got}) == len(want)
    assert len({(r[0], r[2], r[3], r[4]) for r in got} & {(r[0], r[2], r[3], r[4]) for r in want}) >= 0.9 * len(want)
    assert {tuple(r) for r in quantized.search(spark, f"{tmp_path}/q", qs, 6, **args, nprobe=10, rerank=5000).collect()} == want


def test_quantized_index_of_few_and_no_rows(spark, tmp_path):
    schema = "id long, embedding array<double>"
    q = spark.createDataFrame([(1, [1.0, 0.5, 0.0]), (2, None)], "qid long, embedding array<double>")
    for i, (rows, want) in enumerate([([], []), ([(5, None)], []), ([(5, [0.0, 0.0, 0.0])], []), ([(5, [1.0, 0.5, 0.1]), (3, [1.0, 0.5, 0.1]), (4, None)], [(1, 1, 3), (1, 2, 5)])]):
        quantized.build(spark.createDataFrame(rows, schema), f"{tmp_path}/{i}")
        got = quantized.search(spark, f"{tmp_path}/{i}", q, 3).collect()
        assert [(r.qid, r["rank"], r.id) for r in sorted(got)] == want


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_ties_take_bounded_memory_and_go_to_the_smallest_ids(metric):
    import tracemalloc

    import pandas as pd
    rng = np.random.default_rng(4)
    one, n, nq, dim = rng.normal(size=256), 10_000, 400, 256
    pdf = pd.DataFrame({"id": rng.permutation(n), "v": [one] * n})
    Q, q_sq, _ = K._prepare(rng.normal(size=(nq, dim)), metric)
    tracemalloc.start()
    out = K._scored(pdf, "v", ["id"], [], "qid", np.arange(nq), Q, q_sq, 3, metric)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6
    assert out.groupby("qid")["id"].apply(sorted).tolist() == [[0, 1, 2]] * nq


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_product_distances_equal_those_taken_pair_by_pair(metric):
    """Hashed-like vectors: many exact ties, near ties and orthogonal pairs."""
    rng = np.random.default_rng(6)
    C = rng.poisson(0.15, size=(3000, 64)).astype(float)
    C[100:200] = C[0:100] * 3  # the same direction
    Q = np.vstack([C[:60], rng.poisson(0.15, size=(40, 64)).astype(float)])
    C, c_sq, ok = K._prepare(C, metric)
    Q, q_sq, okq = K._prepare(Q, metric)
    C, c_sq, Q, q_sq = C[ok], c_sq[ok], Q[okq], q_sq[okq]
    r, c, d = K._local_topk(C, c_sq, Q, q_sq, 7, metric)
    for j in range(len(Q)):
        exact = K._distinct(1.0 - np.einsum("ij,j->i", C, Q[j]) if metric == "cosine" else ((C - Q[j]) ** 2).sum(1), metric)
        best = np.lexsort((np.arange(len(C)), exact))[:7]
        got = sorted(zip(d[c == j], r[c == j]))
        assert [x[1] for x in got] == best.tolist() and np.array_equal([x[0] for x in got], exact[best])


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_single_precision_screening_keeps_the_exact_order(metric):
    """Rows nearer to each other than single precision tells, with and without a limit."""
    rng = np.random.default_rng(11)
    C = 1000 + rng.normal(size=(600, 16)) * 1e-3
    C[300:] = 1e-9 * rng.normal(size=(300, 16))
    Q = np.vstack([C[:20], C[310:330]])
    C, c_sq, _ = K._prepare(C, metric)
    Q, q_sq, _ = K._prepare(Q, metric)
    exact = np.array([K._distinct(1.0 - np.einsum("ij,j->i", C, q) if metric == "cosine" else ((C - q) ** 2).sum(1), metric) for q in Q])
    limit = np.sort(exact, axis=1)[:, 3]
    for given, most in ((None, 5), (limit, 4)):
        r, c, d = K._local_topk(C, c_sq, Q, q_sq, 5, metric, given)
        for j in range(len(Q)):
            best = np.lexsort((np.arange(len(C)), exact[j]))[:5]
            best = best[exact[j][best] <= (np.inf if given is None else given[j])]
            assert len(best) >= most - 1 and r[c == j].tolist() == best.tolist() and np.array_equal(d[c == j], exact[j][best])


def test_many_questions_meet_blocks_and_candidates_do_not_grow_with_partitions(spark, monkeypatch):
    corpus, _ = _vectors(spark, 400, 8, 3)
    corpus = corpus.where("id <> 5").withColumn("label", F.concat(F.lit("r"), "id")).withColumn("id", F.col("id").bitwiseAND(F.lit(~1))).repartition(60)  # ids repeat
    qs, _ = _vectors(spark, 120, 8, 4)
    qs = qs.withColumnRenamed("id", "qid")
    want = knn(qs, corpus, 3, carry=["label"], plan="broadcast").collect()
    monkeypatch.setattr(K, "_BLOCK", 32)
    made = []
    tiled = K._tiled_candidates
    monkeypatch.setattr(K, "_tiled_candidates", lambda *a: made.append(tiled(*a)) or made[0])
    got = knn(qs, corpus, 3, carry=["label"]).collect()
    assert sorted(got) == sorted(want) and len(got) == 360
    assert made[0].count() <= 2 * spark.sparkContext.defaultParallelism * 3 * 120
