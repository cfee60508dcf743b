"""Approximate nearest neighbours: a stored inverted file over k-means cells.

``build_index`` writes two tables below a path:

- ``cells``: every corpus row with a vector, partitioned by its nearest
  centroid. k-means (``pyspark.ml``, distributed) is fitted on a sample of at
  most ``SAMPLE_PER_CELL`` rows a cell, chosen by a hash of the id; every row is
  indexed, whatever the sample.
- ``centroids``: per cell its centre and number of rows. ``nlist`` is by
  default the square root of the rows over eight, so that both the centres and
  a cell stay small against the corpus.

``search`` reads the centres (a bounded broadcast: ``nlist`` rows), sends each
question to its ``nprobe`` nearest cells and reads those partitions only. A cell
of more than ``block_rows`` is scored in blocks dealt by a hash of the id, so a
cell that holds a third of the corpus is still scored in bounded pieces. Each
(cell, block) is co-grouped with its questions and scored exactly; then a global
``row_number() <= k``. If the copies of the questions that this takes are more
than COPIED_BYTES, rows and questions are packed and meet by a Cartesian product
instead (``knn.met_by_cell``): a question scores its cells' rows where they are, as
many blocks of a cell at once as a packed one holds, and nothing is copied.

Only candidates in probed cells are scored, so recall below 1 is possible; the
result rows are exact distances of the candidates found.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.operators.knn import _candidate_schema, _ids, _matrix, _ranked, met_by_cell, tile_scorer
from sifter.session import scratch_path

#: The k-means sample: rows for each cell, at most.
SAMPLE_PER_CELL = 256
#: Copies of questions, one for each block they are scored in, that are shuffled, at most.
COPIED_BYTES = 64 << 20


def _unit(M: np.ndarray) -> np.ndarray:
    return M / np.maximum(np.linalg.norm(M, axis=1, keepdims=True), 1e-12)


def _assigned(vec: str, centers, metric: str, n: int, out_col: str):
    """Adds the ``n`` nearest cells of each row (an array for n > 1)."""
    def assign(batches):
        C = centers.value
        half = 0.0 if metric == "cosine" else 0.5 * (C ** 2).sum(1)
        for pdf in batches:
            M = _matrix(pdf[vec], C.shape[1])
            near = (_unit(M) if metric == "cosine" else M) @ C.T - half
            cells = np.argsort(-near, axis=1, kind="stable")[:, :n].astype(np.int64)
            yield pdf.assign(**{out_col: list(cells) if n > 1 else cells[:, 0] if len(cells) else cells.ravel()})
    return assign


def cell_centers(rows: DataFrame, ids: Sequence[str], c_vec: str, metric: str, nlist: int, n: int, seed: int = 7, max_iter: int = 20) -> np.ndarray:
    """Centres of ``nlist`` cells (two at least), learned from at most about
    SAMPLE_PER_CELL rows a cell of the ``n`` rows; a zero one without vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    from sifter.functions.vectors import l2_normalize
    u = F.pmod(F.xxhash64(*ids, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    unit = l2_normalize(c_vec) if metric == "cosine" else F.col(c_vec)
    train = (rows.where(u < min(1.0, nlist * SAMPLE_PER_CELL / max(n, 1))).select(unit.alias("_u"))
                 .where(F.col("_u").isNotNull()).select(array_to_vector("_u").alias("features"))).persist()
    try:
        distinct = train.distinct().limit(2).collect()
        if not distinct:
            dim = rows.agg(F.max(F.size(c_vec))).first()[0] or 1
            centers = np.zeros((1, max(dim, 1)))
        elif len(distinct) == 1:  # k-means does not take a single point
            centers = np.array([distinct[0]["features"].toArray()])
        else:
            centers = np.asarray(KMeans(k=max(nlist, 2), seed=seed, maxIter=max_iter, featuresCol="features").fit(train).clusterCenters())
    finally:
        train.unpersist()
    return _unit(centers) if metric == "cosine" else centers


def build_index(corpus: DataFrame, path: str, c_id: str | Sequence[str] = "id", c_vec: str = "embedding", metric: str = "cosine",
                carry: Sequence[str] = (), nlist: int | None = None, seed: int = 7, max_iter: int = 20) -> None:
    """Writes the index of ``corpus`` to ``path``; rows without a vector are not in it."""
    spark, ids = corpus.sparkSession, _ids(c_id)
    rows = corpus.select(*ids, c_vec, *[c for c in carry if c not in ids])
    n = rows.where(F.col(c_vec).isNotNull()).count()
    nlist = nlist or max(1, math.isqrt(n) // 8)
    centers = cell_centers(rows, ids, c_vec, metric, nlist, n, seed, max_iter)
    bc = spark.sparkContext.broadcast(centers)
    schema = T.StructType([*rows.schema.fields, T.StructField("_cell", T.LongType())])
    cells = rows.mapInPandas(_assigned(c_vec, bc, metric, 1, "_cell"), schema) if n else rows.withColumn("_cell", F.lit(0).cast("bigint"))
    cells = cells.where(F.col(c_vec).isNotNull())
    cells.repartition("_cell", F.pmod(F.xxhash64(*ids), F.lit(8))).write.partitionBy("_cell").parquet(f"{path}/cells")
    stored = spark.read.schema(schema).parquet(f"{path}/cells") if n else cells
    counts = {r["_cell"]: r["n"] for r in stored.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # nlist rows
    table = [(i, [float(x) for x in c], counts.get(i, 0)) for i, c in enumerate(centers)]
    spark.createDataFrame(table, "cell bigint, center array<double>, n bigint").coalesce(1).write.parquet(f"{path}/centroids")
    spark.createDataFrame([], rows.schema).write.parquet(f"{path}/schema")


def search(spark: SparkSession, path: str, questions: DataFrame, k: int, *, q_id: str = "qid", c_id: str | Sequence[str] = "id",
           q_vec: str = "embedding", c_vec: str = "embedding", metric: str = "cosine", carry: Sequence[str] = (),
           nprobe: int = 4, block_rows: int = 50_000, round_digits: int | None = 6) -> DataFrame:
    """(q_id, rank, *c_id, distance, *carry) from the index at ``path``."""
    ids = _ids(c_id)
    carry = [c for c in carry if c not in ids]
    table = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()  # nlist rows
    centers = np.array([r["center"] for r in table])
    rows = spark.read.parquet(f"{path}/schema")
    schema = _candidate_schema(questions.schema[q_id], rows, ids, carry)
    if not sum(r["n"] for r in table):
        return _ranked(spark.createDataFrame([], schema), k, q_id, ids, carry, "rank", round_digits)
    bc = spark.sparkContext.broadcast(centers)
    n = min(nprobe, len(table))
    qs = questions.select(q_id, q_vec)
    kind = T.ArrayType(T.LongType()) if n > 1 else T.LongType()
    near = qs.mapInPandas(_assigned(q_vec, bc, metric, n, "_near"), T.StructType([*qs.schema.fields, T.StructField("_near", kind)]))
    near = near.where(F.col(q_vec).isNotNull()).withColumn("_near", F.col("_near") if n > 1 else F.array("_near")).checkpoint()
    pieces = F.lit(sum(-(-r["n"] // block_rows) for r in table) / len(table))  # of a cell, about
    if near.agg(F.coalesce(F.sum(F.size("_near") * pieces), F.lit(0.0))).first()[0] * (8 * centers.shape[1] + 64) > COPIED_BYTES:
        probed = [r["_cell"] for r in near.select(F.explode("_near").alias("_cell")).distinct().collect()]  # at most nlist
        cells = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_cell", T.LongType())])).parquet(f"{path}/cells").where(F.col("_cell").isin(probed))
        cand = met_by_cell(near, cells, k, q_id=q_id, ids=ids, q_vec=q_vec, c_vec=c_vec, metric=metric, carry=carry, dim=centers.shape[1],
                           cell=["_cell"], asks=_probing, schema=schema)
        return _ranked(cand, k, q_id, ids, carry, "rank", round_digits)
    near = near.select(q_id, q_vec, F.explode("_near").alias("_cell"))
    blocks = F.broadcast(spark.createDataFrame([(r["cell"], -(-r["n"] // block_rows)) for r in table], "_cell bigint, _s bigint").where("_s > 0"))
    probed = [r["_cell"] for r in near.select("_cell").distinct().collect()]  # at most nlist
    cells = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_cell", T.LongType())])).parquet(f"{path}/cells")
    cells = (cells.where(F.col("_cell").isin(probed)).select(*ids, c_vec, *carry, "_cell").join(blocks, "_cell")
                  .withColumn("_blk", F.pmod(F.xxhash64(*ids), F.col("_s"))).drop("_s"))
    near = near.join(blocks, "_cell").withColumn("_blk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_s") - 1))).drop("_s")
    tile = tile_scorer(q_id, ids, q_vec, c_vec, metric, carry, centers.shape[1], k, schema)
    cand = cells.groupBy("_cell", "_blk").cogroup(near.groupBy("_cell", "_blk")).applyInPandas(tile, schema)
    return _ranked(cand, k, q_id, ids, carry, "rank", round_digits)


def _probing(questions):
    """Of a block of questions those that probe a cell, by its number."""
    near = np.stack(questions["_near"].to_numpy())

    def who(cell: tuple[int]):
        there = (near == cell[0]).any(axis=1)
        return None if there.all() else np.flatnonzero(there)
    return who


def ann_knn(questions: DataFrame, corpus: DataFrame, k: int, *, q_id: str = "qid", c_id: str | Sequence[str] = "id",
            q_vec: str = "embedding", c_vec: str = "embedding", metric: str = "cosine", carry: Sequence[str] = (),
            nlist: int | None = None, nprobe: int = 4, block_rows: int = 50_000, seed: int = 7,
            round_digits: int | None = 6, max_iter: int = 20) -> DataFrame:
    """An index in the shared folder for one search."""
    spark = corpus.sparkSession
    path = scratch_path(spark, "ann")
    build_index(corpus, path, c_id, c_vec, metric, carry, nlist, seed, max_iter)
    return search(spark, path, questions, k, q_id=q_id, c_id=c_id, q_vec=q_vec, c_vec=c_vec, metric=metric, carry=carry,
                  nprobe=nprobe, block_rows=block_rows, round_digits=round_digits)


def recall(approx: DataFrame, exact: DataFrame, q_id: str, c_id: str) -> float:
    """Share of exact (question, neighbour) pairs the approximate result found."""
    hit = exact.join(approx.select(q_id, c_id), [q_id, c_id], "left_semi").count()
    total = exact.count()
    return hit / total if total else 1.0
