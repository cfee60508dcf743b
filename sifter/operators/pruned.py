"""Exact nearest neighbours that skip blocks by the triangle inequality.

``build`` assigns every row to its nearest pivot (k-means centres of a bounded
sample, as in ``ann``) and cuts a pivot's rows into rings by their distance to
it (approximate quantiles; a ring has about ``block_rows`` rows). The rows are
stored by pivot and ring, and a small table holds for each block the least and
the largest distance of its rows to every pivot.

``search`` bounds the distance of a question to a block from below: by the
triangle inequality it is at least what the question's distance to a pivot lies
outside the block's range for that pivot, for each pivot. The nearest blocks
that hold k rows are scored first, which gives a distance that the k-th
neighbour cannot exceed; of the others only those whose bound is within it are
scored, ties included. For these a question has a bit for each block, and if its
copies for all of them are more than COPIED_BYTES, rows and questions meet in
packed blocks (``knn.met_by_cell``). The result equals ``knn``'s. ``skipped`` tells what
share of the pairs of questions and blocks was never looked at: most of them in
vectors that cluster, hardly any in vectors without structure in many
dimensions, where an exact search has to look everywhere.

Cosine distances are compared as lengths of chords between unit vectors, which
obey the inequality. Rows and questions without a vector (cosine: also a zero
one) match nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.operators.ann import COPIED_BYTES, cell_centers
from sifter.operators.knn import _candidate_schema, _ids, _local_topk, _matrix, _non_null, _prepare, _ranked, met_by_cell
from sifter.session import checkpoint_dir

SLACK = 1e-7  # of a bound, for rounding: blocks are skipped beyond it alone


def _to_pivots(values, pivots: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    """(distance of each valid row to every pivot, valid rows)."""
    m, sq, ok = _prepare(_matrix(values, pivots.shape[1]), metric, _non_null(values))
    m = m[ok]
    return np.sqrt(np.maximum((m ** 2).sum(1)[:, None] + (pivots ** 2).sum(1) - 2 * m @ pivots.T, 0.0)), ok


def build(corpus: DataFrame, path: str, c_id: str | Sequence[str] = "id", c_vec: str = "embedding", metric: str = "cosine",
          carry: Sequence[str] = (), n_pivots: int | None = None, block_rows: int = 10_000, seed: int = 7) -> None:
    """Writes the blocks of ``corpus`` to ``path``; rows without a vector are in none."""
    spark, ids = corpus.sparkSession, _ids(c_id)
    checkpoint_dir(spark)
    rows = corpus.select(*ids, c_vec, *[c for c in carry if c not in ids])
    n, _ = rows.agg(F.count(c_vec), F.max(F.size(c_vec))).first()
    n_pivots = n_pivots or max(2, min(64, math.isqrt(n) // 8))
    pivots = cell_centers(rows, ids, c_vec, metric, n_pivots, n, seed, max_iter=5)
    spark.createDataFrame([(i, [float(x) for x in p], metric) for i, p in enumerate(pivots)], "pivot bigint, center array<double>, metric string").coalesce(1).write.parquet(f"{path}/pivots")
    given = spark.sparkContext.broadcast(pivots)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            d, ok = _to_pivots(pdf[c_vec], given.value, metric)
            if ok.any():
                yield pdf[ok].assign(_pivot=d.argmin(1).astype(np.int64), _to=list(d))

    schema = T.StructType([*rows.schema.fields, T.StructField("_pivot", T.LongType()), T.StructField("_to", T.ArrayType(T.DoubleType()))])
    d = rows.mapInPandas(placed, schema).withColumn("_own", F.element_at("_to", (F.col("_pivot") + 1).cast("int"))).checkpoint()
    sizes = d.groupBy("_pivot").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_own", [x / 1000 for x in range(1, 1000)]).alias("_q"))
    # every so manieth of the quantiles ends a ring; a row a pivot
    rings = F.least(F.ceil(F.col("_n") / F.lit(block_rows)), F.lit(1000))
    sizes = F.broadcast(sizes.select("_pivot", F.transform(F.sequence(F.lit(1), F.greatest(rings, F.lit(2)) - 1), lambda r: F.element_at("_q", F.least(F.ceil(r * 1000 / rings), F.lit(999)).cast("int"))).alias("_ends"), rings.alias("_rings")))
    d = d.join(sizes, "_pivot").withColumn("_ring", F.when(F.col("_rings") > 1, F.size(F.filter("_ends", lambda e: e < F.col("_own")))).otherwise(0).cast("long"))
    d.drop("_to", "_own", "_ends", "_rings").repartition("_pivot", "_ring").write.partitionBy("_pivot", "_ring").parquet(f"{path}/rows")
    spans = d.select("_pivot", "_ring", F.posexplode("_to").alias("p", "to")).groupBy("_pivot", "_ring", "p").agg(F.min("to").alias("lo"), F.max("to").alias("hi"), F.count(F.lit(1)).alias("n"))
    spans.coalesce(1).write.parquet(f"{path}/spans")
    rows.limit(0).write.parquet(f"{path}/schema")


def block_scorer(q_id: str, ids: list[str], carry: Sequence[str], dim: int, k: int, metric: str):
    """Candidates of rows (*ids, *carry, _vec, q_id, _pivot, _ring, _asked) in
    the order of the last three. A block's rows are held; its questions are
    scored as they come, however many there are."""
    def prepared(vec: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        values = vec.to_pandas()
        M, sq, ok = _prepare(_matrix(values, dim), metric, _non_null(values))
        return M[ok], sq[ok], np.flatnonzero(ok)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        block = last = None
        for batch in batches:
            key = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_pivot", "_ring", "_asked")], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for a, b in pairwise(cuts):
                run = batch.slice(a, b - a)
                if last != tuple(key[a, :2]):
                    held, block, last = [], None, tuple(key[a, :2])
                if not key[a, 2]:
                    held.append(run)
                    continue
                if block is None:
                    rows = pa.Table.from_batches(held, run.schema).combine_chunks()
                    rows = rows.take(pa.array(rows.select(ids).to_pandas().sort_values(ids).index.to_numpy()))  # ties go to the first row
                    block = rows.select([*ids, *carry]), *prepared(rows["_vec"])
                    held = []
                rows, C, c_sq, at = block
                Q, q_sq, own = prepared(run["_vec"])
                r, c, d = _local_topk(C, c_sq, Q, q_sq, k, metric)
                if len(r):
                    found = rows.take(pa.array(at[r]))
                    found = pa.table({q_id: run[q_id].take(pa.array(own[c])), **{i: found[i] for i in ids}, "distance": d, **{x: found[x] for x in carry}})
                    yield from found.combine_chunks().to_batches()
    return score


def _marked_for(number: dict[tuple[int, int], int]):
    def asks(questions: pd.DataFrame):
        """Of a block of questions those that look at a block, by its pivot and ring."""
        marks = np.stack([np.unpackbits(np.frombuffer(b, np.uint8), count=len(number)) for b in questions["_bits"]]).astype(bool)

        def who(cell: tuple[int, int]):
            there = marks[:, number[cell]]
            return None if there.all() else np.flatnonzero(there)
        return who
    return asks


def search(spark: SparkSession, path: str, questions: DataFrame, k: int, *, q_id: str = "qid", c_id: str | Sequence[str] = "id",
           q_vec: str = "embedding", c_vec: str = "embedding", carry: Sequence[str] = (), round_digits: int | None = 6) -> tuple[DataFrame, DataFrame]:
    """((q_id, rank, *c_id, distance, *carry), (pairs looked at, all pairs of questions and blocks))."""
    ids = _ids(c_id)
    carry = [c for c in carry if c not in ids]
    pivots = spark.read.parquet(f"{path}/pivots").orderBy("pivot").collect()  # n_pivots rows
    metric, centers = pivots[0]["metric"], np.array([r["center"] for r in pivots])
    rows = spark.read.parquet(f"{path}/schema")
    schema = _candidate_schema(questions.schema[q_id], rows, ids, carry)
    spans = spark.read.parquet(f"{path}/spans").toPandas()  # a row a block and pivot: n_pivots numbers for block_rows rows
    blocks = spans[spans["p"] == 0].sort_values(["_pivot", "_ring"])[["_pivot", "_ring", "n"]].reset_index(drop=True)
    if blocks.empty:
        none = _ranked(spark.createDataFrame([], schema), k, q_id, ids, carry, "rank", round_digits)
        return none, spark.createDataFrame([(0, 0)], "looked bigint, pairs bigint")
    lo = spans.pivot_table(index=["_pivot", "_ring"], columns="p", values="lo").sort_index().to_numpy()
    hi = spans.pivot_table(index=["_pivot", "_ring"], columns="p", values="hi").sort_index().to_numpy()
    given = spark.sparkContext.broadcast((centers, lo, hi, blocks))
    checkpoint_dir(spark)
    qs = questions.select(q_id, q_vec).checkpoint()

    def chosen(pdf: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
        """(question, numbers of its blocks): those that hold k rows or, with ``_far``, the others within it."""
        centers, lo, hi, blocks = given.value
        n = blocks["n"].to_numpy()
        d, ok = _to_pivots(pdf[q_vec], centers, metric)
        for i, at in enumerate(np.flatnonzero(ok)):
            least = np.maximum(np.maximum(d[i] - hi, lo - d[i]), 0.0).max(1)
            order = np.argsort(least, kind="stable")
            first = order[:np.searchsorted(np.cumsum(n[order]), k) + 1]  # these hold k rows
            if "_far" in pdf:
                far = pdf["_far"].iloc[at]  # null: the first blocks gave no k rows
                others = np.ones(len(n), bool) if pd.isna(far) else least <= far + SLACK * (1 + far)
                others[first] = False
                first = np.flatnonzero(others)
            yield at, first

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at, first in chosen(pdf):
                yield given.value[3].iloc[first][["_pivot", "_ring"]].assign(**{q_id: pdf[q_id].iloc[at]})[[q_id, "_pivot", "_ring"]]

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, bits = np.zeros(len(pdf), np.int64), [b""] * len(pdf)
            for at, first in chosen(pdf):
                mark = np.zeros(len(given.value[3]), bool)
                mark[first] = True
                n[at], bits[at] = len(first), np.packbits(mark).tobytes()
            yield pdf.assign(_n=n, _bits=bits)[[q_id, q_vec, "_far", "_kth", "_n", "_bits"]]

    kind = T.StructType([questions.schema[q_id], T.StructField("_pivot", T.LongType()), T.StructField("_ring", T.LongType())])
    stored = spark.read.schema(T.StructType([*rows.schema.fields, *kind.fields[1:]])).parquet(f"{path}/rows")
    score = block_scorer(q_id, ids, carry, centers.shape[1], k, metric)

    def scored(some: DataFrame) -> DataFrame:
        # a block's rows come first, its questions after them
        asked = some.join(qs, q_id).withColumnRenamed(q_vec, "_vec").withColumn("_asked", F.lit(True))
        rows = stored.withColumnRenamed(c_vec, "_vec").withColumn("_asked", F.lit(False)).unionByName(asked, allowMissingColumns=True)
        return rows.repartition("_pivot", "_ring").sortWithinPartitions("_pivot", "_ring", "_asked").mapInArrow(score, schema)

    now = qs.mapInPandas(bounds, kind).checkpoint()
    first = scored(now).withColumn("_r", F.row_number().over(Window.partitionBy(q_id).orderBy("distance", *ids))).where(F.col("_r") <= k).drop("_r").checkpoint()
    far = F.sqrt(F.greatest(F.max("distance"), F.lit(0.0)) * (2 if metric == "cosine" else 1))
    full = F.count(F.lit(1)) >= k
    reach = first.groupBy(q_id).agg(F.when(full, far).alias("_far"), F.when(full, F.max("distance")).alias("_kth"))
    # a bit for each block and question, not a row: without structure a question looks at nearly all blocks
    schema_far = T.StructType([*qs.schema.fields, *(T.StructField(x, t()) for x, t in (("_far", T.DoubleType), ("_kth", T.DoubleType), ("_n", T.LongType), ("_bits", T.BinaryType)))])
    marks = qs.join(reach, q_id, "left").mapInPandas(marked, schema_far).checkpoint()
    n_later = marks.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if n_later * (8 * centers.shape[1] + 64) <= COPIED_BYTES:
        later = scored(marks.mapInPandas(bounds, kind))
    else:
        number = {(int(p), int(r)): i for i, (p, r) in enumerate(zip(blocks["_pivot"], blocks["_ring"]))}
        later = met_by_cell(marks.where(F.col(q_id).isNotNull() & (F.col("_n") > 0)), stored, k, q_id=q_id, ids=ids, q_vec=q_vec, c_vec=c_vec, metric=metric, carry=carry,
                            dim=centers.shape[1], cell=["_pivot", "_ring"], asks=_marked_for(number), schema=schema, kth="_kth")
    result = _ranked(first.unionByName(later), k, q_id, ids, carry, "rank", round_digits)
    asked = now.select(q_id).distinct().count()
    return result, now.agg((F.count(F.lit(1)) + F.lit(n_later)).alias("looked"), F.lit(asked * len(blocks)).cast("bigint").alias("pairs"))


def skipped(looked: DataFrame) -> float:
    """Share of the pairs of questions and blocks that were not looked at."""
    r = looked.first()
    return 1.0 - r["looked"] / r["pairs"] if r["pairs"] else 0.0
