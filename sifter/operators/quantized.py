"""Approximate nearest neighbours from product-quantised codes.

``build`` writes, below a path:

- ``cells``: a k-means centre of each cell (``ann.cell_centers``: Spark ML on a
  bounded sample), ``books``: for each group of SUB dimensions the CODES
  codewords of what is left of a vector when its cell's centre is taken away.
  The codewords of a group are learned in one task of their own, on at most
  TRAIN rows.
- ``codes``: a byte for each group of dimensions and row, about a sixteenth of
  the vector. Rows are dealt over the files by a hash of their ids and sorted
  by cell there, so every task scans its share of every cell, however large a
  cell is.
- ``vectors``: the rows themselves, partitioned by cell; only what the codes
  leave is read from them.
- ``settings``: how many cells a question probes, and how many rows are
  scored in full for it. Both are measured, not guessed: for at most TUNE rows
  as questions, the exact neighbours are found, and the least numbers that
  reach SURE of them are stored. In vectors that hardly cluster most cells are
  probed, but the rows scored in full stay few.

``search`` scans the codes of the probed cells (decoded by table lookup, one
matrix product a batch for all questions that probe the cell), keeps the best
of a task by their approximate distance, reads those vectors and ranks them by
exact distance. A task hands on its share of ``rerank`` rows and four standard
deviations more, since rows are dealt at random. Questions are broadcast, if
they and what is kept for them are QUESTION_BYTES at most. More of them than
that need about all vectors, and a row for each candidate would be many times
the vectors: questions and vectors are packed into blocks that meet by a
Cartesian product, as in ``knn``'s tiled plan. A block of vectors is a random
share of all, gets its codes back, and scores what the codes leave where it is.

Rows and questions without a vector (cosine: also a zero one) match nothing.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.operators.ann import cell_centers
from sifter.operators.knn import (_TASK_BYTES, _Best, _blocks, _candidate_schema, _distinct, _first, _ids, _matrix, _met, _non_null,
                                  _prepare, _ranked, knn)
from sifter.session import checkpoint_dir, scratch_path

SUB, CODES, TRAIN, TUNE, TUNE_K = 4, 256, 20_000, 256, 10
#: Share of the tuning questions' neighbours whose cells are probed, and again whose codes are near enough.
SURE = 0.98
BLOCK = 1 << 20  # distances at once
QUESTION_BYTES = 64 << 20  # of question vectors and kept candidates that are broadcast, at most
_PIECE = 8192  # pairs whose distances are taken at once


def _lloyd(x: np.ndarray, k: int, seed: int, turns: int = 15) -> np.ndarray:
    """k-means of a bounded sample, the least and all distinct points if there are fewer."""
    points = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(turns):
        near = np.argmin((c ** 2).sum(1) - 2 * x @ c.T, axis=1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return c


class Codec:
    """Centres of the cells and codewords of the groups; encodes and decodes."""

    def __init__(self, centers: np.ndarray, books: list[np.ndarray], metric: str):
        self.centers, self.metric, self.dim = centers, metric, centers.shape[1]
        self.groups = [slice(i, min(i + SUB, self.dim)) for i in range(0, self.dim, SUB)]
        self.books = books

    def prepared(self, values) -> tuple[np.ndarray, np.ndarray]:
        """(vectors as they are compared by squared distance, valid rows)."""
        m, _, ok = _prepare(_matrix(values, self.dim), self.metric, _non_null(values))
        return m, ok

    def cells(self, m: np.ndarray) -> np.ndarray:
        """Squared distance to every centre."""
        return np.maximum((m ** 2).sum(1)[:, None] + (self.centers ** 2).sum(1) - 2 * m @ self.centers.T, 0.0)

    def encoded(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, codes) of each row."""
        cell = np.argmin(self.cells(m), axis=1)
        rest = m - self.centers[cell]
        codes = np.empty((len(m), len(self.groups)), np.uint8)
        for j, (g, b) in enumerate(zip(self.groups, self.books)):
            codes[:, j] = np.argmin((b ** 2).sum(1) - 2 * rest[:, g] @ b.T, axis=1)
        return cell, codes

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        out = np.empty((len(codes), self.dim), np.float32)
        for j, (g, b) in enumerate(zip(self.groups, self.books)):
            out[:, g] = b[codes[:, j]]
        return out


def _codec(spark: SparkSession, path: str) -> Codec | None:
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # nlist rows
    if not cells:
        return None
    books: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/books").orderBy("sub", "code").collect():  # CODES rows a group
        books.setdefault(r["sub"], []).append(r["word"])
    return Codec(np.array([r["center"] for r in cells]), [np.array(books[j]) for j in sorted(books)], cells[0]["metric"])


def build(corpus: DataFrame, path: str, c_id: str | Sequence[str] = "id", c_vec: str = "embedding", metric: str = "cosine",
          carry: Sequence[str] = (), nlist: int | None = None, seed: int = 7) -> None:
    """Writes the index of ``corpus`` to ``path``; rows without a vector are not in it."""
    spark, ids = corpus.sparkSession, _ids(c_id)
    checkpoint_dir(spark)
    rows = corpus.select(*ids, c_vec, *[c for c in carry if c not in ids])
    n, dim = rows.agg(F.count(c_vec), F.max(F.size(c_vec))).first()
    rows.limit(0).write.parquet(f"{path}/schema")
    cell_schema = "cell bigint, center array<double>, metric string"
    if not n:
        spark.createDataFrame([], cell_schema).write.parquet(f"{path}/cells")
        return
    centers = cell_centers(rows, ids, c_vec, metric, nlist or max(1, math.isqrt(n) // 8), n, seed)
    spark.createDataFrame([(i, [float(x) for x in c], metric) for i, c in enumerate(centers)], cell_schema).coalesce(1).write.parquet(f"{path}/cells")
    bare = Codec(centers, [], metric)
    u = F.pmod(F.xxhash64(*ids, F.lit(seed + 1)), F.lit(1 << 30)) / float(1 << 30)

    def rests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            m, ok = bare.prepared(pdf[c_vec])
            if not ok.any():
                continue
            m = m[ok]
            rest = m - bare.centers[np.argmin(bare.cells(m), axis=1)]
            for j, g in enumerate(bare.groups):
                yield pd.DataFrame({"sub": j, "v": list(rest[:, g])})

    def words(pdf: pd.DataFrame) -> pd.DataFrame:
        j = int(pdf["sub"].iloc[0])
        c = _lloyd(np.stack(pdf["v"].to_numpy()), CODES, seed + j)
        return pd.DataFrame({"sub": j, "code": range(len(c)), "word": list(c)})

    sample = rows.where(F.col(c_vec).isNotNull() & (u < min(1.0, TRAIN / n)))
    books = sample.select(c_vec).mapInPandas(rests, "sub int, v array<double>").groupBy("sub").applyInPandas(words, "sub int, code int, word array<double>")
    books.coalesce(1).write.parquet(f"{path}/books")
    if spark.read.parquet(f"{path}/books").isEmpty():  # no row of the sample had a direction
        zero = [(j, 0, [0.0] * (g.stop - g.start)) for j, g in enumerate(bare.groups)]
        spark.createDataFrame(zero, "sub int, code int, word array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/books")
    codec = _codec(spark, path)
    shared = spark.sparkContext.broadcast(codec)
    coded_schema = T.StructType([*rows.schema.fields, T.StructField("_cell", T.LongType()), T.StructField("_code", T.BinaryType())])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            m, ok = shared.value.prepared(pdf[c_vec])
            if not ok.any():
                continue
            cell, codes = shared.value.encoded(m[ok])
            yield pdf[ok].assign(_cell=cell.astype(np.int64), _code=[c.tobytes() for c in codes])

    at = scratch_path(spark, "coded")
    rows.mapInPandas(encode, coded_schema).write.parquet(at)
    coded = spark.read.parquet(at)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    coded.select(*ids, "_cell", "_code").repartition(parts, F.xxhash64(*ids)).sortWithinPartitions("_cell").write.parquet(f"{path}/codes")
    coded.drop("_code").repartition("_cell", F.pmod(F.xxhash64(*ids), F.lit(8))).write.partitionBy("_cell").parquet(f"{path}/vectors")
    nprobe, rerank = _tuned(coded, shared, ids, c_vec, metric, n, seed)
    spark.createDataFrame([(n, len(centers), nprobe, rerank)], "n bigint, nlist int, nprobe int, rerank bigint").coalesce(1).write.parquet(f"{path}/settings")


def _scans(pdf: pd.DataFrame, codec: Codec, Q: np.ndarray, near: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(questions, rows, approximate squared distances) of a batch of codes,
    in pieces; ``near``: squared distance of each question to each cell, inf where it isn't probed."""
    cell = pdf["_cell"].to_numpy()
    codes = np.frombuffer(b"".join(pdf["_code"]), np.uint8).reshape(len(pdf), -1)
    for c in np.unique(cell):
        at, asks = np.flatnonzero(cell == c), np.flatnonzero(np.isfinite(near[:, c]))
        rest = codec.decoded(codes[at])
        own = (rest.astype(np.float64) ** 2).sum(1) + 2 * rest @ codec.centers[c]
        step = max(1, BLOCK // len(at))
        for i in range(0, len(asks), step):
            q = asks[i:i + step]
            yield q, at, near[q, c][:, None] + own - 2 * (Q[q].astype(np.float32) @ rest.T)


class CodedBlock:
    """Prepared vectors in the order of their ids, and their codes by cell."""

    def __init__(self, codec: Codec, m: np.ndarray):
        self.codec, self.m = codec, m
        cell, codes = codec.encoded(m)
        self.at = np.argsort(cell, kind="stable")
        cell, self.rest = cell[self.at], codec.decoded(codes[self.at])
        self.own = (self.rest.astype(np.float64) ** 2).sum(1) + 2 * np.einsum("ij,ij->i", self.rest, codec.centers[cell])
        cuts = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
        self.runs = [(int(cell[a]), slice(a, b)) for a, b in pairwise(cuts)]

    def nearest(self, Q: np.ndarray, near: np.ndarray, most: int, k: int, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, question, exact distance) of each question's k nearest of the ``most`` rows
        that are nearest by their codes, ties included; ``near`` as in ``_scans``."""
        n, out = len(self.m), []
        step = max(1, BLOCK // n)
        # single precision, if it holds the squares
        kind = np.float32 if max(near[np.isfinite(near)].max(initial=0.0), np.abs(self.own).max()) < 1e30 else np.float64
        own = self.own.astype(kind)
        for q0 in range(0, len(Q), step):
            q = slice(q0, q0 + step)
            q32, to = Q[q].astype(np.float32), near[q].astype(kind)
            d = np.full((len(q32), n), np.inf, kind)
            for c, run in self.runs:
                asks = np.isfinite(to[:, c])
                asks = slice(None) if asks.all() else np.flatnonzero(asks)
                d[asks, run] = to[asks, c][:, None] + (own[run] - 2 * (q32[asks] @ self.rest[run].T))
            last = np.partition(d, most - 1, axis=1)[:, most - 1:most] if most < n else np.inf
            c, r = np.nonzero((d <= last) & np.isfinite(d))
            r, exact = self.at[r], np.empty(len(c))
            for i in range(0, len(c), _PIECE):
                x, y = self.m[r[i:i + _PIECE]], Q[q][c[i:i + _PIECE]]
                exact[i:i + _PIECE] = 1.0 - np.einsum("ij,ij->i", x, y) if self.codec.metric == "cosine" else ((x - y) ** 2).sum(1)
            exact = _distinct(exact, self.codec.metric)
            stay = exact <= limit[q][c]
            c, r, exact = _first(c[stay], r[stay], exact[stay], k)
            out.append((r, c + q0, exact))
        return tuple(np.concatenate(x) for x in zip(*out))


def _tuned(coded: DataFrame, codec, ids: list[str], c_vec: str, metric: str, n: int, seed: int) -> tuple[int, int]:
    """(cells to probe, rows to score in full) that reach SURE of the exact neighbours of a sample each."""
    spark = coded.sparkSession
    u = F.pmod(F.xxhash64(*ids, F.lit(seed + 2)), F.lit(1 << 30)) / float(1 << 30)
    asked = coded.where(u < min(1.0, TUNE / n)).select(F.struct(*ids).alias("q"), c_vec).checkpoint()
    true = knn(asked, coded, TUNE_K + 1, q_id="q", c_id=ids, c_vec=c_vec, q_vec=c_vec, metric=metric, carry=["_cell", "_code"])
    # about TUNE x TUNE_K rows; the question itself is no neighbour worth counting
    pairs = true.join(asked, "q").where(~reduce(lambda a, b: a & b, [F.col("q")[c].eqNullSafe(F.col(c)) for c in ids])).select(F.col(c_vec).alias("v"), "_cell", "_code").toPandas()
    cells = len(codec.value.centers)
    if pairs.empty:
        return cells, n
    Q, _ = codec.value.prepared(pairs["v"])
    near = codec.value.cells(Q)
    own = pairs["_cell"].to_numpy()
    rank = (near < near[np.arange(len(Q)), own][:, None]).sum(1) + 1
    nprobe = min(cells, int(np.quantile(rank, SURE, method="higher")))
    rest = codec.value.decoded(np.frombuffer(b"".join(pairs["_code"]), np.uint8).reshape(len(pairs), -1))
    limit = near[np.arange(len(Q)), own] + ((rest + codec.value.centers[own]) ** 2 - codec.value.centers[own] ** 2).sum(1) - 2 * (Q.astype(np.float32) * rest).sum(1)
    probed = _probed(near, nprobe)
    given = spark.sparkContext.broadcast((Q, probed, limit))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, probed, limit = given.value
        less = np.zeros(len(q), np.int64)
        for pdf in batches:
            for i, _, d in _scans(pdf, codec.value, q, probed):
                less[i] += (d < limit[i][:, None]).sum(1)
        yield pd.DataFrame({"pair": np.arange(len(q)), "less": less})

    ranks = coded.select("_cell", "_code").mapInPandas(count, "pair bigint, less bigint").groupBy("pair").agg(F.sum("less").alias("less")).toPandas()["less"]
    return nprobe, min(n, int(np.quantile(ranks, SURE, method="higher")) + 1 + TUNE_K)


def _probed(near: np.ndarray, nprobe: int) -> np.ndarray:
    """``near`` with inf for all but the ``nprobe`` nearest cells."""
    if nprobe >= near.shape[1]:
        return near
    out = np.full_like(near, np.inf)
    best = np.argpartition(near, nprobe - 1, axis=1)[:, :nprobe]
    np.put_along_axis(out, best, np.take_along_axis(near, best, axis=1), axis=1)
    return out


def settings(spark: SparkSession, path: str) -> dict:
    """n, nlist, nprobe and rerank of the index at ``path``."""
    return spark.read.parquet(f"{path}/settings").first().asDict()


def search(spark: SparkSession, path: str, questions: DataFrame, k: int, *, q_id: str = "qid", c_id: str | Sequence[str] = "id",
           q_vec: str = "embedding", c_vec: str = "embedding", carry: Sequence[str] = (), nprobe: int | None = None,
           rerank: int | None = None, round_digits: int | None = 6) -> DataFrame:
    """(q_id, rank, *c_id, distance, *carry) from the index at ``path``."""
    ids, codec = _ids(c_id), _codec(spark, path)
    carry = [c for c in carry if c not in ids]
    rows = spark.read.parquet(f"{path}/schema")
    schema = _candidate_schema(questions.schema[q_id], rows, ids, carry)
    if codec is None:
        return _ranked(spark.createDataFrame([], schema), k, q_id, ids, carry, "rank", round_digits)
    s = settings(spark, path)
    rerank, nprobe = max(rerank or s["rerank"], k), nprobe or s["nprobe"]
    checkpoint_dir(spark)
    qs = questions.select(q_id, q_vec).checkpoint()
    n_q = qs.count()
    shared = spark.sparkContext.broadcast(codec)
    if n_q * (8 * codec.dim + 8 * len(codec.centers) + 80 * rerank) <= QUESTION_BYTES:
        found = _search_block(spark, path, qs.toPandas(), shared, k, q_id, ids, q_vec, c_vec, carry, nprobe, rerank, s["n"], schema)
    else:
        found = _search_tiled(spark, path, qs, n_q, shared, k, q_id, ids, q_vec, c_vec, carry, nprobe, rerank, s["n"], schema)
    return _ranked(found, k, q_id, ids, carry, "rank", round_digits)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.parquet(f"{path}/schema").schema  # a corpus without a direction leaves no file to tell it
    return spark.read.schema(T.StructType([*stored.fields, T.StructField("_cell", T.LongType())])).parquet(f"{path}/vectors")


def _search_tiled(spark, path, qs, n_q, codec, k, q_id, ids, q_vec, c_vec, carry, nprobe, rerank, n, schema) -> DataFrame:
    metric, dim = codec.value.metric, codec.value.dim
    c_parts = max(2, 2 * spark.sparkContext.defaultParallelism)
    q_parts = max(1, math.ceil(n_q * 8 * (dim + len(codec.value.centers)) / _TASK_BYTES))
    dealt = F.xxhash64(*ids, c_vec)
    rows = _stored(spark, path).select(*ids, c_vec, *carry).repartition(c_parts, dealt).sortWithinPartitions(F.xxhash64(dealt))
    cb = _blocks(rows, c_vec, metric, dim, c_parts, ids, "c")
    qb = _blocks(qs, q_vec, metric, dim, q_parts, [], "q")

    def matrix(vec: bytes, is_wide: bool) -> np.ndarray:
        return _prepare(np.frombuffer(vec, np.float64 if is_wide else np.float32).reshape(-1, dim).astype(np.float64), metric)[0]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple] = {}
        held = None
        for pdf in batches:
            for p in pdf.itertuples(index=False):
                if held is None or held[0] != p.c_blk:
                    held = p.c_blk, pickle.loads(p.c_ids), CodedBlock(codec.value, matrix(p.c_vec, p.c_wide))
                if p.q_blk not in best:
                    Q = matrix(p.q_vec, p.q_wide)
                    best[p.q_blk] = _Best(len(Q), k, metric, ids), Q, _probed(codec.value.cells(Q), nprobe), bytes(p.q_ids)
                found, Q, near, _ = best[p.q_blk]
                share = rerank * min(1.0, len(held[1]) / n)
                found.take(held[1].iloc.__getitem__, *held[2].nearest(Q, near, math.ceil(share + 4 * math.sqrt(share)) + k, k, found.limit))
        for found, _, _, packed in best.values():
            if (out := found.frame()) is not None:
                yield out.assign(**{q_id: pickle.loads(packed)[q_id].to_numpy()[out["_q"].to_numpy()]})[[f.name for f in schema.fields]]

    return _met(cb, qb, score, schema, 16 * dim)


def _search_block(spark, path, block, codec, k, q_id, ids, q_vec, c_vec, carry, nprobe, rerank, n, schema) -> DataFrame:
    Q, ok = codec.value.prepared(block[q_vec])
    Q, q_ids = Q[ok], block[q_id].to_numpy()[ok]
    given = spark.sparkContext.broadcast((Q, q_ids, _probed(codec.value.cells(Q), nprobe)))
    codes = spark.read.parquet(f"{path}/codes")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Q, _, near = given.value
        kept, limit, seen = None, np.full(len(Q), np.inf), 0

        def best(frame: pd.DataFrame, most: int) -> pd.DataFrame:
            frame = frame.sort_values(["_q", "_d"], kind="stable")
            return frame[frame.groupby("_q").cumcount().to_numpy() < most]

        for pdf in batches:
            seen += len(pdf)
            new = [kept] if kept is not None else []
            for q, at, d in _scans(pdf, codec.value, Q, near):
                if d.shape[1] > rerank:
                    d[d > np.partition(d, rerank - 1, axis=1)[:, rerank - 1:rerank]] = np.inf
                i, j = np.nonzero((d <= limit[q][:, None]) & np.isfinite(d))
                new.append(pd.DataFrame({"_q": q[i].astype(np.int64), "_d": d[i, j].astype(np.float64)} | {c: pdf[c].to_numpy()[at[j]] for c in (*ids, "_cell")}))
            if new:
                kept = best(pd.concat(new, ignore_index=True), rerank)
                full = kept.groupby("_q")["_d"].agg(["size", "max"])
                full = full[full["size"] >= rerank]
                limit[full.index.to_numpy()] = full["max"].to_numpy()
        if kept is not None and len(kept):
            share = rerank * min(1.0, seen / n)
            yield best(kept, math.ceil(share + 4 * math.sqrt(share)) + k).drop(columns="_d")

    fields = [T.StructField("_q", T.LongType()), *[codes.schema[c] for c in ids], codes.schema["_cell"]]
    cand = codes.mapInPandas(scan, T.StructType(fields)).checkpoint()
    vectors = _stored(spark, path)

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Q, q_ids, _ = given.value
        for pdf in batches:
            m, _ = codec.value.prepared(pdf[c_vec])
            q = Q[pdf["_q"].to_numpy()]
            d = 1.0 - np.einsum("ij,ij->i", m, q) if codec.value.metric == "cosine" else ((m - q) ** 2).sum(1)
            out = pd.DataFrame({q_id: q_ids[pdf["_q"].to_numpy()], "distance": _distinct(d, codec.value.metric)})
            yield out.assign(**{c: pdf[c].to_numpy() for c in (*ids, *carry)})[[f.name for f in schema.fields]]

    pairs = cand.join(vectors.select("_cell", *ids, c_vec, *carry), ["_cell", *ids])
    return pairs.mapInPandas(rank, schema)
