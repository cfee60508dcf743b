"""Exact k-nearest-neighbour search between a question frame and a corpus.

Two-phase top-k: every corpus task scores its rows against the questions with
a blocked matrix product (numpy, Arrow batches via ``mapInPandas``), keeps a
running top-k per question over all of its batches and emits it once, at the
end; a final ``row_number() <= k`` over the candidates (at most tasks x k rows
per question) picks the global top-k. Pairs are never materialised as rows.

Order is (distance, corpus id). Distances are compared to ``_DIGITS`` digits,
which is what separates a distance from the rounding noise of its sum, so rows
whose distances are equal in exact arithmetic rank by id on any engine; the
``distance`` column is rounded to ``round_digits`` on output only. The product
is taken in single precision and only tells which pairs can be within the k-th
distance found so far; of those the distance is taken pair by pair in double.

Plans:
* broadcast — the question matrix is sent to every task. Used only for up to
  ``_BLOCK`` questions within ``max_broadcast_bytes``: they are counted before
  anything is collected, from a written copy, so their vectors are made once.
* tiled — beyond that bound: questions and corpus are packed into blocks of
  ``_BLOCK`` rows, written once, and met by a Cartesian product of the block
  rows, which reads blocks again instead of shuffling copies of them. A task has
  a bounded share of the questions; the corpus is dealt over twice the cores, so
  candidates grow with the questions and not with the corpus's files. Carried
  columns are joined to the result alone. Nothing passes through the driver.

Rows and questions with a null vector (cosine: also a zero one) match nothing.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.session import checkpoint_dir, scratch_path

DEFAULT_MAX_BROADCAST = 64 << 20
_SCORE_CELLS = 1 << 20  # pairs of a scoring block that are looked at one by one
_TILE = 512  # questions and rows of a product: 1 MB, which stays in a core's cache
_PAIR_BYTES = 32 << 20  # of vectors whose distances are taken pair by pair at once
_ID_BYTES = 64  # allowed for a question id
_DIGITS = 12
_BLOCK = 8192  # rows of a packed block, and questions that are broadcast, at most
_TASK_BYTES = 32 << 20  # of question vectors a task of the tiled plan
_PAIR_BATCH = 32 << 20  # of blocks handed to a Python worker at once


def _matrix(values, dim: int | None = None) -> np.ndarray:
    """Rows of a vector column as a float64 matrix; null rows become zero
    vectors, which every metric treats as invalid (see ``_prepare``)."""
    vals = list(values)
    if dim is None:
        dim = next((len(v) for v in vals if v is not None), 0)
    if vals and dim and all(v is not None and len(v) == dim for v in vals):
        return np.concatenate(vals).astype(np.float64).reshape(len(vals), dim)
    out = np.zeros((len(vals), dim), dtype=np.float64)
    for i, v in enumerate(vals):
        if v is not None:
            out[i] = np.asarray(v, dtype=np.float64)
    return out


def _non_null(values) -> np.ndarray:
    return np.fromiter((v is not None for v in values), dtype=bool, count=len(values))


def _prepare(M: np.ndarray, metric: str, present: np.ndarray | None = None):
    """Returns (matrix to multiply, squared norms, valid-row mask). Null
    rows are invalid; for cosine, zero vectors are invalid too."""
    sq = np.einsum("ij,ij->i", M, M) if len(M) else np.zeros(0)
    valid = np.ones(len(M), dtype=bool) if present is None else present.copy()
    if metric == "cosine":
        valid &= sq > 0
        out = np.zeros_like(M)
        out[valid] = M[valid] / np.sqrt(sq[valid])[:, None]
        return out, sq, valid
    return M, sq, valid


def _distinct(d: np.ndarray, metric: str) -> np.ndarray:
    """Distances without rounding noise: cosine distances are differences
    from 1 (absolute digits), squared lengths are sums (significant digits)."""
    if metric == "cosine":
        return np.round(d, _DIGITS) + 0.0
    scale = 10.0 ** (_DIGITS - 1 - np.floor(np.log10(np.where(d > 0, d, 1.0))))
    return np.where(d > 0, np.round(d * scale) / scale, 0.0)


def _narrowed(c: np.ndarray, r: np.ndarray, v: np.ndarray, k: int, least: np.ndarray, nearer: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Of (question, row) pairs with products ``v`` those that the k best of each question leave open."""
    if len(c) <= 2 * k * len(least):
        return c, r
    order = np.lexsort((-v, c))
    first = np.searchsorted(c[order], np.arange(len(least) + 1))
    full = np.flatnonzero(np.diff(first) >= k)
    best = np.zeros(len(least))
    best[full] = v[order[first[full] + k - 1]]
    least[full] = nearer(best)[full]
    stay = v >= np.nextafter(least.astype(v.dtype), v.dtype.type(-np.inf))[c]
    return c[stay], r[stay]


def _true(hit: np.ndarray) -> np.ndarray:
    """Where ``hit`` is true, which is seldom: eight are looked at at once."""
    n = len(hit) // 8 * 8
    at = np.flatnonzero(hit[:n].view(np.uint64))
    i = np.flatnonzero(hit[:n].reshape(-1, 8)[at])
    return np.concatenate([8 * at[i >> 3] + (i & 7), n + np.flatnonzero(hit[n:])])


def _kth(some: np.ndarray, k: int) -> np.ndarray:
    return np.partition(some, some.shape[1] - k, axis=1)[:, some.shape[1] - k].astype(float)


def _screened(C: np.ndarray, c_sq: np.ndarray, Q: np.ndarray, q_sq: np.ndarray, k: int, metric: str, limit: np.ndarray, room: np.ndarray, most: int):
    """(question, row) pairs whose product, made tile by tile in ``room`` and its kind,
    leaves it open that the row is within ``limit`` of the question and one of its k
    nearest; None if these are more than ``most``."""
    kind, n = room.dtype.type, len(C)
    noise = (C.shape[1] + 4) * np.finfo(kind).eps
    half = None if metric == "cosine" else (0.5 * c_sq).astype(kind)
    if metric == "cosine":
        base, slack = np.ones(len(Q)), np.full(len(Q), noise + 2 * 10.0 ** -_DIGITS)
    else:  # half of the squared length is half the question's less S
        base = 0.5 * q_sq
        slack = noise * (q_sq + c_sq.max()) + 1e-30
        limit = 0.5 * limit * (1 + 4 * 10.0 ** -_DIGITS)
    least = base - limit - slack
    tie = 4 * 10.0 ** -_DIGITS

    def nearer(kth: np.ndarray) -> np.ndarray:
        """With what the k-th of some of the rows has: it bounds the k-th of all."""
        return np.maximum(least, kth - 2 * slack - tie * np.abs(base - kth))

    if not np.isfinite(limit).all():
        some = slice(None, None, max(1, min(16, n // (4 * k))))
        least = nearer(_kth(Q @ C[some].T - (0 if half is None else half[some]), k))
    room = room.ravel()
    hit = np.empty(len(room), bool)
    cs, rs, vs, found = [], [], [], 0
    for at in range(0, n, _TILE):
        some = C[at:at + _TILE]
        shape = len(Q), len(some)
        S = np.matmul(Q, some.T, out=room[:len(Q) * len(some)].reshape(shape))
        if half is not None:
            S -= half[at:at + _TILE]
        # rounded down, so that the comparison in ``kind`` leaves nothing out
        low = np.nextafter(least.astype(kind), kind(-np.inf))[:, None]
        near = _true(np.greater_equal(S, low, out=hit[:S.size].reshape(shape)).ravel())
        if not len(near):
            continue
        c, r = np.divmod(near, len(some))
        v = S.ravel()[near]
        if len(near) > 64 * k * len(Q):
            c, r = _narrowed(c, r, v, k, least, nearer)
            v = S[c, r]
        cs.append(c)
        rs.append(r + at)
        vs.append(v)
        found += len(c)
        if found > most:
            return None
    if not cs:
        return np.zeros(0, int), np.zeros(0, int)
    return _narrowed(np.concatenate(cs), np.concatenate(rs), np.concatenate(vs), k, least, nearer)


def _first(c: np.ndarray, r: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest rows of each question of (question, row, distance), ties to the first rows."""
    order = np.lexsort((r, d, c))
    c, r, d = c[order], r[order], d[order]
    keep = np.arange(len(c)) - np.searchsorted(c, c) < k
    return c[keep], r[keep], d[keep]


def _local_topk(C: np.ndarray, c_sq: np.ndarray, Q: np.ndarray, q_sq: np.ndarray, k: int, metric: str, limit: np.ndarray | None = None):
    """The top-k rows of C for every question, ties to the first rows: (row
    index, question index, distance) arrays; those beyond a question's
    ``limit`` are left out. Pairs that the blocked product cannot rule out are
    taken pair by pair, in slices. However many rows tie, a block has at most
    _SCORE_CELLS pairs, or one tile's, and a slice _PAIR_BYTES of vectors."""
    nc, nq = len(C), len(Q)
    if nc == 0 or nq == 0:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    rows, cols, ds = [], [], []
    kk, dim = min(k, nc), C.shape[1]
    step, piece = min(nq, _TILE), max(1, _PAIR_BYTES // (16 * max(dim, 1)))
    limit = np.full(nq, np.inf) if limit is None else limit
    # lengths are brought to 1 at most for the product, so that single precision holds their squares
    unit = 1.0 if metric == "cosine" else math.sqrt(max(c_sq.max(), q_sq.max())) or 1.0
    scaled = (C / unit, c_sq / unit ** 2, Q / unit, q_sq / unit ** 2, limit / unit ** 2) if unit != 1.0 else (C, c_sq, Q, q_sq, limit)
    C32, Q32 = scaled[0].astype(np.float32), scaled[2].astype(np.float32)
    room, wide = np.empty((step, min(nc, _TILE)), np.float32), None
    q0 = 0
    while q0 < nq:
        b = slice(q0, q0 + step)
        got = _screened(C32, scaled[1], Q32[b], scaled[3][b], kk, metric, scaled[4][b], room, _SCORE_CELLS)
        if got is None or len(got[0]) > max(nc * len(Q32[b]) // 16, kk * len(Q32[b])):  # nearer to each other than single precision tells
            least = max(1, _SCORE_CELLS // nc)
            if got is None and step > least:
                step = least
                continue
            wide = np.empty(room.shape) if wide is None else wide
            got = _screened(scaled[0], scaled[1], scaled[2][b], scaled[3][b], kk, metric, scaled[4][b], wide, step * nc)
        c, r = got
        Qb, d = Q[b], np.empty(len(c))
        for at in range(0, len(c), piece):
            i = slice(at, at + piece)
            d[i] = 1.0 - np.einsum("ij,ij->i", C[r[i]], Qb[c[i]]) if metric == "cosine" else ((C[r[i]] - Qb[c[i]]) ** 2).sum(1)
        d = _distinct(d, metric)
        near = d <= limit[b][c]
        c, r, d = _first(c[near], r[near], d[near], k)
        rows.append(r)
        cols.append(c + q0)
        ds.append(d)
        q0 += step
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(ds)


def _order(f: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Positions of the rows in the order of ``keys``, nulls last, equal ones as they are."""
    if all(f[x].dtype.kind in "iuf" for x in keys):
        return np.lexsort([f[x].to_numpy() for x in reversed(keys)])
    return f.reset_index(drop=True).sort_values(keys, kind="stable").index.to_numpy()


class _Best:
    """The k nearest rows of each of ``n`` questions over the blocks given to ``add``."""

    def __init__(self, n: int, k: int, metric: str, ids: list[str]):
        self.k, self.metric, self.ids = k, metric, ids
        self.limit = np.full(n, np.inf)  # the k-th distance so far
        self.kept: pd.DataFrame | None = None
        self.new: list[pd.DataFrame] = []
        self.n_new = 0

    def add(self, rows: Callable[[np.ndarray], pd.DataFrame], C: np.ndarray, c_sq: np.ndarray, Q: np.ndarray, q_sq: np.ndarray) -> None:
        """A block in the order of its ids; ``rows`` gives the columns of some of its rows."""
        self.take(rows, *_local_topk(C, c_sq, Q, q_sq, self.k, self.metric, self.limit))

    def take(self, rows: Callable[[np.ndarray], pd.DataFrame], r: np.ndarray, c: np.ndarray, d: np.ndarray) -> None:
        """What a block has: row and question numbers and their distances."""
        if not len(r):
            return
        self.new.append(rows(r).reset_index(drop=True).assign(_q=c, distance=d))
        self.n_new += len(r)
        if self.kept is None or 4 * self.n_new >= len(self.kept):
            self.frame()

    def frame(self) -> pd.DataFrame | None:
        if self.new:
            f = pd.concat([*([] if self.kept is None else [self.kept]), *self.new], ignore_index=True)
            f = f.iloc[_order(f, ["_q", "distance", *self.ids])]
            at = f.groupby("_q", sort=False).cumcount().to_numpy()
            full = f[at == self.k - 1]
            self.limit[full["_q"].to_numpy()] = full["distance"].to_numpy()
            self.kept, self.new, self.n_new = f[at < self.k], [], 0
        return self.kept


def _trim(out: pd.DataFrame, q_id: str, ids: list[str], k: int) -> pd.DataFrame:
    """Keep k per question (ties at the k-th distance resolved by id)."""
    out = out.sort_values([q_id, "distance", *ids], kind="stable")
    return out.groupby(q_id, sort=False).head(k)


def _candidate_schema(q_field: T.StructField, corpus: DataFrame, ids: list[str], carry: Sequence[str]) -> T.StructType:
    fields = [T.StructField(q_field.name, q_field.dataType, True)]
    fields += [T.StructField(c, corpus.schema[c].dataType, True) for c in ids]
    fields.append(T.StructField("distance", T.DoubleType(), True))
    fields += [T.StructField(c, corpus.schema[c].dataType, True) for c in carry]
    return T.StructType(fields)


def _ids(c_id: str | Sequence[str]) -> list[str]:
    return [c_id] if isinstance(c_id, str) else list(c_id)


def _scored(pdf: pd.DataFrame, c_vec: str, ids: list[str], carry: Sequence[str], q_id: str, q_ids: np.ndarray,
            Q: np.ndarray, q_sq: np.ndarray, k: int, metric: str) -> pd.DataFrame:
    """Top-k rows of one batch for prepared, valid questions."""
    pdf = pdf.sort_values(ids)  # ties go to the first row
    C, c_sq, ok = _prepare(_matrix(pdf[c_vec], Q.shape[1]), metric, _non_null(pdf[c_vec]))
    if not ok.all():
        pdf, C, c_sq = pdf[ok], C[ok], c_sq[ok]
    r, c, d = _local_topk(C, c_sq, Q, q_sq, k, metric)
    out = pd.DataFrame({q_id: q_ids[c]} | {i: pdf[i].to_numpy()[r] for i in ids} | {"distance": d})
    for col in carry:
        out[col] = pdf[col].to_numpy()[r]
    return out


def _running_topk(scored: Iterable[pd.DataFrame], q_id: str, ids: list[str], k: int) -> Iterator[pd.DataFrame]:
    """One frame at the end: the top-k of all batches."""
    best = None
    for s in scored:
        if not s.empty:
            best = s if best is None else _trim(pd.concat([best, s], ignore_index=True), q_id, ids, k)
    if best is not None:
        yield best


def _ranked(cand: DataFrame, k: int, q_id: str, ids: list[str], carry: Sequence[str], rank_col: str, digits: int | None) -> DataFrame:
    w = Window.partitionBy(q_id).orderBy("distance", *ids)
    d = F.col("distance") if digits is None else F.round("distance", digits) + F.lit(0.0)
    return (cand.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
                .select(q_id, F.col(rank_col).cast("long").alias(rank_col), *ids, d.alias("distance"), *carry))


def knn(questions: DataFrame, corpus: DataFrame, k: int, *, q_id: str = "qid", c_id: str | Sequence[str] = "id",
        q_vec: str = "embedding", c_vec: str = "embedding", metric: str = "cosine",
        carry: Sequence[str] = (), round_digits: int | None = 6,
        max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST, plan: str = "auto",
        rank_col: str = "rank") -> DataFrame:
    """Top-``k`` corpus rows per question: ``(q_id, rank, *c_id, distance, *carry)``.

    ``c_id`` is a column or several that identify a corpus row together, e.g.
    ``("doc_id", "chunk_pos")``. ``corpus`` may be filtered beforehand.
    """
    if metric not in ("cosine", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    if plan not in ("auto", "broadcast", "tiled"):
        raise ValueError(f"unknown plan {plan!r}")
    ids = _ids(c_id)
    carry = [c for c in carry if c not in ids]
    # null vectors are skipped inside the scorer: a filter here would be pushed
    # below an exchange and re-run the encoder that produced the vectors
    qs, cs = questions.select(q_id, q_vec), corpus.select(*ids, c_vec, *carry)
    checkpoint_dir(qs.sparkSession)
    qs = qs.checkpoint()
    st = qs.agg(F.count(q_vec).alias("n"), F.max(F.size(q_vec)).alias("dim")).first()
    n, dim = int(st["n"]), int(st["dim"] or 0)
    if plan == "auto":
        plan = "broadcast" if n <= _BLOCK and n * (dim * 8 + _ID_BYTES) <= max_broadcast_bytes else "tiled"
    if plan == "broadcast":
        cand = _broadcast_candidates(qs, cs, k, q_id, ids, q_vec, c_vec, metric, carry, dim, _candidate_schema(qs.schema[q_id], cs, ids, carry))
        return _ranked(cand, k, q_id, ids, carry, rank_col, round_digits)
    if not carry:
        cand = _tiled_candidates(qs, cs, k, q_id, ids, q_vec, c_vec, metric, [], dim, _candidate_schema(qs.schema[q_id], cs, ids, []), n)
        return _ranked(cand, k, q_id, ids, [], rank_col, round_digits)
    # a number that the rows keep, since ids may repeat: what is carried is joined to the result alone
    cs = _written(cs.withColumn("_at", F.monotonically_increasing_id()), "knn-corpus")
    cand = _tiled_candidates(qs, cs.drop(*carry), k, q_id, ids, q_vec, c_vec, metric, ["_at"], dim, _candidate_schema(qs.schema[q_id], cs, ids, ["_at"]), n)
    found = _ranked(cand, k, q_id, ids, ["_at"], rank_col, round_digits)
    return found.join(cs.select("_at", *carry), "_at").drop("_at")


def _questions(qpdf: pd.DataFrame, q_id: str, q_vec: str, metric: str, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, matrix, squared norms) of the valid questions."""
    Q, q_sq, ok = _prepare(_matrix(qpdf[q_vec], dim), metric, _non_null(qpdf[q_vec]))
    return qpdf[q_id].to_numpy()[ok], Q[ok], q_sq[ok]


def _broadcast_candidates(qs, cs, k, q_id, ids, q_vec, c_vec, metric, carry, dim, schema):
    prepared = _questions(qs.toPandas(), q_id, q_vec, metric, dim)  # size checked by the caller
    bc = qs.sparkSession.sparkContext.broadcast(prepared)

    def score(batches):
        q_ids, Q, q_sq = bc.value
        best = _Best(len(q_ids), k, metric, ids)
        for pdf in batches:
            if len(pdf) and len(q_ids):
                pdf = pdf.sort_values(ids)  # ties go to the first row
                C, c_sq, ok = _prepare(_matrix(pdf[c_vec], dim), metric, _non_null(pdf[c_vec]))
                pdf = pdf.loc[ok, [*ids, *carry]]
                best.add(pdf.iloc.__getitem__, C[ok], c_sq[ok], Q, q_sq)
        if (out := best.frame()) is not None:
            yield out.assign(**{q_id: q_ids[out["_q"].to_numpy()]})[[f.name for f in schema.fields]]

    return cs.mapInPandas(score, schema)


def tile_scorer(q_id, ids, q_vec, c_vec, metric, carry, dim, k, schema):
    """(corpus block, question block) -> candidates; for ``cogroup().applyInPandas``."""
    def tile(cpdf: pd.DataFrame, qpdf: pd.DataFrame) -> pd.DataFrame:
        q_ids, Q, q_sq = _questions(qpdf, q_id, q_vec, metric, dim)
        if not len(q_ids) or cpdf.empty:
            return pd.DataFrame({f.name: pd.Series(dtype=object) for f in schema.fields})
        return _scored(cpdf, c_vec, ids, carry, q_id, q_ids, Q, q_sq, k, metric)
    return tile


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` made once, in the shared folder."""
    at = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def _dealt(stored: DataFrame, parts: int) -> DataFrame:
    """Stored rows in ``parts`` partitions, shuffled only if there are fewer."""
    have = stored.rdd.getNumPartitions()
    return stored.coalesce(parts) if have > parts else stored.repartition(parts) if have < parts else stored


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of the batches _BLOCK at a time, however few a batch has."""
    held, n = [], 0
    for pdf in batches:
        for at in range(0, len(pdf), _BLOCK):
            piece = pdf.iloc[at:at + _BLOCK]
            if n + len(piece) > _BLOCK:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
            held.append(piece)
            n += len(piece)
    if held:
        yield pd.concat(held, ignore_index=True)


def _blocks(rows: DataFrame, vec: str, metric: str, dim: int, parts: int, order: list[str], prefix: str) -> DataFrame:
    """The valid rows packed, _BLOCK at most to a row: vectors as bytes, the
    other columns pickled, in ``order``; in ``parts`` partitions."""
    kind = np.float32 if isinstance(rows.schema[vec].dataType.elementType, T.FloatType) else np.float64

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _whole(batches):
            b = b.sort_values(order) if order else b
            M = _matrix(b[vec], dim)
            ok = _prepare(M, metric, _non_null(b[vec]))[2]
            if ok.any():
                yield pd.DataFrame({f"{prefix}_vec": [M[ok].astype(kind).tobytes()], f"{prefix}_ids": [pickle.dumps(b.loc[ok].drop(columns=vec).reset_index(drop=True))],
                                        f"{prefix}_wide": [kind is np.float64]})

    made = rows.mapInPandas(packed, f"{prefix}_vec binary, {prefix}_ids binary, {prefix}_wide boolean")
    return _dealt(_written(made.withColumn(f"{prefix}_blk", F.monotonically_increasing_id()), "knn-blocks"), parts)


def _tiled_candidates(qs, cs, k, q_id, ids, q_vec, c_vec, metric, carry, dim, schema, n_q):
    """The k nearest of each corpus part for every question, written once."""
    spark = qs.sparkSession
    if not dim:  # no question has a vector
        return spark.createDataFrame([], schema)
    c_parts = max(2, 2 * spark.sparkContext.defaultParallelism)
    q_parts = max(1, math.ceil(n_q * (dim * 8 + _ID_BYTES) / _TASK_BYTES))
    cb = _blocks(cs, c_vec, metric, dim, c_parts, ids, "c")
    qb = _blocks(qs, q_vec, metric, dim, q_parts, [], "q")

    def matrix(vec: bytes, is_wide: bool):
        return _prepare(np.frombuffer(vec, np.float64 if is_wide else np.float32).reshape(-1, dim).astype(np.float64), metric)[:2]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple[_Best, bytes]] = {}
        held = None
        for pdf in batches:
            for p in pdf.itertuples(index=False):
                if held is None or held[0] != p.c_blk:
                    held = (p.c_blk, *matrix(p.c_vec, p.c_wide), pickle.loads(p.c_ids))
                Q, q_sq = matrix(p.q_vec, p.q_wide)
                if p.q_blk not in best:
                    best[p.q_blk] = _Best(len(Q), k, metric, ids), bytes(p.q_ids)
                best[p.q_blk][0].add(held[3].iloc.__getitem__, held[1], held[2], Q, q_sq)
        for found, packed in best.values():
            if (out := found.frame()) is not None:
                yield out.assign(**{q_id: pickle.loads(packed)[q_id].to_numpy()[out["_q"].to_numpy()]})[[f.name for f in schema.fields]]

    return _met(cb, qb, score, schema, 16 * dim)


def _met(cb: DataFrame, qb: DataFrame, score: Callable, schema: T.StructType, pair_bytes: int) -> DataFrame:
    """What ``score`` makes of every block of ``cb`` with every block of ``qb``,
    written once; ``pair_bytes``: of a row of each."""
    spark = cb.sparkSession
    pairs = cb.hint("shuffle_replicate_nl").crossJoin(qb)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    # a pair of blocks is megabytes: few are handed to a worker at once
    spark.conf.set(limit, str(max(1, _PAIR_BATCH // (_BLOCK * pair_bytes))))
    try:
        return _written(pairs.mapInPandas(score, schema), "knn-candidates")
    finally:
        spark.conf.set(limit, before)


def met_by_cell(qs: DataFrame, rows: DataFrame, k: int, *, q_id: str, ids: list[str], q_vec: str, c_vec: str, metric: str, carry: Sequence[str],
                dim: int, cell: list[str], asks: Callable, schema: T.StructType, kth: str | None = None) -> DataFrame:
    """Candidates of questions that each look at some cells of ``rows`` (columns
    ``cell``): neither a row nor a question is copied. ``asks`` makes of the other columns of
    a block of questions a function that gives the questions which look at a cell, as
    numbers, or None if all do; ``kth``: a column with a distance that a neighbour does not exceed."""
    spark = qs.sparkSession
    q_parts = max(1, math.ceil(qs.count() * (dim * 8 + _ID_BYTES) / _TASK_BYTES))
    cb = _blocks(rows.select(*cell, *ids, c_vec, *carry), c_vec, metric, dim, max(2, 2 * spark.sparkContext.defaultParallelism), [*cell, *ids], "c")
    qb = _blocks(qs, q_vec, metric, dim, q_parts, [], "q")

    def matrix(vec: bytes, is_wide: bool) -> tuple[np.ndarray, np.ndarray]:
        return _prepare(np.frombuffer(vec, np.float64 if is_wide else np.float32).reshape(-1, dim).astype(np.float64), metric)[:2]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[int, tuple] = {}
        held = None
        for pdf in batches:
            for p in pdf.itertuples(index=False):
                if held is None or held[0] != p.c_blk:
                    frame = pickle.loads(p.c_ids)
                    cuts = [0, *(np.flatnonzero((np.diff(frame[cell].to_numpy(), axis=0) != 0).any(1)) + 1).tolist(), len(frame)]
                    held = p.c_blk, frame, *matrix(p.c_vec, p.c_wide), [(tuple(int(x) for x in frame.loc[a, cell]), slice(a, b)) for a, b in pairwise(cuts)]
                if p.q_blk not in best:
                    names = pickle.loads(p.q_ids)
                    Q = matrix(p.q_vec, p.q_wide)
                    best[p.q_blk] = _Best(len(names), k, metric, ids), *Q, asks(names), names[q_id].to_numpy()
                    if kth is not None:
                        best[p.q_blk][0].limit[:] = names[kth].fillna(np.inf).to_numpy(float)
                found, Q, q_sq, who, _ = best[p.q_blk]
                for at, run in held[4]:
                    i = who(at)
                    if i is None:
                        found.add(held[1].iloc[run].iloc.__getitem__, held[2][run], held[3][run], Q, q_sq)
                    elif len(i):
                        r, c, d = _local_topk(held[2][run], held[3][run], Q[i], q_sq[i], k, metric, found.limit[i])
                        found.take(held[1].iloc[run].iloc.__getitem__, r, i[c], d)
        for found, _, _, _, names in best.values():
            if (out := found.frame()) is not None:
                yield out.assign(**{q_id: names[out["_q"].to_numpy()]})[[f.name for f in schema.fields]]

    return _met(cb, qb, score, schema, 16 * dim)
