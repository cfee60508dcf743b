"""Near dedup by an inverted join of MinHash coordinates.

A document's set is its distinct word shingles (A-Z lower-cased; with fewer
words than a shingle the whole sequence is one; without words it is empty and
linked with nothing). Documents with equal sets form a class, and one member
stands for it. Each class gets COORDS MinHash values; a token is a coordinate
with its value, and two classes collide once for each token they share.

Linked classes collide at least ``matches`` times, but for a chance below MISS
each, so they share a token among the COORDS - matches + 1 first tokens of
either in any common order (prefix). The order is rarest first, so that tokens
of one class alone fill the prefix of a text without near copies, which then
posts nothing, and passages that many texts share end up beyond it. Tokens are
counted in one exchange and only shared ones go back to their classes, so what
is posted is small. The lists skipped
are counted from signatures carried along, SIGNATURE bytes for each class that
posts: pairs with fewer equal bytes than a link has but for a chance of MISS, or
of too different sizes, go at once. What is left is
confirmed on the full shingle sets (100 * intersection >= percent * union).

Lists are merged in three rounds, components contracted after each. First every
class is tried with the list head it collides with most. In the lists that then
still hold classes of different components, a class's shingles that no other
component has are counted: they are in no intersection that is still of
interest, so ``n - own`` bounds it exactly. Classes that this rules out go, and
the others are tried with the head that has least of its own; where a list comes
from one passage that its classes share, whatever does not link with that head
links with nothing. The third round counts anew and compares what is left of
each list in blocks of CELL classes, in numpy: first by the bound and the
signature, then those that have a candidate come again with their full sets.
Two classes are compared in the first of the lists that they share, and not
once they are joined; what leaves a block are its classes, then the links that
join them, so neither grows with the square of a list. So a group of copies
needs about one comparison a member, pairs that are no copies become no rows,
and no link between components is lost.
Contraction (hook to the least neighbour, then halve the paths) runs on Spark.

Nulls and ties: a null id is never the smallest unless all are null; rows that
share an id are told apart by their text. Extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.words import LOWER, blocks, mixed, span_hashes, spans, text_bytes, window_hashes
from sifter.session import checkpoint_dir, scratch_path

COORDS, SIGNATURE, MISS = 64, 64, 1e-6
#: Classes of a list that a task compares with each other or with as many others, and the shingles that these have
#: together, or so; pairs looked at in one step.
CELL, HELD, STEP = 4096, 1 << 21, 1 << 16
#: Tasks that the candidates of one class are confirmed in, at most.
PARTS = 64
_RNG = np.random.default_rng(7)
_XOR = _RNG.integers(0, 2**64, 1024, dtype=np.uint64)
_MUL = _RNG.integers(0, 2**64, 1024, dtype=np.uint64) | np.uint64(1)


@functools.cache
def least_matches(percent: int, coords: int = COORDS, miss: float = MISS) -> int:
    """The most matches that a pair of similarity ``percent`` reaches but for a chance of ``miss``."""
    p, below, t = percent / 100, 0.0, 0
    while t < coords:
        below += math.comb(coords, t) * p**t * (1 - p) ** (coords - t)
        if below > miss:
            break
        t += 1
    return max(t, 1)


def _shingles(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle hashes) of each row with words."""
    data, offsets = text_bytes(batch["text"])
    for a, b in blocks(offsets):
        part = LOWER[data[offsets[a]:offsets[b]]]
        starts, ends, first = spans(part, offsets[a:b + 1] - offsets[a])
        if not len(starts):
            continue
        words = span_hashes(part, starts, ends)
        n = np.diff(first)
        at = np.arange(len(words))[np.arange(len(words)) + size <= np.repeat(first[1:], n)]
        own = np.searchsorted(at, first)
        full = window_hashes(words, at, size) if len(at) else np.zeros(0, np.uint64)
        for i in range(b - a):
            if n[i] >= size:
                yield a + i, full[own[i]:own[i + 1]]
            elif n[i]:
                yield a + i, window_hashes(words[first[i]:first[i + 1]], np.zeros(1, np.int64), int(n[i])) ^ np.uint64(n[i])


def _signed(size: int):
    """(doc_id, key, node, n, sig) of each row; node and sig null for an empty set."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            node, n, sig = [None] * rows, np.zeros(rows, np.int64), [None] * rows
            for i, h in _shingles(batch, size):
                u = np.unique(h)
                n[i] = len(u)
                node[i] = hashlib.blake2b(u.tobytes(), digest_size=16).digest()
                v = np.empty(COORDS, np.uint64)
                for k in range(COORDS):
                    v[k] = ((u ^ _XOR[k]) * _MUL[k]).min()
                sig[i] = mixed(v ^ _XOR[COORDS:2 * COORDS]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["key"], pa.array(node, pa.binary()), pa.array(n), pa.array(sig, pa.list_(pa.int64()))],
                                             names=["doc_id", "key", "node", "n", "sig"])
    return found


def _postings(reps: DataFrame, prefix: int) -> DataFrame:
    """(token, id, p): each class under those of its ``prefix`` rarest tokens
    that others have too; ``p``, the classes that its tokens lead to, is large for
    one that has what many share and little else."""
    tokens = reps.select("id", F.explode("sig").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    held = tokens.join(shared, "token").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("m", "token"))).alias("t"))
    within = F.size("t") - (COORDS - prefix)  # the others come first
    popular = F.aggregate("t", F.lit(0).cast("bigint"), lambda a, x: a + x["m"])
    return held.where(within > 0).select("id", popular.alias("p"), F.explode(F.slice("t", F.lit(1), within)).alias("t")).select("t.token", "id", "p")


def _matching(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two signature matrices have as many equal bytes as a link has."""
    return (x == y).sum(axis=1) >= least_matches(percent, SIGNATURE)


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), SIGNATURE)


def _possible(n, own, m, other, percent: int):
    """Whether sets of n and m shingles, of which own and other are in no intersection, can be similar enough."""
    both = np.minimum(n - own, m - other)
    return both * (100 + percent) >= (n + m) * percent


def _likely(percent: int):
    """Of rows (a, b, n, own, sig, m, other, sig2) the pairs (a, b) that can be links."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, own, m, other = (batch[c].to_numpy() for c in ("n", "own", "m", "other"))
            at = np.flatnonzero(_possible(n, own, m, other, percent))
            some = batch.select(["a", "b", "sig", "sig2"]).take(pa.array(at))
            if some.num_rows:
                yield some.select(["a", "b"]).filter(pa.array(_matching(_signatures(some["sig"]), _signatures(some["sig2"]), percent)))
    return found


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch[c].to_numpy() for c in keys], axis=1)
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(k)]
        for a, b in zip(cuts, cuts[1:]):
            if held and tuple(k[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(k[a])
    if held:
        yield pa.Table.from_batches(held)


def _candidates(run: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i, j), ascending by i, of the pairs that can be links in a
    block (token, lo, hi) of classes: all in one block (lo = hi), or those of
    part lo with those of part hi. Pairs that share a lesser token are met there."""
    part, label, n, own = (run[c].to_numpy() for c in ("part", "label", "n", "own"))
    sig = _signatures(run["sig"].combine_chunks())
    lo, hi = run["lo"][0].as_py(), run["hi"][0].as_py()
    x = np.arange(len(n)) if lo == hi else np.flatnonzero(part == lo)
    y = x if lo == hi else np.flatnonzero(part == hi)
    tokens = run["tokens"].combine_chunks()
    known, at = np.unique(tokens.values.to_numpy(), return_inverse=True)
    least = int(np.searchsorted(known, run["token"][0].as_py()))
    held = np.diff(tokens.offsets.to_numpy())
    lesser = np.full((len(n), COORDS), least)  # numbers of a class's tokens below this one; ``least`` where there is none
    row = np.repeat(np.arange(len(n)), held)
    lesser[row, np.arange(len(row)) - np.repeat(np.cumsum(held) - held, held)] = np.minimum(at, least)
    step = max(STEP // max(len(y), 1), 1)
    for k in range(0, len(x), step):
        u = x[k:k + step]
        may = (label[u][:, None] != label[y]) & _possible(n[u][:, None], own[u][:, None], n[y], own[y], percent)
        if lo == hi:
            may &= u[:, None] < y
        i, j = np.nonzero(may)
        ok = _matching(sig[u[i]], sig[y[j]], percent)
        i, j = i[ok], y[j[ok]]
        has = np.zeros((len(u), least + 1), bool)
        has[np.arange(len(u))[:, None], lesser[u]] = True
        has[:, least] = False
        first = ~has[i[:, None], lesser[j]].any(axis=1)
        yield u[i[first]], j[first]


def _wanted(percent: int):
    """The rows of blocks of classes that are in a pair that can be a link."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["token", "lo", "hi"]):
            some = np.zeros(run.num_rows, bool)
            for i, j in _candidates(run, percent):
                some[i] = some[j] = True
            yield from run.filter(pa.array(some)).to_batches()
    return found


def _joined(percent: int):
    """Links (a, b) that join the classes of a block that can be joined, of its rows with their full sets."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["token", "lo", "hi"]):
            ids, n, sets = run["id"].to_numpy(), run["n"].to_numpy(), run["shingles"].combine_chunks()
            start = sets.offsets.to_numpy()[:-1] - sets.offsets[0].as_py()
            known, at = np.unique(sets.flatten().to_numpy(), return_inverse=True)
            group = np.unique(run["label"].to_numpy(), return_inverse=True)[1]
            step = max((STEP << 4) // int(n.max()), 1)
            has = np.zeros(len(known), bool)
            a, b = [], []
            for i, j in _candidates(run, percent):
                cuts = np.flatnonzero(np.diff(i, prepend=-1, append=-1))
                for k, end in zip(cuts, cuts[1:]):
                    x, own = int(i[k]), at[start[i[k]]:start[i[k]] + n[i[k]]]
                    has[own] = True
                    for c in range(int(k), int(end), step):
                        y = j[c:min(c + step, end)]
                        y = y[group[y] != group[x]]
                        if not len(y):
                            continue
                        first = np.cumsum(n[y]) - n[y]
                        both = np.add.reduceat(has[at[np.repeat(start[y] - first, n[y]) + np.arange(n[y].sum())]], first, dtype=np.int64)
                        for z in y[100 * both >= percent * (n[x] + n[y] - both)].tolist():
                            if group[z] != group[x]:
                                group[group == group[z]] = group[x]
                                a.append(min(ids[x], ids[z]))
                                b.append(max(ids[x], ids[z]))
                    has[own] = False
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return found


def _similar(percent: int):
    """(a, b) of rows (a, part, b, shingles), where the set of a comes first (b null), that are similar enough."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whose, head = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = batch["a"].to_pylist(), batch["b"].to_pylist()
            ends, values = batch["shingles"].offsets.to_numpy(), batch["shingles"].values.to_numpy(zero_copy_only=False).view(np.uint64)
            out: list[tuple[int, int]] = []
            for r in range(len(a)):
                x = values[ends[r]:ends[r + 1]]
                if b[r] is None:
                    whose, head = a[r], x.copy()
                    continue
                if whose != a[r]:
                    raise ValueError("a candidate without its head")
                at = np.searchsorted(head, x)
                both = int((head[np.minimum(at, len(head) - 1)] == x).sum())
                if 100 * both >= percent * (len(x) + len(head) - both):
                    out.append((a[r], b[r]))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
    return found


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of distinct pairs (a, b) those whose full sets are similar enough. The
    set of a goes once to each of PARTS or fewer tasks, those of its candidates come to it."""
    dealt = pairs.select("a", F.pmod(F.xxhash64("b"), F.lit(PARTS)).alias("part"), "b")
    wanted = dealt.select(F.col("a").alias("id"), "a", "part", F.lit(None).cast("bigint").alias("b")).distinct()
    wanted = wanted.unionByName(dealt.select(F.col("b").alias("id"), "a", "part", "b"))
    rows = wanted.join(sets.select("id", "shingles"), "id").select("a", "part", "b", "shingles")
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return rows.mapInArrow(_similar(percent), "a bigint, b bigint").checkpoint()


def _stored(rows: DataFrame) -> DataFrame:
    """``rows`` written and read again. A checkpoint would hand on the planner's
    estimate of their size, which joins multiply: in a loop its digits double each turn."""
    path = scratch_path(rows.sparkSession, "contract")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def contract(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (id, label) after joining what ``edges`` (a, b, of ids) link;
    a component's label is the least of its members' labels."""
    def relabelled(e: DataFrame, parent: DataFrame) -> DataFrame:
        p, q = parent.select(F.col("id").alias("a"), F.col("label").alias("pa")), parent.select(F.col("id").alias("b"), F.col("label").alias("pb"))
        e = e.join(p, "a", "left").join(q, "b", "left")
        e = e.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b")).where("a <> b")
        return _stored(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    e = relabelled(edges, labels)
    while not e.isEmpty():
        near = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = near.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("label")).checkpoint()
        while True:
            up = parent.select(F.col("id").alias("label"), F.col("label").alias("above"))
            jumped = parent.join(up, "label").select("id", "above", (F.col("above") != F.col("label")).alias("moved")).checkpoint()
            parent = jumped.select("id", F.col("above").alias("label"))
            if jumped.where("moved").isEmpty():
                break
        up = parent.select(F.col("id").alias("label"), F.col("label").alias("above"))
        labels = _stored(labels.join(up, "label", "left").select("id", F.coalesce("above", "label").alias("label")))
        e = relabelled(e, parent)
    return labels


def _tried(posted: DataFrame, small: DataFrame, percent: int) -> DataFrame:
    """Each class with the head of those of its lists (token, id, head) that it collides with most, if they can be a link."""
    tried = posted.where("id <> head").groupBy("id", "head").agg(F.count(F.lit(1)).alias("c")).groupBy("id").agg(F.max(F.struct("c", "head")).alias("h"))
    x = small.withColumnRenamed("id", "b")
    y = small.select(F.col("id").alias("a"), F.col("n").alias("m"), F.col("own").alias("other"), F.col("sig").alias("sig2"))
    both = tried.select(F.col("id").alias("b"), F.col("h.head").alias("a")).join(x, "b").join(y, "a")
    return both.select("a", "b", "n", "own", "sig", "m", "other", "sig2").mapInArrow(_likely(percent), "a bigint, b bigint")


def _alive(lists: DataFrame) -> DataFrame:
    """The rows (token, id, label, ...) of the lists that hold different labels, one list of those with the same classes."""
    g = lists.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"),
                                   F.bit_xor(F.xxhash64("id")).alias("h"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("k")).where("lo < hi")
    return lists.join(g.groupBy("size", "h", "k").agg(F.min("token").alias("token")).select("token"), "token", "left_semi")


def _bounded(sets: DataFrame) -> DataFrame:
    """(id, label, n, own, sig) of rows (id, label, n, sig, shingles); own
    counts the shingles that no class of another label has (fewer, which is
    safe, if a class comes twice)."""
    each = sets.select("id", "label", F.explode("shingles").alias("h"))
    shared = each.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("h")
    count = each.join(shared, "h", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
    own = F.greatest(F.col("n") - F.coalesce("shared", F.lit(0)), F.lit(0).cast("bigint"))
    return sets.select("id", "label", "n", "sig").dropDuplicates(["id"]).join(count, "id", "left").select("id", "label", "n", own.alias("own"), "sig")


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")


def _blocks(lists: DataFrame) -> DataFrame:
    """The rows of each list, with the tokens of their class, once for each two
    parts of it, of CELL classes or HELD shingles or so, that theirs is one of; sorted by block."""
    most = F.greatest(F.count(F.lit(1)) / CELL, F.sum("n") / HELD)
    parts = lists.groupBy("token").agg(F.ceil(most).alias("parts"))
    tokens = lists.groupBy("id").agg(F.collect_list("token").alias("tokens"))
    x = lists.join(tokens, "id").join(parts, "token").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    x = x.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    return _by_block(x.select("token", F.least("part", "with").alias("lo"), F.greatest("part", "with").alias("hi"), "part", "id", "label", "n", "own", "sig", "tokens"))


def _linked(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) that join what can be joined in the lists (token, id, label, n, own, sig)."""
    x = _blocks(lists)
    x = x.mapInArrow(_wanted(percent), x.schema).checkpoint()
    return _by_block(x.join(sets.select("id", "shingles"), "id")).mapInArrow(_joined(percent), "a bigint, b bigint").checkpoint()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, key (of its text), n_shingles,
    component_id, kept (its id is the component's), first (and its text's key
    is: false for one of two texts that share that id)."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    matches = least_matches(percent)
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64("text"))
    rows = d.mapInArrow(_signed(shingle), "doc_id bigint, key bigint, node binary, n bigint, sig array<bigint>").checkpoint()
    member = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    reps = (rows.where("node is not null").groupBy("node").agg(member.alias("m"), F.first("n").alias("n"), F.first("sig").alias("sig"))
                .select("node", F.col("m.doc_id").alias("doc_id"), F.col("m.key").alias("key"), "n", "sig")
                .withColumn("id", F.monotonically_increasing_id()).checkpoint())

    posted = _postings(reps, COORDS - matches + 1)
    lists = posted.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.max(F.struct("p", "id")).alias("top")).where("m > 1")
    posted = posted.join(lists, "token").select("token", "id", "p", F.col("top.id").alias("head")).checkpoint()
    some = posted.select("id").distinct().checkpoint()
    labels = some.select("id", F.col("id").alias("label"))
    wanted = reps.join(some, "id", "left_semi").select("id", F.coalesce("doc_id", F.lit(0)).alias("row"), "key")
    texts = d.withColumn("row", F.coalesce("doc_id", F.lit(0))).join(wanted, ["row", "key"]).select("id", "text")
    sets = texts.mapInArrow(_sets(shingle), "id bigint, n bigint, sig binary, shingles array<bigint>").checkpoint()

    small = sets.select("id", "n", F.lit(0).cast("bigint").alias("own"), "sig").dropDuplicates(["id"])
    labels = contract(labels, _confirmed(_tried(posted, small, percent).checkpoint(), sets, percent))
    posted = posted.select("token", "id")
    for last in (False, True):
        alive = _alive(posted.join(labels, "id")).checkpoint()
        ids = alive.select("id", "label").distinct()
        small = _bounded(sets.join(ids, "id")).where(F.col("n") * percent <= (F.col("n") - F.col("own")) * 100).checkpoint()
        posted = _alive(alive.drop("label").join(small.select("id", "label", "n", "own"), "id")).checkpoint()
        if last:
            links = _linked(posted.join(small.select("id", "sig"), "id"), sets, percent)
        else:
            least = F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "id"))
            heads = posted.groupBy("token").agg(least.alias("h")).select("token", F.col("h.id").alias("head"))
            links = _confirmed(_tried(posted.join(heads, "token"), small.drop("label"), percent).checkpoint(), sets, percent)
        labels = contract(labels, links)
        posted = posted.select("token", "id")

    named = reps.join(labels, "id", "left").select("node", "doc_id", "key", F.coalesce("label", "id").alias("label"))
    named = named.join(named.groupBy("label").agg(member.alias("least")), "label").select("node", F.col("least.doc_id").alias("component_id"), F.col("least.key").alias("first_key"))
    out = rows.select("doc_id", "key", "node", "n").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
                      (F.col("doc_id").eqNullSafe(component) & (F.col("node").isNull() | (F.col("key") == F.col("first_key")))).alias("first"))


def _sets(size: int):
    """(id, n, signature, shingles); rows of one text meet in a task, where its set is made once (or once a split)."""
    names = ["id", "n", "sig", "shingles"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            at, sets, signed, ids = [], [], [], batch["id"].to_pylist()
            for i, h in _shingles(batch, size):
                if ids[i] not in seen:
                    seen.add(ids[i])
                    u = np.unique(h)
                    v = np.array([((u ^ _XOR[k]) * _MUL[k]).min() for k in range(2 * COORDS, 2 * COORDS + SIGNATURE)])
                    at.append(i)
                    sets.append(u.view(np.int64))
                    signed.append((mixed(v) & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(at, pa.int64())), pa.array([len(x) for x in sets], pa.int64()),
                                              pa.array(signed, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=names)
    return found
