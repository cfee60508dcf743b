"""Merkle dataset manifest by sibling-shift self-joins.

Rows are leaves, digests of some of their columns. Per group (a source), leaves
in the order of their ids are the nodes of a tree; while it has several nodes,
every ``fanout`` consecutive ones become the digest of their digests. The
groups' roots, in the order of the groups, are the leaves of a last tree of the
same kind, whose root is the dataset's.

A level is joined with itself: each slot-zero row computes the indices of its
siblings, its own shifted by the slot offsets, and an equijoin finds them. Every
key occurs once a side, so a source with a third of all rows is no hot key. The
``fanout`` digests at most that a slot-zero row has found then make its parent.
A level's runs are written, a sixteenth of the level in rows; levels of at most
SMALL nodes are one task each. From the last level back down, each run gets the
runs above it; a leaf finds its whole path by one join with the runs of the
lowest level, and proofs are taken from there without any further shuffle.

Nulls and ties: a null column is ``-``, another one its UTF-8 byte count, ``:``
and its value, so null and empty differ. Null groups come first, null ids
first in their group; rows that share an id are ordered by their leaves, and
equal rows have equal leaves, so their order cannot be seen. Texts of any
length are hashed in place and never shuffled. Extra columns are ignored, and
clash with nothing. An empty table has no root and gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.skew import salted_join
from sifter.operators.ids import dense_index
from sifter.session import checkpoint_dir

FANOUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64  # hexadecimal digits of a digest
#: A level of at most so many nodes (2 MB of digests) is one task, without a shuffle.
SMALL = 1 << 16


def encoded(c: Column) -> Column:
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    """The digest of a row's columns, as binary."""
    return F.unhex(F.sha2(F.concat(*map(encoded, columns)), 256))


def text_of(digests: Column) -> Column:
    """Lowercase hex of one or more digests."""
    return F.lower(F.hex(digests))


def parent_of(run: Column) -> Column:
    return F.unhex(F.sha2(text_of(run), 256))


@dataclass
class Manifest:
    """``rows``: the leaves (id, leaf, what was carried along, tree, idx);
    ``paths``: (tree, run, path, subroot), the digests of each lowest run and
    of the runs above it, up to the root; ``root``: the dataset's digest in hex
    (None without rows); ``top``: levels of the last tree."""
    rows: DataFrame
    paths: DataFrame
    root: str | None
    top: int
    bits: int


def build(leaves: DataFrame, fanout: int = FANOUT) -> Manifest:
    """The manifest of (id, group, leaf, ...) rows; columns after ``leaf`` are carried along."""
    bits = fanout.bit_length() - 1
    if fanout < 2 or fanout != 1 << bits:
        raise ValueError("the fanout has to be a power of two")
    checkpoint_dir(leaves.sparkSession)
    named = F.struct(F.col("group").isNull().alias("none"), F.coalesce(F.col("group"), F.lit("")).alias("name"))
    slim = leaves.withColumn("group", named).checkpoint()
    # the last key spreads rows that are equal
    order = [F.col("group.none").desc(), F.col("group.name"), F.col("id"), F.col("leaf"), F.col("_again")]
    numbered = dense_index(slim.withColumn("_again", F.monotonically_increasing_id()), order, "_at").drop("_again")
    groups = numbered.groupBy("group").agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("n"))
    groups = dense_index(groups, [F.col("group.none").desc(), F.col("group.name")], "tree").checkpoint()
    rows = (salted_join(numbered, groups, "group", groups.select("group", "n"))
            .withColumn("idx", F.col("_at") - F.col("_start")).drop("_at", "_start", "group").checkpoint())
    most, trees = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    if not trees:
        none = rows.select("tree", F.col("idx").alias("run"), F.array(F.col("leaf")).alias("path"), F.col("leaf").alias("subroot"))
        return Manifest(rows.drop("n"), none, None, 0, bits)

    runs, subroots = _climb(rows.select("tree", "idx", "n", F.col("leaf").alias("digest")), rows.count(), most, bits)
    top = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), F.lit(trees).cast("bigint").alias("n"), F.col("subroot").alias("digest"))
    top_runs, roots = _climb(top, trees, trees, bits)
    root = bytes(roots.first()["subroot"]).hex()  # one row

    up = roots.select("tree", F.lit(0).cast("bigint").alias("run"), F.array().cast("array<binary>").alias("path"))
    for level in reversed(top_runs):
        up = _below(level, up, bits)
    of_tree = subroots.select(F.col("tree").alias("_tree"), "subroot", "depth").join(
        up.select(F.col("run").alias("_run"), "path"), F.shiftright("_tree", bits if top_runs else 62) == F.col("_run"))
    of_tree = of_tree.select(F.col("_tree").alias("tree"), F.lit(0).cast("bigint").alias("run"), "path", "subroot", "depth").checkpoint()
    paths = of_tree.where(F.col("depth") == len(runs)).drop("depth")
    for k in range(len(runs) - 1, -1, -1):
        paths = _below(runs[k], paths, bits).unionByName(of_tree.where(F.col("depth") == k).drop("depth"))
        paths = paths.checkpoint() if not k or runs[k - 1][1] << bits > SMALL else paths
    return Manifest(rows.drop("n"), paths, root, len(top_runs), bits)


def _climb(nodes: DataFrame, count: int, most: int, bits: int) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """(the runs of each level, lowest first, and their number: tree, idx, run;
    each tree's root and depth) of ``count`` (tree, idx, n, digest) nodes, n being
    the tree's and ``most`` the largest of these."""
    done, runs = [nodes.where("n = 1").select("tree", F.col("digest").alias("subroot"), F.lit(0).alias("depth"))], []
    while most > 1:
        cur = nodes.where("n > 1")
        cur = cur.coalesce(1) if count <= SMALL else cur
        zeros = cur.where(F.col("idx").bitwiseAND((1 << bits) - 1) == 0)
        offsets = F.explode(F.sequence(F.lit(0), F.least(F.lit((1 << bits) - 1).cast("bigint"), F.col("n") - F.col("idx") - 1).cast("int"))).alias("_slot")
        wanted = zeros.select(F.col("tree").alias("_tree"), "n", (F.col("idx")).alias("_zero"), offsets)
        met = wanted.join(cur.select("tree", "idx", "digest"), (F.col("_tree") == F.col("tree")) & (F.col("idx") == F.col("_zero") + F.col("_slot")))
        level = met.groupBy("tree", F.shiftright("_zero", bits).alias("idx"), "n").agg(F.array_sort(F.collect_list(F.struct("_slot", "digest"))).alias("_of"))
        level = level.select("tree", "idx", "n", F.unhex(F.array_join(F.transform("_of", lambda x: F.hex(x["digest"])), "")).alias("run")).checkpoint()
        count = level.count()
        runs.append((level.select("tree", "idx", "run"), count))
        nodes = level.select("tree", "idx", F.shiftright(F.col("n") + ((1 << bits) - 1), bits).alias("n"), parent_of(F.col("run")).alias("digest"))
        done.append(nodes.where("n = 1").select("tree", F.col("digest").alias("subroot"), F.lit(len(runs)).alias("depth")))
        most = -(-most >> bits)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return runs, out.checkpoint()


def _below(level: tuple[DataFrame, int], up: DataFrame, bits: int) -> DataFrame:
    """The paths of a level's runs, from those of the runs above it."""
    small = level[1] << bits <= SMALL
    level, up = (level[0].coalesce(1), up.coalesce(1)) if small else (level[0], up)
    here = level.select("tree", F.col("idx").alias("_idx"), F.shiftright("idx", bits).alias("run"), F.col("run").alias("_digests"))
    return here.join(up, ["tree", "run"]).withColumn("path", F.concat(F.array("_digests"), "path")).withColumn("run", F.col("_idx")).drop("_idx", "_digests")


def with_paths(m: Manifest) -> DataFrame:
    """Each leaf's row with ``subroot`` and ``steps``: from its own run to the
    root, the digests ``before`` and ``after`` it in hex. Its siblings are both
    together; what stands between them is the leaf, then each parent."""
    depth = F.size("path") - m.top
    d = m.rows.withColumn("run", F.shiftright("idx", m.bits)).join(m.paths, ["tree", "run"])

    def step(run: Column, j: Column) -> Column:
        own = F.call_function("shiftright", F.col("idx"), j * m.bits)
        above = F.call_function("shiftright", F.col("tree"), (j - depth) * m.bits)
        at = F.when(j < depth, own).otherwise(above).bitwiseAND((1 << m.bits) - 1).cast("int") * HEX
        return F.struct(F.substring(text_of(run), F.lit(1), at).alias("before"), F.substring(text_of(run), at + HEX + 1, F.lit(2 ** 31 - 1)).alias("after"))

    return d.withColumn("steps", F.transform("path", step)).drop("run", "path", "tree", "idx")


def proof(steps: Column) -> Column:
    """All siblings in one text, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def folded(leaf_hex: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf_hex, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256))
