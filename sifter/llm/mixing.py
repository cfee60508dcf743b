"""Mixing sources to target weights [native].

Sizes are summed per source (partial sums first). Sources in code-point order,
null last, weigh 1, 2, 3, repeating, and share the whole by weight; a target
stops at CAP times its source's size and the excess is shared out again among
the others by weight, until none is above. The repetition rate of a source is
target / size. Each document is emitted floor(rate) times, plus one copy with
probability equal to the fraction, drawn from a hash of seed, document id and
text, so that reruns agree on any cluster.

Nulls and ties: null text has size 0; null source is a source of its own; null
ids draw as the empty id; rows that repeat an id draw alike. A source of size 0
has target 0 and its documents are not emitted. Extra columns are kept by
``mix`` and ignored by ``plan_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.skew import salted_join
from sifter.operators.ids import dense_index
from sifter.session import checkpoint_dir

CAP = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: So many sources at most are broadcast to the documents; more are joined.
FEW = 10_000


def size_of(text: Column) -> Column:
    """Number of words (runs of other than space and \\x09-\\x0D)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def digest_of(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def draw(id_col: str, digest_col: str, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed, the id and the text alone."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.col(digest_col))
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(13)), 16, 10).cast("bigint") / F.lit(float(16 ** 13))


def targets(sizes: DataFrame, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source_key, n, source_size, target) from (source_key, size): one row per source."""
    checkpoint_dir(sizes.sparkSession)
    per = sizes.groupBy("source_key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    per = dense_index(per, [F.col("source_key.none"), F.col("source_key.name")], "rank")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("bigint")
    per = per.withColumn("w", w).withColumn("most", F.col("source_size") * cap).drop("rank").checkpoint()
    total = per.agg(F.sum("source_size")).first()[0] or 0
    full, n_full, rest, weight = F.lit(False), 0, 0, 0
    while True:  # each turn closes sources; ends when none closes
        r = per.agg(F.sum(F.when(full, F.col("most")).otherwise(0)).alias("spent"), F.sum(F.when(full, 0).otherwise(F.col("w"))).alias("w"),
                    F.sum(full.cast("int")).alias("n")).first()
        rest, weight = total - (r["spent"] or 0), r["w"] or 0
        if not weight or (n_full and r["n"] == n_full):
            break
        n_full, last = r["n"], full
        # exact: most * weight < rest * w, in decimals
        dec = "decimal(38,0)"
        full = last | (F.col("most").cast(dec) * F.lit(weight).cast("decimal(19,0)") < F.col("w").cast(dec) * F.lit(rest).cast("decimal(19,0)"))
        if per.where(full & ~last).isEmpty():
            full = last
            break
    share = F.col("w").cast("double") * F.lit(float(rest)) / F.lit(float(weight or 1))
    return per.select("source_key", "n", "source_size",
                      F.when(full, F.col("most").cast("double")).otherwise(F.least(share, F.col("most").cast("double"))).alias("target"))


def source_key(col: str) -> Column:
    return F.struct(F.col(col).isNull().alias("none"), F.coalesce(F.col(col), F.lit("")).alias("name"))


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             seed: str = SEED) -> DataFrame:
    """Per row: id, size, source_size, target, copies."""
    checkpoint_dir(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), source_key(source_col).alias("source_key"), size_of(F.col(text_col)).alias("size"),
                       digest_of(F.col(text_col)).alias("digest")).checkpoint()
    plan = targets(rows).checkpoint()
    out = salted_join(rows, plan.drop("n"), "source_key", plan.select("source_key", "n"))
    return out.select("id", "size", "source_size", "target", copies(F.col("target"), F.col("source_size"), "id", "digest", seed).alias("copies"))


def copies(target: Column, size: Column, id_col: str, digest_col: str, seed: str = SEED) -> Column:
    rate = F.when(size > 0, target / size).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    return (whole + (draw(id_col, digest_col, seed) < rate - whole).cast("int")).cast("bigint")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """``docs`` with each row emitted as often as the mix takes it, columns as they are."""
    checkpoint_dir(docs.sparkSession)
    sizes = docs.select(source_key(source_col).alias("source_key"), size_of(F.col(text_col)).alias("size"))
    plan = targets(sizes).checkpoint()
    keyed = docs.select(F.struct("*").alias("row"), source_key(source_col).alias("source_key"), F.col(id_col).alias("id"), digest_of(F.col(text_col)).alias("digest"))
    if plan.count() <= FEW:
        out = keyed.join(F.broadcast(plan.drop("n")), "source_key", "left")
    else:
        out = salted_join(keyed, plan.drop("n"), "source_key", plan.select("source_key", "n"))
    n = copies(F.col("target"), F.col("source_size"), "id", "digest", seed).cast("int")
    return out.select("row", F.explode(F.array_repeat(F.lit(0), n)).alias("_copy")).select("row.*")
