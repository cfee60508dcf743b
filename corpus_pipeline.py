"""The corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet in the shared folder and rereads them as the next
stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.session import checkpoint_dir, scratch_path, ship_package

#: The vocabulary that documents are packed with, and the id that ends a document.
TOKENIZER, END_ID = "word_bpe_49k.json", 2
#: Documents whose language has a lower posterior than this are rejected.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned from the labelled rows; those
    without a letter, or as likely in another language, go."""
    from sifter.llm.language_id import identify, train
    ship_package(spark)
    names, matrix = train(docs)
    return (identify(docs, names, matrix).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(docs.columns))


def _row_keys(id_col: str) -> list:
    """A row's id as keys that a join can use: null is not 0."""
    return [F.col(id_col).isNull().alias("_none"), F.coalesce(F.col(id_col), F.lit(0)).alias("_row")]


def _one_each(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Of the rows that share ``keys`` the same one in every run, whatever their order."""
    least = F.min_by(F.struct(*columns), F.struct(F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))]).alias("h"), "text"))
    return rows.groupBy(*keys).agg(least.alias("_one")).select("_one.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts; the texts are shuffled once, by id and digest."""
    from sifter.llm.exact_dedup import exact_dedup, normalised
    keys = ["_none", "_row", "_sha"]
    stay = exact_dedup(docs).where("kept").select(*_row_keys("id"), F.col("text_sha256").alias("_sha"))
    d = docs.select("*", *_row_keys("doc_id"), F.sha2(normalised(F.col("text")), 256).alias("_sha"))
    return _one_each(d.join(stay, keys, "left_semi"), keys, docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies (five words, similarity 0.8)."""
    from sifter.llm.minhash_dedup import near_duplicates
    ship_package(spark)
    keys = ["_none", "_row", "_key"]
    stay = near_duplicates(docs, shingle=5, percent=80).where("first").select(*_row_keys("doc_id"), F.col("key").alias("_key"))
    d = docs.select("*", *_row_keys("doc_id"), F.xxhash64("text").alias("_key"))
    return _one_each(d.join(stay, keys, "left_semi"), keys, docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated or thinned to their target weights."""
    from sifter.llm.mixing import mix
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    import public_tokenizers

    from sifter.llm.packing import pack
    ship_package(spark)
    return pack(docs, public_tokenizers.path(TOKENIZER), END_ID)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mixing", mixing), ("packing", packing)]
#: Language ID and tokenizers are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``: the pieces of the packed sequences."""
    ship_package(spark)
    checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
