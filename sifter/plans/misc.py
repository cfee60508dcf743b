"""Registered queries: approximate kNN, weighted sampling, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.functions.text import url_host, words
from sifter.functions.vectors import dot
from sifter.operators import pruned, quantized
from sifter.operators.ann import ann_knn
from sifter.operators.knn import knn
from sifter.operators.sample import weighted_choice
from sifter.plans.common import table
from sifter.session import scratch_path


def _quantized(spark: SparkSession, sf_dir: str) -> str:
    """The index of the stored vectors, in the shared folder."""
    path = scratch_path(spark, "quantized")
    quantized.build(table(spark, sf_dir, "embeddings"), path, "vec_id", carry=["label"])
    return path


def q_knn_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: approximate top-5 cosine neighbours of every stored vector, from
    product-quantised codes; as many rows are scored in full as the index
    measured to be needed. Rows-only: ``knn_ann_recall`` holds these rows
    against the exact search."""
    emb = table(spark, sf_dir, "embeddings")
    qs = emb.select(F.col("vec_id").alias("qid"), "embedding")
    res = quantized.search(spark, _quantized(spark, sf_dir), qs, 5, c_id="vec_id", carry=["label"])
    return res.select("qid", "rank", "vec_id", "label", "distance")


def q_knn_ann_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7: the rows of ``knn_ann``: the number of exact neighbours, whether nine
    in ten of them were found, whether all that was found carries its exact
    distance, and whether at most a quarter of the vectors is scored in full
    for a question."""
    emb, path = table(spark, sf_dir, "embeddings"), _quantized(spark, sf_dir)
    qs = emb.select(F.col("vec_id").alias("qid"), "embedding")
    found = quantized.search(spark, path, qs, 5, c_id="vec_id").select("qid", "vec_id", F.col("distance").alias("found"))
    exact = knn(qs, emb, 5, c_id="vec_id").select("qid", "vec_id", "distance")
    both = exact.join(found, ["qid", "vec_id"], "left")
    s = quantized.settings(spark, path)
    return both.agg(F.count(F.lit(1)).alias("neighbours"), (F.count("found") >= 0.9 * F.count(F.lit(1))).alias("nine_in_ten"),
                    F.coalesce(F.bool_and(F.abs(F.col("found") - F.col("distance")) <= 2e-6), F.lit(True)).alias("exact_distances"),
                    F.lit(4 * s["rerank"] <= s["n"]).alias("a_quarter_at_most"))


def q_knn_ann_exhaustive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V7 machinery checked by value: every cell probed (4 of 4) and cells
    split into salted blocks of at most 100 rows, so the inverted-file plan
    must return exactly the exact search's top-5."""
    emb = table(spark, sf_dir, "embeddings")
    res = ann_knn(emb.select(F.col("vec_id").alias("qid"), "embedding"), emb, 5, q_id="qid", c_id="vec_id",
                  carry=["label"], nlist=4, nprobe=4, block_rows=100)
    return res.select("qid", "rank", "vec_id", "label", "distance")


def q_knn_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 + J7: the exact search from stored blocks, those skipped that the
    triangle inequality rules out."""
    emb, path = table(spark, sf_dir, "embeddings"), scratch_path(spark, "pruned")
    pruned.build(emb, path, "vec_id", carry=["label"], block_rows=500)
    res, _ = pruned.search(spark, path, emb.select(F.col("vec_id").alias("qid"), "embedding"), 5, c_id="vec_id", carry=["label"])
    return res.select("qid", "rank", "vec_id", "label", "distance")


def q_weighted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per source, drawn with probability proportional to
    its length (rows-only: random)."""
    docs = table(spark, sf_dir, "documents")
    return weighted_choice(docs, "n_chars", ["doc_id", "n_chars"], ["source"], draws=1)


def q_scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1-F11 over documents."""
    d = table(spark, sf_dir, "documents")
    w = words(F.col("text"))
    return d.select(
        "doc_id",
        F.md5(F.lower("text")).alias("lower_md5"),
        F.size(w).cast("long").alias("n_words"),
        F.try_element_at(w, F.lit(1)).alias("first_word"),
        F.length(F.trim("text")).cast("long").alias("trimmed_len"),
        F.length(F.replace("text", F.lit("\n"), F.lit(""))).cast("long").alias("no_newline_len"),
        F.length(F.regexp_replace("text", "[0-9]", "")).cast("long").alias("no_digit_len"),
        F.lower("text").contains("the").alias("has_the"),
        F.instr("text", "e").cast("long").alias("first_e"),
        F.coalesce(F.try_element_at(w, F.lit(1)).rlike("^[0-9]+$"), F.lit(False)).alias("starts_with_number"),
        F.col("doc_id").cast("string").alias("id_str"),
        F.format_string("%s-%d", "lang", "doc_id").alias("label"),
        F.length("text").cast("long").alias("n_chars"))


def q_scalar_misc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12-F15, F18, F20 over stored vectors."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id",
        F.size(F.sequence(F.lit(1), F.col("label") + 1)).cast("long").alias("seq_len"),
        F.least(F.col("label"), F.lit(3)).cast("long").alias("least3"),
        F.struct("label", "vec_id")["label"].cast("long").alias("nested_label"),
        F.create_map(F.lit("label"), F.col("label"))["label"].cast("long").alias("map_label"),
        F.when(F.col("label") > 5, "hi").otherwise("lo").alias("band"),
        F.round(dot("embedding", "embedding"), 6).alias("sq_norm"))


def q_url_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """host of each page URL and whether it is inside the site root."""
    p = table(spark, sf_dir, "pages")
    h = url_host(F.col("url"))
    return p.select("page_id", h.alias("host"), h.endswith(".example.com").alias("in_site"))


QUERIES = {
    "knn_ann": q_knn_ann,
    "knn_ann_recall": q_knn_ann_recall,
    "knn_ann_exhaustive": q_knn_ann_exhaustive,
    "knn_pruned": q_knn_pruned,
    "weighted_sample": q_weighted_sample,
    "scalar_strings": q_scalar_strings,
    "scalar_misc": q_scalar_misc,
    "url_hosts": q_url_hosts,
}
