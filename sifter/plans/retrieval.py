"""Registered queries of the text core: cleaning, chunking, ids, embedding
and exact nearest-neighbour search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.functions.embedding import bucket_counts
from sifter.functions.text import clean_text
from sifter.operators.chunk import (recursive_chunker, sentence_chunker, separator_chunker,
                                    split_documents, token_chunker)
from sifter.operators.embed import embed
from sifter.operators.ids import chunk_offsets, running_offsets
from sifter.operators.knn import knn
from sifter.plans.common import (CHUNK_KEY, cleaned_documents, dense_recursive_chunks, embedded_chunks,
                                 questions, recursive_chunks, table)


def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned text of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", clean_text("text").alias("content"))


def q_clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table with ``text`` replaced by its cleaned form."""
    docs = table(spark, sf_dir, "documents")
    return docs.withColumn("text", clean_text("text"))


def q_filter_missing_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents whose text is present (left join leaves the
    unmatched label rows with null text, which are dropped)."""
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (labels.join(docs, "doc_id", "left")
                  .where(F.col("text").isNotNull())
                  .select("doc_id", "quality", "toxic", F.length("text").cast("long").alias("n_chars")))


def q_chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 + C6 + C7: recursive chunks (500/80) of cleaned documents."""
    return recursive_chunks(spark, sf_dir).select("doc_id", "chunk_pos", "chunk_text")


def q_chunk_separator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separator chunks (1000/200) of raw text, separator newline."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_documents(docs, separator_chunker(1000, 200, "\n"))


def q_chunk_separator_no_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separator chunks (1000/0) of raw text, separator newline."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_documents(docs, separator_chunker(1000, 0, "\n"))


def q_chunk_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: sentence split then packing (size 1000 / overlap 200 here so that
    documents produce several chunks)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_documents(docs, sentence_chunker(1000, 200, "\n\n"))


def q_chunk_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 256 whitespace tokens with overlap 32."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return split_documents(docs, token_chunker(256, 32))


def q_chunk_dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 + W2: dense ids 0..N-1 over (doc_id, chunk_pos)."""
    return dense_recursive_chunks(spark, sf_dir).select("chunk_id", "doc_id", "chunk_pos")


def q_chunks_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: number of chunks and longest chunk per document."""
    ch = recursive_chunks(spark, sf_dir)
    return ch.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"),
                                    F.max(F.length("chunk_text")).cast("long").alias("max_len"))


def q_embed_hashed_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: hashed term frequencies (64 buckets) of cleaned documents as
    sparse rows (doc_id, bucket, cnt, weight)."""
    docs = cleaned_documents(spark, sf_dir).withColumn("_c", bucket_counts(F.col("content"), 64))
    sq = F.aggregate("_c", F.lit(0).cast("bigint"), lambda a, c: a + c.cast("bigint") * c)
    docs = docs.select("doc_id", "_c", F.sqrt(sq.cast("double")).alias("_n"))
    # no filter on _n: a text without tokens has no positive count anyway, and
    # a predicate on a Python result would be pushed below the exchange
    return (docs.select("doc_id", "_n", F.posexplode("_c").alias("bucket", "cnt"))
                .where(F.col("cnt") > 0)
                .select("doc_id", F.col("bucket").cast("long").alias("bucket"),
                        F.col("cnt").cast("long").alias("cnt"),
                        F.round((F.col("cnt") / F.col("_n")).cast("float").cast("double"), 6).alias("weight")))


def q_embed_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: question vectors, exploded to (item_id, bucket, weight)."""
    q = questions(spark, sf_dir)
    return (q.where(F.col("embedding").isNotNull())
             .select("item_id", F.posexplode("embedding").alias("bucket", "w"))
             .where(F.col("w") > 0)
             .select("item_id", F.col("bucket").cast("long").alias("bucket"),
                     F.round(F.col("w").cast("double"), 6).alias("weight")))


def q_knn_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 + V6 + J7: top-3 chunks per benchmark question by cosine distance."""
    ch = embedded_chunks(spark, sf_dir)
    res = knn(questions(spark, sf_dir), ch, 3, q_id="item_id", c_id="chunk_id",
              carry=["doc_id", "chunk_pos"])
    return res.select("item_id", "rank", "chunk_id", "doc_id", "chunk_pos", "distance")


def q_knn_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5: top-5 neighbours of every stored vector by squared L2 distance."""
    emb = table(spark, sf_dir, "embeddings")
    res = knn(emb.select(F.col("vec_id").alias("qid"), "embedding"), emb, 5,
              q_id="qid", c_id="vec_id", metric="l2", carry=["label"])
    return res.select("qid", "rank", "vec_id", "label", "distance")


def q_knn_vectors_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4 on the stored vectors: top-5 cosine neighbours of every vector."""
    emb = table(spark, sf_dir, "embeddings")
    res = knn(emb.select(F.col("vec_id").alias("qid"), "embedding"), emb, 5,
              q_id="qid", c_id="vec_id", metric="cosine", carry=["label"])
    return res.select("qid", "rank", "vec_id", "label", "distance")


def q_knn_topk_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V6: k = 2, 3, 4 from one ranking to the largest k."""
    ch = embedded_chunks(spark, sf_dir)
    top = knn(questions(spark, sf_dir), ch, 4, q_id="item_id", c_id="chunk_id")
    ks = F.explode(F.array(*[F.lit(x).cast("long") for x in (2, 3, 4)]))
    return (top.select("*", ks.alias("k")).where(F.col("rank") <= F.col("k"))
               .select("item_id", "k", "rank", "chunk_id", "distance"))


def q_knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V8 + P6: metadata-filtered kNN — only chunks whose metadata link
    contains "src1" are candidates. Their ids count all chunks, by sizes
    alone; the filter reaches the scan, and the texts that pass are the only
    ones that are cut for the search and encoded."""
    docs, cut = cleaned_documents(spark, sf_dir), recursive_chunker(500, 80)(F.col("content"))
    offs = running_offsets(docs.select("doc_id", F.size(cut).alias("_n")), "doc_id", "_n").select("doc_id", "offset")
    ch = docs.where(F.col("source").contains("src1")).select("doc_id", "source", F.posexplode(cut).alias("chunk_pos", "chunk_text"))
    ch = ch.withColumn("metadata", F.create_map(F.lit("link"), F.col("source"), F.lit("table"), F.lit("0")))
    res = knn(questions(spark, sf_dir), embed(ch, "chunk_text", "hash64"), 3, q_id="item_id", c_id=CHUNK_KEY, carry=["metadata"])
    return res.join(offs, "doc_id").select("item_id", "rank", (F.col("offset") + F.col("chunk_pos")).alias("chunk_id"), "doc_id",
                                           F.col("metadata")["link"].alias("link"), "distance")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> clean -> recursive chunks -> hashed TF -> cosine top-2
    per benchmark question, with dense chunk ids 0..N-1.

    The search ranks on the key (doc_id, chunk_pos), which orders like the
    dense id; dense offsets are computed on a slim
    (doc_id, n_chunks) frame and joined to the top-k rows only."""
    docs = cleaned_documents(spark, sf_dir)
    arr = docs.select("doc_id", recursive_chunker(500, 80)(F.col("content")).alias("chunks"))
    arr, offs = chunk_offsets(arr, "chunks", "doc_id")
    ch = arr.select("doc_id", F.posexplode("chunks").alias("chunk_pos", "chunk_text"))
    res = knn(questions(spark, sf_dir), embed(ch, "chunk_text", "hash64"), 2, q_id="item_id",
              c_id=CHUNK_KEY)
    return (res.join(offs, "doc_id")
               .select("item_id", "rank", (F.col("offset") + F.col("chunk_pos")).alias("chunk_id"),
                       "doc_id", "distance"))


QUERIES = {
    "clean_text": q_clean_text,
    "clean_table": q_clean_table,
    "filter_missing_content": q_filter_missing_content,
    "chunk_recursive": q_chunk_recursive,
    "chunk_separator": q_chunk_separator,
    "chunk_separator_no_overlap": q_chunk_separator_no_overlap,
    "chunk_sentences": q_chunk_sentences,
    "chunk_tokens": q_chunk_tokens,
    "chunk_dense_ids": q_chunk_dense_ids,
    "chunks_per_document": q_chunks_per_document,
    "embed_hashed_tf": q_embed_hashed_tf,
    "embed_questions": q_embed_questions,
    "knn_cosine": q_knn_cosine,
    "knn_l2": q_knn_l2,
    "knn_vectors_cosine": q_knn_vectors_cosine,
    "knn_topk_sweep": q_knn_topk_sweep,
    "knn_filtered": q_knn_filtered,
    "rag_retrieve_top2": flagship,
}
