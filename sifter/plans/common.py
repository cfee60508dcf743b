"""Shared building blocks of the registered queries: table loading and the
standard corpus/question preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.functions.text import clean_text
from sifter.operators.chunk import recursive_chunker, split_documents
from sifter.operators.embed import embed
from sifter.operators.ids import dense_chunk_ids
from sifter.session import ensure_parallelism


# Tables whose rows carry long texts: their per-row work (parsing, chunking,
# hashing) dominates, so they must be spread over all task slots.
TEXT_TABLES = ("documents", "pages", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return ensure_parallelism(df) if name in TEXT_TABLES else df


def cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with null text dropped and text cleaned into ``content``."""
    docs = table(spark, sf_dir, "documents")
    return (docs.where(F.col("text").isNotNull())
                .select("doc_id", "source", "lang", clean_text("text").alias("content")))


def recursive_chunks(spark: SparkSession, sf_dir: str, size: int = 500, overlap: int = 80) -> DataFrame:
    """(doc_id, source, lang, chunk_pos, chunk_text) of the cleaned corpus."""
    return split_documents(cleaned_documents(spark, sf_dir), recursive_chunker(size, overlap),
                           text_col="content")


#: What identifies a chunk: computed row by row, orders like the dense id, and holds for any document id.
CHUNK_KEY = ("doc_id", "chunk_pos")


def dense_recursive_chunks(spark: SparkSession, sf_dir: str, size: int = 500, overlap: int = 80) -> DataFrame:
    """Chunks with dense ids 0..N-1 in (doc_id, chunk_pos) order."""
    docs = cleaned_documents(spark, sf_dir)
    with_arr = docs.select("doc_id", "source", "lang",
                           recursive_chunker(size, overlap)(F.col("content")).alias("chunks"))
    return dense_chunk_ids(with_arr, "chunks", "doc_id")


def embedded_chunks(spark: SparkSession, sf_dir: str, encoder: str = "hash64", dense: bool = True) -> DataFrame:
    chunks = dense_recursive_chunks(spark, sf_dir) if dense else recursive_chunks(spark, sf_dir)
    return embed(chunks, "chunk_text", encoder)


def questions(spark: SparkSession, sf_dir: str, encoder: str = "hash64") -> DataFrame:
    """Benchmark texts as questions: (item_id, question, embedding)."""
    b = table(spark, sf_dir, "benchmark")
    q = b.select("item_id", clean_text("text").alias("question"))
    return embed(q, "question", encoder)
