"""Registered source/sink and collection queries. Each writes data derived
from the test tables into a fresh path of the shared checkpoint folder and
reads it back through the source under test."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.operators.chunk import separator_chunker, split_documents
from sifter.operators.embed import embed
from sifter.plans.common import dense_recursive_chunks, questions, table
from sifter.plans.pages import nav_links, q_extract_page_text
from sifter.session import scratch_path
from sifter.sources import collection as coll
from sifter.sources.files import (parse_files, read_csv, read_csv_skip_bad, read_glob_csv, read_lines,
                                  rows_to_documents, scan_by_kind, union_drifting, write_csv, write_lines)

PAGES_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("link", T.StringType()),
                             T.StructField("content", T.StringType())])


def q_scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S14: documents as a page table (id, link, content) round-tripped
    through header CSV with quoted multi-line text."""
    path = scratch_path(spark, "pages-csv")
    docs = table(spark, sf_dir, "documents")
    write_csv(docs.select(F.col("doc_id").alias("id"), F.col("source").alias("link"), F.col("text").alias("content")), path)
    return read_csv(spark, path, PAGES_SCHEMA)


def q_scan_csv_with_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV written with a leading 0-based row-index column."""
    path = scratch_path(spark, "pages-idx-csv")
    b = table(spark, sf_dir, "benchmark")
    write_csv(b.select("item_id", "text"), path, index_col="_index", order_by=["item_id"])
    return read_csv(spark, path, "_index long, item_id long, text string")


def q_scan_csv_skip_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as CSV lines without quoting; those whose text holds
    a comma, or that end in a surplus empty field, are too long and skipped."""
    path = scratch_path(spark, "qa-lines")
    docs = table(spark, sf_dir, "documents")
    line = F.regexp_replace("text", "[\"\r\n]", " ")
    # a third of the rows get a surplus field that is empty
    surplus = F.when(F.col("doc_id") % 3 == 0, F.lit(",")).otherwise(F.lit(""))
    docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(","), "lang", F.lit(","), line, surplus).alias("v")).write.text(path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()),
                           T.StructField("line", T.StringType())])
    df = read_csv_skip_bad(spark, path, schema, header=False, multi_line=False)
    return df.select("doc_id", "lang", F.md5("line").alias("line_md5"))


def q_link_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + S13: the resolved navigation links written one per line and
    read back."""
    path = scratch_path(spark, "links")
    write_lines(nav_links(spark, sf_dir), "link", path)
    return read_lines(spark, path).groupBy(F.col("value").alias("link")).agg(F.count(F.lit(1)).alias("n"))


def _result_files(spark: SparkSession, sf_dir: str) -> str:
    """Benchmark results written as one CSV set per grid cell."""
    import uuid

    from sifter.plans.rag import grid
    path = scratch_path(spark, "bench")
    run_id = str(uuid.uuid4())  # one random id per run; cells get a derived id
    cell_id = F.sha2(F.concat_ws("|", F.lit(run_id), "llm", "transformer", F.col("k").cast("string")), 256)
    g = grid(spark, sf_dir).select("question", "ref", "response", "score", F.lit(run_id).alias("run_id"),
                                   cell_id.alias("cell_id"), "llm", "transformer", "k")
    (g.write.partitionBy("llm", "transformer", "k").option("header", True).option("escape", '"')
      .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def q_benchmark_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per written cell, read back with partition discovery."""
    path = _result_files(spark, sf_dir)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"') \
                .schema("question string, ref string, response string, score double, run_id string, "
                        "cell_id string, llm string, transformer string, k long").csv(path)
    return back.groupBy("llm", "transformer", "k").agg(F.count(F.lit(1)).alias("rows"),
                                                       F.round(F.avg("score"), 6).alias("mean_score"),
                                                       F.count_distinct("run_id", "cell_id").alias("files_ids"))


def q_union_result_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 + U1: all result files found by a glob, unioned into one frame."""
    path = _result_files(spark, sf_dir)
    df = read_glob_csv(spark, f"{path}/*/*/*/*.csv", "question string, ref string, response string, score double")
    cell = F.regexp_extract("_file", r"llm=([^/]*)/transformer=([^/]*)/k=([0-9]+)/", 3)
    return df.select(cell.cast("long").alias("k"), "score").groupBy("k").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("score"), 6).alias("mean_score"))


def q_union_drifting_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result files of two layouts, an older one without ``n_chars``, each
    layout read from all of its files at once; what a file lacks is null."""
    root = scratch_path(spark, "drift")
    docs = table(spark, sf_dir, "documents")
    old = F.coalesce(F.col("lang") == "en", F.lit(False))
    write_csv(docs.where(old).select("doc_id", "source"), f"{root}/old")
    write_csv(docs.where(~old).select("source", "n_chars", "doc_id"), f"{root}/new")
    frames = [read_glob_csv(spark, f"{root}/{name}/*.csv", schema).drop("_file")
              for name, schema in (("old", "doc_id long, source string"), ("new", "source string, n_chars long, doc_id long"))]
    return union_drifting(frames)


def _written_pages(spark: SparkSession, sf_dir: str) -> str:
    """Pages as HTML files under ``root/html``, FILE_PAGES to a file at most."""
    root = scratch_path(spark, "files")
    _write_pages(table(spark, sf_dir, "pages"), f"{root}/html")
    return root


#: A file is one row, held whole by the task that parses it.
FILE_PAGES = 200


def _write_pages(pages: DataFrame, path: str) -> None:
    """One line for each page, its number in front."""
    line = F.concat(F.col("page_id").cast("string"), F.lit("\t"), F.regexp_replace("html", "[\r\n]", " "))
    pages.select(line.alias("value")).write.option("maxRecordsPerFile", FILE_PAGES).text(path)


def _page_lines(b: bytes) -> list[tuple[int, str]]:
    return [(int(n), html) for n, _, html in (x.partition("\t") for x in b.decode("utf-8").split("\n")) if n]


def _page_texts(b: bytes) -> list[tuple[int, str]]:
    from sifter.operators.extract import parse_html
    return [(n, parse_html(html).text()) for n, html in _page_lines(b)]


def q_scan_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + S5: files of one kind parsed into documents (one per page)."""
    root = _written_pages(spark, sf_dir)
    el = parse_files(scan_by_kind(spark, root, "html", ext="txt"), {"html": _page_texts})
    return el.select(F.col("unit").alias("page_id"), "kind", F.md5("text").alias("text_md5"), "error")


def q_binary_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files split into units by a parser that cuts at each <p>; all of a
    page's text, what stands before the first <p> included, in its units."""
    root = _written_pages(spark, sf_dir)

    def by_paragraph(b: bytes):
        return [(n, part) for n, html in _page_lines(b) for part in html.split("<p>")]

    el = parse_files(scan_by_kind(spark, root, "html", ext="txt"), {"html": by_paragraph})
    units = F.array_join(F.array_sort(F.collect_list(F.md5("text"))), ",")  # a page's own units
    return el.groupBy(F.col("unit").alias("page_id")).agg(F.count("text").alias("n_pages"), F.sum(F.length("text")).cast("long").alias("n_chars"), F.md5(units).alias("units_md5"))


def q_load_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S9 + P11: page files and a CSV of conversations below one root,
    loaded, split (1000/200 on newlines) and tagged in one path."""
    from sifter.sources.files import load_documents
    root = scratch_path(spark, "tree")
    _write_pages(table(spark, sf_dir, "pages"), f"{root}/pages")
    conv = table(spark, sf_dir, "conversations")
    meta = F.to_json(F.struct(F.col("conv_id").alias("conv"), "turn", F.array("role").alias("tags")))
    write_csv(conv.select("role", "text", meta.alias("metadata")), f"{root}/talks")
    ch = load_documents(spark, root, separator_chunker(1000, 200, "\n"), "role string, text string, metadata string", parsers={"txt": _page_texts})
    page = F.when(F.col("metadata")["kind"] == "txt", F.col("unit"))
    return ch.select(page.alias("page_id"), F.col("metadata")["conv"].try_cast("bigint").alias("conv_id"),
                     F.col("metadata")["turn"].try_cast("bigint").alias("turn"), F.size("metadata").cast("long").alias("n_meta"),
                     "chunk_pos", F.md5("chunk_text").alias("text_md5"))


def q_rows_to_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table's rows turned into one text per key (conversation)."""
    conv = table(spark, sf_dir, "conversations")
    docs = rows_to_documents(conv, ["conv_id"], "turn", ["turn", "role", "text"])
    return docs.select("conv_id", F.md5("text").alias("text_md5"), "n_rows")


def q_text_to_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + P12: the text column split (1000/200 on newlines), each chunk
    tagged {source: local}."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ch = split_documents(docs, separator_chunker(1000, 200, "\n"))
    return ch.select("doc_id", "chunk_pos", F.create_map(F.lit("source"), F.lit("local"))["source"].alias("source"),
                     F.md5("chunk_text").alias("text_md5"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 + U2: text documents, page articles and conversation transcripts
    as one document frame (kind, key, text)."""
    text = table(spark, sf_dir, "documents").select(F.lit("txt").alias("kind"), F.col("doc_id").alias("key"), "text")
    pages = q_extract_page_text(spark, sf_dir).select(F.lit("html").alias("kind"), F.col("page_id").alias("key"),
                                                      F.col("content").alias("text"))
    conv = rows_to_documents(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", ["role", "text"])
    conv = conv.select(F.lit("csv").alias("kind"), F.col("conv_id").alias("key"), "text")
    return text.unionByName(pages).unionByName(conv)


def q_corpus_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union chunked (1000/200 on newlines)."""
    ch = split_documents(corpus(spark, sf_dir), separator_chunker(1000, 200, "\n"))
    return ch.select("kind", "key", "chunk_pos", F.md5("chunk_text").alias("text_md5"))


def _chunk_rows(spark: SparkSession, sf_dir: str, encoder: str = "hash64") -> DataFrame:
    ch = embed(dense_recursive_chunks(spark, sf_dir), "chunk_text", encoder)
    return ch.select(F.col("chunk_id").cast("string").alias("id"), F.col("chunk_text").alias("document"),
                     F.create_map(F.lit("link"), F.col("source"), F.lit("table"), F.lit("0")).alias("metadata"),
                     "embedding", "lang")


def q_collection_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S18 + V3 + J6: get-or-create a cosine collection, add the English
    chunks, then add all chunks (the English ones again): each id once."""
    root = scratch_path(spark, "collections")
    coll.get_or_create(spark, root, "chunks", "cosine")
    rows = _chunk_rows(spark, sf_dir)
    coll.add(spark, root, "chunks", rows.where(F.col("lang") == "en").drop("lang"))
    coll.add(spark, root, "chunks", rows.drop("lang"))
    out = coll.rows(spark, root, "chunks")
    return out.select(F.col("id").cast("long").alias("chunk_id"), F.col("metadata")["link"].alias("link"),
                      F.md5("document").alias("text_md5"), F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 4).alias("vector_sum"))


def q_collection_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S19 + S20 + V8: persist the collection, reopen it instead of
    rebuilding, and answer a filtered top-3 query from the stored rows."""
    root = scratch_path(spark, "collections")
    coll.get_or_create(spark, root, "chunks", "cosine")
    coll.add(spark, root, "chunks", _chunk_rows(spark, sf_dir).drop("lang"))
    qs = questions(spark, sf_dir).select("item_id", "embedding")
    res = coll.query(spark, root, "chunks", qs, 3, where=F.col("link").contains("src1"), q_id="item_id")
    return res.select("item_id", "rank", F.col("id").cast("long").alias("chunk_id"), "distance")


def q_chunk_link_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chunk with its document's link, carried through the explode
    (no join needed)."""
    ch = dense_recursive_chunks(spark, sf_dir)
    return ch.select("chunk_id", "doc_id", F.col("source").alias("link"))


def q_metadata_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata as JSON with nested values; only scalar values kept."""
    docs = table(spark, sf_dir, "documents")
    meta = F.to_json(F.struct("source", "lang", "n_chars",
                              F.array("source", "lang").alias("tags"),
                              F.struct(F.col("doc_id").alias("id")).alias("origin")))
    from sifter.functions.metadata import scalar_metadata
    m = docs.select("doc_id", scalar_metadata(meta).alias("m"))
    return m.select("doc_id", F.explode("m").alias("key", "value"))


QUERIES = {
    "scan_csv": q_scan_csv,
    "scan_csv_with_index": q_scan_csv_with_index,
    "scan_csv_skip_bad": q_scan_csv_skip_bad,
    "link_lines_roundtrip": q_link_lines_roundtrip,
    "benchmark_sink": q_benchmark_sink,
    "union_result_files": q_union_result_files,
    "union_drifting_files": q_union_drifting_files,
    "scan_by_kind": q_scan_by_kind,
    "binary_pages": q_binary_pages,
    "load_documents": q_load_documents,
    "rows_to_documents": q_rows_to_documents,
    "text_to_documents": q_text_to_documents,
    "corpus_union": q_corpus_union,
    "collection_add": q_collection_add,
    "collection_roundtrip": q_collection_roundtrip,
    "chunk_link_join": q_chunk_link_join,
    "metadata_scalars": q_metadata_scalars,
}
