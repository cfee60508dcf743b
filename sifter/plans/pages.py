"""Registered queries over raw pages: text and link extraction, link-list
set operations, page ids, article records, keywords and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.functions.text import digit_tokens, words
from sifter.operators.extract import attr_of, extract, links_of, resolve_link, text_of, texts_of
from sifter.operators.ids import dense_index
from sifter.operators.keywords import keywords_topn, summary_topn
from sifter.plans.common import table

SITE_ROOT = ".example.com"


def nav_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, lang, pos, href, link) for every anchor under the first <nav>."""
    p = extract(table(spark, sf_dir, "pages"), "html", [attr_of("html", "lang", "lang"), links_of("nav_links", within="nav")], keep=["page_id", "url"])
    return (p.select("page_id", "url", "lang", F.explode("nav_links").alias("a"))
             .select("page_id", "lang", F.col("a.pos").alias("pos"), F.col("a.href").alias("href"),
                     resolve_link(F.col("url"), F.col("a.href")).alias("link")))


def q_extract_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + P7: text of the content element; pages without one are dropped."""
    p = extract(table(spark, sf_dir, "pages"), "html", [text_of("article", "content")], keep=["page_id", "url"])
    return p.where(F.col("content").isNotNull()).select("page_id", "url", "content")


def q_extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2 + P8: anchors with href under the navigation element, resolved."""
    return nav_links(spark, sf_dir).select("page_id", "pos", "href", "link")


def q_extract_sublinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: anchors in list items of a list, below the navigation element."""
    p = extract(table(spark, sf_dir, "pages"), "html", [links_of("sub", within="nav", under=("ul", "li"))], keep=["page_id"])
    return p.select("page_id", F.explode("sub").alias("a")).select("page_id", F.col("a.pos").alias("pos"), F.col("a.href").alias("href"))


def q_extract_all_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: texts of every element matching div.ad."""
    p = extract(table(spark, sf_dir, "pages"), "html", [texts_of("div.ad", "ads")], keep=["page_id"])
    return p.select("page_id", F.posexplode("ads").alias("pos", "text")) \
            .withColumn("pos", F.col("pos").cast("long"))


def q_filter_links_by_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: resolved links that stay inside the site root."""
    return (nav_links(spark, sf_dir).where(F.col("link").contains(SITE_ROOT))
            .select("page_id", "pos", "link"))


def q_distinct_links_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct hrefs with their first-seen position and occurrence count."""
    nl = nav_links(spark, sf_dir)
    first = F.min(F.struct("page_id", "pos"))
    return (nl.groupBy("href").agg(first.alias("f"), F.count(F.lit(1)).alias("n"))
              .select("href", F.col("f.page_id").alias("first_page"), F.col("f.pos").alias("first_pos"), "n"))


def q_new_links_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hrefs of non-English pages that no English page already links."""
    nl = nav_links(spark, sf_dir)
    known = nl.where(F.col("lang") == "en").select("href")
    fresh = nl.where(~F.col("lang").eqNullSafe("en")).select("href").distinct()
    return fresh.join(known, "href", "left_anti")


def q_link_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of two link lists (French pages first, then all pages),
    each link once, at its first-seen position (list, page, pos)."""
    nl = nav_links(spark, sf_dir)
    a = nl.where(F.col("lang") == "fr").select(F.lit(0).alias("list"), "page_id", "pos", "href")
    b = nl.select(F.lit(1).alias("list"), "page_id", "pos", "href")
    u = a.unionByName(b)
    first = F.min(F.struct("list", "page_id", "pos"))
    return (u.groupBy("href").agg(first.alias("f"))
             .select("href", F.col("f.list").cast("long").alias("first_list"),
                     F.col("f.page_id").alias("first_page"), F.col("f.pos").alias("first_pos")))


def q_page_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running id over successfully extracted pages, in page order."""
    ok = q_extract_page_text(spark, sf_dir).select("page_id", "url")
    return dense_index(ok, ["page_id"], "id").select("id", "page_id", "url")


def q_article_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7: article record per page (title, text, source site, images, keywords, summary)."""
    from sifter.operators.keywords import summary, top_keywords
    p = extract(table(spark, sf_dir, "pages"), "html", [
        text_of("article", "content"), text_of("title", "title"), attr_of("img", "src", "images", all_=True),
        attr_of("meta[property=article:published_time]", "content", "published_raw")], keep=["page_id", "url"])
    source = F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    return p.select("page_id", "title", source.alias("source"),
                    F.md5("content").alias("text_md5"),
                    F.array_join(F.transform(top_keywords("content", 5), lambda k: k["keyword"]), " ").alias("keywords"),
                    F.md5(summary("content", 10, 2)).alias("summary_md5"),
                    F.size("images").cast("long").alias("n_images"),
                    F.try_element_at("images", F.lit(1)).alias("top_image"),
                    F.date_format(F.try_to_timestamp("published_raw").cast("timestamp_ntz"),
                                  "yyyy-MM-dd HH:mm:ss").alias("published_date"))


def q_article_per_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8 over documents: one row per author, an article without author
    yields no row. Authors of a document = the ``source`` it came from plus
    its language tag when the text is French (a stand-in author list)."""
    docs = table(spark, sf_dir, "documents")
    authors = F.when(F.col("lang") == "fr", F.array("source", "lang")).otherwise(
        F.when(F.col("lang") == "en", F.array("source")).otherwise(F.array().cast("array<string>")))
    return docs.select("doc_id", F.explode(authors).alias("author"))


def q_keywords_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9: top-10 keywords per document."""
    return keywords_topn(table(spark, sf_dir, "documents"), "doc_id", "text", 10)


def q_summary_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best sentences per document, in text order."""
    return summary_topn(table(spark, sf_dir, "documents"), "doc_id", "text", 10, 5)


def q_page_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: first and second all-digit tokens of a text (current page, max
    page); texts with no digit token are skipped."""
    docs = table(spark, sf_dir, "documents")
    d = digit_tokens(F.col("text"))
    return (docs.select("doc_id", d.alias("d")).where(F.size("d") > 0)
                .select("doc_id",
                        F.try_element_at("d", F.lit(1)).try_cast("bigint").alias("current_page"),
                        F.try_element_at("d", F.lit(2)).try_cast("bigint").alias("max_page")))


def q_search_urls(spark: SparkSession, sf_dir: str, limit: int = 10, inclusive: bool = False) -> DataFrame:
    """H11 + J4 + O5: search URLs token x page 1..min(max_pages, limit)-1.
    A token is the first three words of a benchmark text, URL-encoded; its word
    count divided by five stands for the result page count."""
    b = table(spark, sf_dir, "benchmark")
    w = words(F.col("text"))
    token = F.url_encode(F.array_join(F.slice(w, 1, 3), " "))
    max_pages = (F.size(w) / 5).cast("int")
    top = F.least(max_pages, F.lit(limit)) + (1 if inclusive else 0)
    pages = F.when(top >= 2, F.sequence(F.lit(1), top - 1)).otherwise(F.array().cast("array<int>"))
    return (b.select("item_id", token.alias("token"), F.explode(pages).alias("page"))
             .select("item_id", F.col("page").cast("long").alias("page"),
                     F.format_string("https://search.example.org/search?q=%s&limit=10&page=%d",
                                     F.col("token"), F.col("page")).alias("url")))


QUERIES = {
    "extract_page_text": q_extract_page_text,
    "extract_links": q_extract_links,
    "extract_sublinks": q_extract_sublinks,
    "extract_all_by_class": q_extract_all_by_class,
    "filter_links_by_domain": q_filter_links_by_domain,
    "distinct_links_ordered": q_distinct_links_ordered,
    "new_links_anti": q_new_links_anti,
    "link_union_distinct": q_link_union_distinct,
    "page_ids": q_page_ids,
    "article_records": q_article_records,
    "article_per_author": q_article_per_author,
    "keywords_topn": q_keywords_topn,
    "summary_topn": q_summary_topn,
    "page_counter": q_page_counter,
    "search_urls": q_search_urls,
}
