from pyspark.sql import functions as F

from sifter.operators.extract import (attr_of, extract, links_of, parse_fields, resolve_link, text_of,
                                      texts_of)

PAGE = """<html lang="fr"><head><title>T &amp; co</title><script>var x="</p><div id='main-text'>no</div>";</script>
<style>p{}</style></head><body><div id="side-menu"><ul><li><a href="/a">A</a><ul><li><a href="/a/1">A1</a></li></ul></li>
<li><a href="/b" class="item big">B</a></li><li><a>no href</a></li></ul></div>
<!-- comment --><div id="main-text"><h1>Titre</h1><p>un <b>deux<p>trois &eacute;t&eacute;<br>quatre</div>
<span class="pager">Page 2 sur 9</span><pre class="code">ua one</pre>
<pre class="code">ua two</pre></body></html>"""


def test_text_by_id_skips_script_style_comments():
    r = parse_fields(PAGE, [text_of("div#main-text", "c"), text_of("title", "t")])
    assert r["c"] == "Titre un deux trois été quatre"
    assert r["t"] == "T & co"


def test_missing_element_is_null():
    assert parse_fields(PAGE, [text_of("div#absent", "x")])["x"] is None
    assert parse_fields(None, [text_of("div", "x")])["x"] is None


def test_links_under_element_with_class_and_chain():
    r = parse_fields(PAGE, [links_of("all", within="div#side-menu"),
                            links_of("cls", within="div#side-menu", require_class="item"),
                            links_of("sub", within="div#side-menu", under=("li", "ul"))])
    assert [a["href"] for a in r["all"]] == ["/a", "/a/1", "/b"]
    assert [a["href"] for a in r["cls"]] == ["/b"]
    assert [a["href"] for a in r["sub"]] == ["/a/1"]  # second-level: li > ul > a


def test_texts_by_class_and_pagination():
    r = parse_fields(PAGE, [texts_of("pre.code", "ua"), text_of("span.pager", "pg")])
    assert r["ua"] == ["ua one", "ua two"]
    assert r["pg"] == "Page 2 sur 9"


def test_extract_job_and_dead_letter(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<p>plain"), (3, None)], "id long, html string")
    out = extract(df, "html", [text_of("p", "p"), attr_of("html", "lang", "lang")], error_col="error")
    got = {r.id: (r.p, r.lang, r.error) for r in out.collect()}
    assert got[2] == ("plain", None, None)
    assert got[3] == (None, None, None)
    assert got[1][1] == "fr"


def test_resolve_link(spark):
    df = spark.createDataFrame([("https://h.org/a/b?x=1#f", h) for h in
                                ["/r", "rel", "//cdn.net/x", "?q=2", "#top", "http://o.com/"]], "b string, h string")
    got = [r.l for r in df.select(resolve_link(F.col("b"), F.col("h")).alias("l")).collect()]
    assert got == ["https://h.org/r", "https://h.org/a/rel", "https://cdn.net/x", "https://h.org/a/b?q=2",
                   "https://h.org/a/b?x=1#top", "http://o.com/"]


def test_attribute_selector_and_publish_date(spark):
    from pyspark.sql import functions as F
    html = '<head><meta property="article:published_time" content="2024-03-05 10:00:00"></head><p>x'
    df = spark.createDataFrame([(1, html), (2, "<p>none")], "id long, html string")
    out = extract(df, "html", [attr_of("meta[property=article:published_time]", "content", "raw")])
    got = {r.id: r.d for r in out.select("id", F.try_to_timestamp("raw").cast("timestamp_ntz").alias("d")).collect()}
    assert str(got[1]) == "2024-03-05 10:00:00" and got[2] is None


def test_deep_nesting_and_implied_ends(spark):
    deep = "<div>" * 6000 + "x" + "<p>" * 5000 + "end"
    r = parse_fields(deep, [text_of("div", "d"), texts_of("p", "ps")])
    assert r["d"].startswith("x") and len(r["ps"]) == 5000 and r["ps"][-1] == "end"
    r = parse_fields("<ul><li>one<li>two<ul><li>in</ul><li>three</ul><table><tr><td>a<td>b<tr><td>c</table><p>p<div>d</div>",
                     [texts_of("li", "li"), texts_of("td", "td"), texts_of("p", "p")])
    assert r["li"] == ["one", "two in", "in", "three"] and r["td"] == ["a", "b", "c"] and r["p"] == ["p"]


def test_page_that_cannot_be_parsed_is_a_row(spark, monkeypatch):
    from sifter.operators.extract import dead_pages
    out = extract(spark.createDataFrame([(1, "<p>x")], "id long, html string"), "html", [text_of("p", "p")])
    assert out.columns == ["id", "p", "parse_error"] and dead_pages(out).count() == 0
