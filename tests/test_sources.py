import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.functions.metadata import scalar_metadata
from sifter.sources import collection as coll
from sifter.sources.files import (parse_files, read_csv, read_csv_skip_bad, read_lines, rows_to_documents,
                                  scan_by_kind, scan_tree, write_lines)

QA = 'question,reponse\n"q1","r1"\n"q2, long","r2","extra"\nq3\n"q4\nsecond line","r4"\nq5,r5,\nq6,r6,,,\n"q7,,",r7\n'


def _file(content: str, name: str) -> str:
    d = tempfile.mkdtemp(prefix="sifter-test-")
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(content)
    return p


def test_csv_skip_bad_lines(spark):
    schema = T.StructType([T.StructField("question", T.StringType()), T.StructField("reponse", T.StringType())])
    got = [tuple(r) for r in read_csv_skip_bad(spark, _file(QA, "qa.csv"), schema).collect()]
    assert got == [("q1", "r1"), ("q3", None), ("q4\nsecond line", "r4"), ("q7,,", "r7")]  # too-long lines skipped, surplus empty fields too; short padded


def test_csv_multiline_and_lines_roundtrip(spark):
    got = read_csv(spark, _file(QA, "qa.csv"), "question string, reponse string").collect()
    assert got[3].question == "q4\nsecond line"
    d = tempfile.mkdtemp(prefix="sifter-lines-")
    links = spark.createDataFrame([("http://a/1",), ("http://a/2",)], "link string")
    write_lines(links, "link", d + "/out")
    assert sorted(r.value for r in read_lines(spark, d + "/out").collect()) == ["http://a/1", "http://a/2"]


def test_parser_failure_is_a_row(spark):
    root = tempfile.mkdtemp(prefix="sifter-files-")
    os.makedirs(root + "/txt")
    for i, body in enumerate(["hello", "world"]):
        with open(f"{root}/txt/f{i}.txt", "w") as f:
            f.write(body)

    def fragile(b: bytes):
        if b == b"world":
            raise ValueError("cannot parse")
        return [(0, b.decode())]

    out = parse_files(scan_by_kind(spark, root, "txt"), {"txt": fragile}).collect()
    assert sorted(((r.text or ""), r.error is None) for r in out) == [("", False), ("hello", True)]
    tree = parse_files(scan_tree(spark, root)).collect()  # whole tree, kind from the extension
    assert sorted(r.text for r in tree) == ["hello", "world"]


def test_rows_to_documents_order(spark):
    df = spark.createDataFrame([(1, 2, "c"), (1, 0, "a"), (1, 1, None)], "f long, r long, v string")
    assert rows_to_documents(df, ["f"], "r", ["v"]).first().text == "a\n\nc"


def test_collection_insert_if_absent(spark):
    root = tempfile.mkdtemp(prefix="sifter-coll-")
    meta = coll.get_or_create(spark, root, "c", "l2")
    assert meta["metric"] == "l2" and coll.get_or_create(spark, root, "c", "cosine")["metric"] == "l2"
    rows = spark.createDataFrame([("1", "a", {"link": "x"}, [1.0, 0.0]), ("2", "b", {"link": "y"}, [0.0, 1.0])],
                                 "id string, document string, metadata map<string,string>, embedding array<float>")
    coll.add(spark, root, "c", rows)
    coll.add(spark, root, "c", rows.union(rows))
    assert coll.rows(spark, root, "c").count() == 2
    q = spark.createDataFrame([(9, [0.9, 0.1])], "qid long, embedding array<float>")
    hit = coll.query(spark, root, "c", q, 1, where=F.col("metadata")["link"] == "y").first()
    assert hit.id == "2"


def test_metadata_scalars(spark):
    df = spark.createDataFrame([('{"a": "x", "n": 3, "b": true, "l": [1], "o": {"k": 1}, "z": null}',)], "j string")
    assert df.select(scalar_metadata("j").alias("m")).first().m == {"a": "x", "n": "3", "b": "true"}
    odd = spark.createDataFrame([('{"t": "[draft] title", "u": "{x}", "o": [1]}',), (None,)], "j string")
    assert [r.m for r in odd.select(scalar_metadata("j").alias("m")).collect()] == [{"t": "[draft] title", "u": "{x}"}, None]


def test_collection_keeps_whole_rows_and_few_files(spark, tmp_path):
    schema = "id string, document string, metadata map<string,string>, embedding array<float>"
    coll.get_or_create(spark, str(tmp_path), "c")
    rows = [(str(i), None if i % 10 == 0 else f"d{i}", {"link": f"l{i % 3}"}, [float(i), 1.0]) for i in range(2000)]
    coll.add(spark, str(tmp_path), "c", spark.createDataFrame(rows, schema).repartition(8))
    got = {r.id: (r.document, r.metadata, list(r.embedding), r.link) for r in coll.rows(spark, str(tmp_path), "c").collect()}
    assert got == {i: (d, m, e, m["link"]) for i, d, m, e in rows}
    files = [f for _, _, names in os.walk(f"{tmp_path}/c/data") for f in names if f.endswith(".parquet")]
    assert len(files) == 1  # one bucket for few rows
    plan = coll.rows(spark, str(tmp_path), "c").where("link = 'l1'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(link,l1)" in plan


def test_broken_collection_is_an_error(spark, tmp_path):
    import pytest
    os.makedirs(f"{tmp_path}/c/meta")
    with open(f"{tmp_path}/c/meta/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|read"):
        coll.get_or_create(spark, str(tmp_path), "c")


COLL = "id string, document string, metadata map<string,string>, embedding array<float>"


def _rows(spark, ids, who):
    return spark.createDataFrame([(f"i{i}", f"{who} {i}", {"link": "l"}, [float(i), 1.0]) for i in ids], COLL)


def test_two_writers_leave_each_id_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    root = str(tmp_path)
    coll.get_or_create(spark, root, "c")
    with ThreadPoolExecutor(3) as pool:
        added = list(pool.map(lambda w: coll.add(spark, root, "c", _rows(spark, range(w * 50, w * 50 + 100), f"w{w}")), range(3)))
    got = coll.rows(spark, root, "c").collect()
    assert sorted(int(r.id[1:]) for r in got) == list(range(200)) and sum(added) == 200
    assert all(int(r.document.split()[1]) == int(r.id[1:]) for r in got)
    assert coll.add(spark, root, "c", _rows(spark, range(200), "late")) == 0


def test_a_lost_race_is_tried_again(spark, tmp_path, monkeypatch):
    """Another writer publishes between reading the version and publishing the next."""
    from sifter.sources.versions import Versions
    root, plain, other = str(tmp_path), Versions.publish, []
    coll.get_or_create(spark, root, "c")

    def late(self, number, folders):
        if not other:
            other.append(1)
            coll.add(spark, root, "c", _rows(spark, range(5), "first"))
        return plain(self, number, folders)
    monkeypatch.setattr(Versions, "publish", late)
    assert coll.add(spark, root, "c", _rows(spark, range(3, 9), "second")) == 4
    assert {r.id: r.document for r in coll.rows(spark, root, "c").collect()} == {f"i{i}": f"{'first' if i < 5 else 'second'} {i}" for i in range(9)}
    versions = Versions(spark, f"{root}/c")
    assert versions.numbers() == [1, 2] and coll.rows(spark, root, "c", 1).count() == 5 and not plain(versions, 2, [])
    assert len(os.listdir(f"{root}/c/data")) == 2  # what lost the race is gone
    assert coll.compact(spark, root, "c") and coll.rows(spark, root, "c").count() == 9 and len(versions.latest()[1]) == 1


def test_buckets_and_tasks_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(coll, "ROWS_PER_BUCKET", 100)
    root = str(tmp_path)
    coll.get_or_create(spark, root, "c")
    for lo, hi in ((0, 50), (50, 450), (400, 4000)):
        coll.add(spark, root, "c", _rows(spark, range(lo, hi), "w"))
    from sifter.sources.versions import Versions
    assert [(f["buckets"], f["rows"]) for f in Versions(spark, f"{root}/c").latest()[1]] == [(1, 50), (4, 400), (64, 3550)]
    assert coll.rows(spark, root, "c").select("id").distinct().count() == coll.rows(spark, root, "c").count() == 4000


def test_a_collection_is_searched_by_ids_and_vectors_alone(spark, monkeypatch):
    from sifter.operators import knn as search
    root, seen, plain = tempfile.mkdtemp(prefix="sifter-coll-"), [], search.knn

    def watched(qs, corpus, k, **given):
        seen.append(given.get("carry", ()))
        return plain(qs, corpus, k, **given)

    monkeypatch.setattr(search, "knn", watched)
    coll.get_or_create(spark, root, "c", "l2")
    data = [(str(i), f"text {i}", {"link": "x"}, [float(i), 0.0]) for i in range(6)]
    coll.add(spark, root, "c", spark.createDataFrame(data, coll.ROW_SCHEMA))
    q = spark.createDataFrame([(1, [2.0, 0.0]), (2, [5.0, 0.0])], "qid long, embedding array<double>")
    got = coll.query(spark, root, "c", q, 2)
    assert got.columns == ["qid", "rank", "id", "distance", "document", "metadata"] and seen == [()]
    assert sorted((r.qid, r["rank"], r.id, r.document, r.metadata["link"]) for r in got.collect()) == [
        (1, 1, "2", "text 2", "x"), (1, 2, "1", "text 1", "x"), (2, 1, "5", "text 5", "x"), (2, 2, "4", "text 4", "x")]
    assert coll.query(spark, root, "c", q, 1, carry=()).columns == ["qid", "rank", "id", "distance"]


@pytest.mark.parametrize("below", ["html", "pages"])
def test_page_files_are_bounded_and_handed_on_one_by_one(spark, tmp_path, monkeypatch, below):
    """A file is held whole by its task, so its pages are bounded, and so is what a worker is handed."""
    from sifter.plans import sources
    root, key = str(tmp_path / "sf"), "spark.sql.execution.arrow.maxBytesPerBatch"
    pages = spark.range(1500).selectExpr("id page_id", "concat('http://h/', id) url", "concat('<p>a', id, '</p>\n') html")
    pages.coalesce(1).write.parquet(f"{root}/pages.parquet")
    spark.createDataFrame([(1, 0, "user", "hello")], "conv_id long, turn int, role string, text string").write.parquet(f"{root}/conversations.parquet")
    monkeypatch.setattr(sources, "scratch_path", lambda *a: str(tmp_path / "files"))
    before = spark.conf.get(key)
    spark.conf.set(key, "64m")
    try:
        query = sources.q_scan_by_kind if below == "html" else sources.q_load_documents
        got = query(spark, root).collect()
        assert spark.conf.get(key) == f"{4 << 20}b"
    finally:
        spark.conf.set(key, before)
    assert sorted(r.page_id for r in got if r.page_id is not None) == list(range(1500))
    lines = [len(f.read_text().splitlines()) for f in (tmp_path / "files" / below).glob("*.txt")]
    assert sum(lines) == 1500 and max(lines) <= sources.FILE_PAGES
