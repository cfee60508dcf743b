"""The pipeline's stages on awkward documents, and the registered queries' names and columns."""

import re

import corpus_pipeline
import __spark_entry__ as E

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark):
    real = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = real.first()["text"] + " " + " ".join(f"wort{i}" for i in range(100))
    rows = [(None, None, None, None, None), (10_001, "", "en", "src0", 0), (10_002, "123 456", "en", "src0", 7), (10_003, text, None, None, 1),
            (10_004, text.replace(" ", "  "), "en", "src1", 1), (10_005, text + " more", "en", "src1", 1), (10_003, text, None, None, 1), (10_006, "ab " * 50_000, "en", "src2", 1)]
    return real.unionByName(spark.createDataFrame(rows, SCHEMA))


def test_stages_on_awkward_rows(spark, tmp_path):
    d = docs(spark)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, "")
        if name != "packing":
            assert out.columns == d.columns
        out.write.parquet(f"{tmp_path}/{name}")
        d = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = d.select("doc_id").collect()
    ids = {n: {r.doc_id for r in v} for n, v in kept.items()}
    assert not ids["language"] & {None, 10_001, 10_002} and {10_003, 10_006} <= ids["language"]
    assert 10_004 not in ids["exact"] and len(kept["exact"]) == len(ids["exact"])
    assert 10_005 not in ids["near"] and 10_003 in ids["near"] and 10_006 in ids["near"]
    assert ids["packing"] == ids["mixing"] <= ids["near"]


def test_stages_on_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_dealt_queries_are_registered():
    names = list(E.queries())
    assert [sum(1 for n in names if re.match(rf"op{k}_", n)) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert not {n for n in names if n.startswith("op")} & {n for n in E.oracle_sql() if E.oracle_sql()[n] is None}


def test_exact_tells_null_from_zero_and_does_not_depend_on_row_order(spark):
    rows = [(None, "a b"), (0, "a b"), (5, "c  d"), (5, "c d"), (5, "c\td"), (None, "e"), (None, "e")]
    seen = set()
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        d = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in order], SCHEMA).repartition(3)
        got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.exact(spark, d, "").collect()), key=str)
        assert [x[0] for x in got] == [0, 5, None]
        seen.add(str(got))
    assert len(seen) == 1
