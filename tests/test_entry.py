import __spark_entry__ as E


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["item_id", "rank", "chunk_id", "doc_id", "distance"]
    assert len(rows) > 0 and all(1 <= r["rank"] <= 2 for r in rows)


def test_registry_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 70
