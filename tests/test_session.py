from pyspark.sql import functions as F

from sifter.session import checkpoint_dir, ensure_parallelism, scratch_path, ship_package


def test_parallelism_guard(spark):
    small = spark.range(10).coalesce(1)
    assert ensure_parallelism(small, 4).rdd.getNumPartitions() == 4
    wide = spark.range(100).repartition(6)
    assert ensure_parallelism(wide, 4) is wide  # already split: untouched
    stream = spark.readStream.format("rate").load()
    assert ensure_parallelism(stream, 4) is stream  # streams are planned per trigger


def test_scratch_paths_live_in_the_shared_checkpoint_folder(spark):
    base = checkpoint_dir(spark).rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base + "/") and b.startswith(base + "/") and a != b
    ship_package(spark)
    ship_package(spark)  # once per context


def test_a_worker_is_handed_bounded_batches(spark):
    import pyarrow as pa

    from sifter.session import BATCH_BYTES, BATCH_ROWS, ship_package
    s = spark.newSession()
    ship_package(s)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b["text"].get_total_buffer_size()]})

    def largest(df):
        return df.mapInArrow(sizes, "n long, size long").agg(F.max("n"), F.max("size"), F.sum("n")).first()

    n, _, rows = largest(s.range(0, 7 * BATCH_ROWS, 1, 1).select(F.lit("x").alias("text")))
    assert rows == 7 * BATCH_ROWS and n <= BATCH_ROWS
    long = BATCH_BYTES // 100
    _, size, rows = largest(s.range(0, 500, 1, 1).select(F.repeat(F.lit("y"), long).alias("text")))
    assert rows == 500 and size <= BATCH_BYTES * 2


def test_lower_limits_on_batches_stay(spark):
    from sifter.session import bound_batches
    s = spark.newSession()
    for name, low, high in (("maxRecordsPerBatch", "10", "50000"), ("maxBytesPerBatch", "64k", "1g")):
        key = f"spark.sql.execution.arrow.{name}"
        s.conf.set(key, low)
        bound_batches(s)
        assert s.conf.get(key) in (low, "65536b")
        s.conf.set(key, high)
        bound_batches(s)
        assert s.conf.get(key) not in (high, "1073741824b")
