"""Session helpers: building a local session for tests/bench, locating the
shared checkpoint folder, and guarding parallelism before Python-heavy stages.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "sifter", **conf) -> SparkSession:
    """Session for tests and the bench. On a cluster, pass the session you
    already have to the operators instead of calling this."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**_LOCAL_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only a local session (tests) with
    nothing configured gets a private folder; elsewhere executors could not
    see one, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="sifter-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder for tables an
    operator writes to cut lineage or to round-trip through a file format."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/sifter-{name}-{uuid.uuid4().hex[:12]}"


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a file scan over at least ``min_partitions`` tasks before a
    Python-heavy stage. For scans only: on a frame with a shuffle, asking for
    the partition count would run the stages below it.

    Large inputs already arrive in many file splits, so this is a no-op at
    cluster scale; it only fires for small inputs that land in one split
    (a single-row-group parquet file), where one task would do all the work.
    """
    if df.isStreaming:  # micro-batches are planned per trigger
        return df
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


#: Rows and bytes that a Python worker is handed at once, at most (one row may be larger).
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limits on Arrow batches, if they are above ours.

    Spark's own are 10,000 rows and 64 MB of Arrow buffers, and Python
    objects take many times the bytes of what they are made of (each token of a
    text is one), so that a worker would grow with the length of the texts."""
    for name, most, text in (("maxRecordsPerBatch", BATCH_ROWS, str(BATCH_ROWS)), ("maxBytesPerBatch", BATCH_BYTES, f"{BATCH_BYTES}b")):
        key = f"spark.sql.execution.arrow.{name}"
        m = re.fullmatch(r"(-?\d+)([kmgt]?)i?b?", spark.conf.get(key).strip().lower())
        now = int(m[1]) << 10 * " kmgt".index(m[2] or " ") if m else 0
        if not 0 < now <= most:
            spark.conf.set(key, text)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sifter`` importable on every executor's Python workers (once
    per SparkContext): the package is zipped on the driver and added with
    ``addPyFile``, which distributes it through Spark itself. What a worker is
    handed at once is bounded (once per session)."""
    bound_batches(spark)
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(tempfile.mkdtemp(prefix="sifter-pyfiles-"), "sifter.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
