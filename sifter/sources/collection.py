"""Vector collections as Parquet tables in a shared folder, for many writers.

``{root}/{name}/meta`` holds one row (name, metric, encoder). An ``add`` writes
a folder of its own below ``data``, rows (id, document, metadata, link,
embedding) partitioned by ``_bucket``, and publishes a new version of the list
of folders (``sources.versions``): readers see all of it or nothing. ``link``
repeats the metadata's entry of that name as a column, so that a filter on it
reaches the Parquet scan.

``add`` is insert-if-absent on ``id``: fresh ids are found first, on the ids
alone, and only their rows are shuffled and written. Re-adding the same chunks
is a no-op, and a replayed batch adds nothing twice. Of two writers at once the
one that publishes later looks at the folders that were added meanwhile, takes
ids that they hold out of its own, and tries again; so each id is there once.

A folder has a bucket for about ROWS_PER_BUCKET rows of its own, a power of two
(a row's bucket is a hash of its id modulo that number), so tasks and files of
an ``add`` grow with what it adds. ``compact`` writes all folders as one.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.session import checkpoint_dir
from sifter.sources.versions import Versions

ROW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("document", T.StringType(), True),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("embedding", T.ArrayType(T.FloatType()), True),
])
STORED_SCHEMA = T.StructType([*ROW_SCHEMA.fields, T.StructField("link", T.StringType(), True), T.StructField("_bucket", T.IntegerType(), True)])
META_SCHEMA = "name string, metric string, encoder string"
#: Rows of a bucket, about.
ROWS_PER_BUCKET = 100_000


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def buckets_of(n: int) -> int:
    """Buckets of a folder of ``n`` rows."""
    return 1 << max(0, (-(-n // ROWS_PER_BUCKET) - 1).bit_length())


def _paths(root: str, name: str) -> tuple[str, str]:
    base = f"{root.rstrip('/')}/{name}"
    return f"{base}/data", f"{base}/meta"


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``; None if there is none. Other errors are raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def open_collection(spark: SparkSession, root: str, name: str) -> dict | None:
    """Metadata of an existing collection, or None."""
    found = _read(spark, _paths(root, name)[1], META_SCHEMA)
    row = None if found is None else found.first()
    return None if row is None else row.asDict()


def get_or_create(spark: SparkSession, root: str, name: str, metric: str = "cosine",
                  encoder: str = "hash64") -> dict:
    found = open_collection(spark, root, name)
    if found is not None:
        return found
    _, meta = _paths(root, name)
    spark.createDataFrame([(name, metric, encoder)], META_SCHEMA).coalesce(1).write.mode("ignore").parquet(meta)
    return open_collection(spark, root, name)


def _folders(spark: SparkSession, root: str, name: str, folders: list[dict]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], STORED_SCHEMA)
    data = _paths(root, name)[0]
    return spark.read.schema(STORED_SCHEMA).option("basePath", data).parquet(*[f"{data}/{f['folder']}" for f in folders])


def _versions(spark: SparkSession, root: str, name: str) -> Versions:
    return Versions(spark, f"{root.rstrip('/')}/{name}")


def rows(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The stored rows, of the latest version or an earlier one."""
    v = _versions(spark, root, name)
    folders = v.latest()[1] if version is None else v.read(version) if version else []
    return _folders(spark, root, name, folders).drop("_bucket")


def _written(spark: SparkSession, root: str, name: str, taken: DataFrame, n: int) -> dict:
    """A data folder with the rows of ``taken``."""
    buckets = buckets_of(n)
    folder = f"add={uuid.uuid4().hex}"
    out = taken.withColumn("_bucket", _bucket(buckets)).select([f.name for f in STORED_SCHEMA.fields])
    out.repartition(buckets, "_bucket").write.partitionBy("_bucket").parquet(f"{_paths(root, name)[0]}/{folder}")
    return {"folder": folder, "buckets": buckets, "rows": n}


def add(spark: SparkSession, root: str, name: str, new_rows: DataFrame) -> int:
    """Inserts rows whose id is not stored yet and returns how many these were.
    Of incoming rows that share an id the least (document, then metadata's
    link; null last) is taken whole."""
    checkpoint_dir(spark)
    versions = _versions(spark, root, name)
    number, folders = versions.latest()
    incoming = new_rows.select(*[F.col(f.name).cast(f.dataType) for f in ROW_SCHEMA.fields])
    incoming = incoming.withColumn("link", F.try_element_at("metadata", F.lit("link")))
    fresh = incoming.select("id").distinct().join(_folders(spark, root, name, folders).select("id"), "id", "left_anti").checkpoint()
    n = fresh.count()
    if not n:
        return 0
    chosen = Window.partitionBy("id").orderBy(F.asc_nulls_last("document"), F.asc_nulls_last("link"))
    taken = incoming.join(fresh, "id", "left_semi").withColumn("_n", F.row_number().over(chosen)).where("_n = 1")
    mine = _written(spark, root, name, taken, n)
    while not versions.publish(number + 1, [*folders, mine]):
        number, now = versions.latest()
        known = {f["folder"] for f in folders}
        others = _folders(spark, root, name, [f for f in now if f["folder"] not in known]).select("id")
        folders, own = now, _folders(spark, root, name, [mine])
        left = own.select("id").join(others, "id", "left_anti").checkpoint()
        n = left.count()
        if n < mine["rows"]:
            first = mine
            mine = _written(spark, root, name, own.join(left, "id", "left_semi"), n) if n else None
            versions.drop(f"{_paths(root, name)[0]}/{first['folder']}")
            if mine is None:
                return 0
    return n


def compact(spark: SparkSession, root: str, name: str) -> bool:
    """All rows in one folder; False if another writer published meanwhile.
    Folders of earlier versions stay for those who read them."""
    versions = _versions(spark, root, name)
    number, folders = versions.latest()
    if len(folders) < 2:
        return True
    one = _written(spark, root, name, _folders(spark, root, name, folders), sum(f["rows"] for f in folders))
    if versions.publish(number + 1, [one]):
        return True
    versions.drop(f"{_paths(root, name)[0]}/{one['folder']}")
    return False


def query(spark: SparkSession, root: str, name: str, questions: DataFrame, k: int,
          where=None, q_id: str = "qid", carry=("document", "metadata")) -> DataFrame:
    """kNN over the stored rows with the collection's metric; ``where`` is
    a Column predicate applied to the rows before any distance. Ids and vectors
    alone are searched; an id is stored once, so what is carried is joined to
    the rows found."""
    from sifter.operators.knn import knn
    meta = open_collection(spark, root, name)
    if meta is None:
        raise KeyError(f"collection {name!r} does not exist under {root}")
    r = rows(spark, root, name)
    if where is not None:
        r = r.where(where)
    found = knn(questions, r, k, q_id=q_id, c_id="id", metric=meta["metric"])
    carry = [c for c in carry if c != "id"]
    if not carry:
        return found
    return found.join(r.select("id", *carry), "id").select(*found.columns, *carry)
