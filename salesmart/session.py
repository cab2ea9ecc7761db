"""Spark session settings, and the shared folder for staged tables."""

from __future__ import annotations

import atexit
import hashlib
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Only settings that fit any cluster size; the partition count, memory and the folder come from
# the cluster. Joins are left to Catalyst, whose broadcast threshold checks sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even when that costs one more shuffle for the aggregate above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "salesmart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Where it is unset, only a local session may fall back to a fresh folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="salesmart-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/salesmart/{name}-{uuid.uuid4().hex[:12]}"
    atexit.register(_drop_path, spark, path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system Spark can reach; nothing happens if it is not there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def _drop_path(spark: SparkSession, path: str) -> None:
    try:
        remove_path(spark, path)
    except Exception:  # the session has ended already; the folder is the cluster's to expire
        pass


def in_parallel(work: Callable, items: Iterable) -> list:
    """Run independent Spark jobs side by side and return their results in order."""
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        return list(pool.map(work, items))


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[str, tuple[int, str]] = {}  # by application: how many are in it, what was set before
_freeing_lock = threading.Lock()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """In it, shuffle files go as the write or collection that made them ends, not when the driver
    happens to collect its garbage. It nests, also over threads."""
    app = spark.sparkContext.applicationId
    with _freeing_lock:
        depth, before = _freeing.get(app) or (0, spark.conf.get(_FREE_SHUFFLES))
        _freeing[app] = (depth + 1, before)
        spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            depth, before = _freeing.pop(app)
            if depth > 1:
                _freeing[app] = (depth - 1, before)
            else:
                spark.conf.set(_FREE_SHUFFLES, before)


#: The codec of what the warehouse stores: a third smaller than Spark's default on ledger rows.
CODEC = "zstd"


def stage(
    df: DataFrame, path: str, mode: str = "overwrite", codec: str | None = None
) -> DataFrame:
    """Write `df` once and read it back: cuts the lineage and survives lost executors."""
    df.write.mode(mode).parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """As `stage`, with the number of rows, which the write itself observes."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, codec=CODEC)
    return staged, seen.get["rows"]


def bucketed(spark: SparkSession, path: str, schema: StructType, by: str, buckets: int) -> DataFrame:
    """Files that `stage_bucketed` wrote, as a table whose rows of one key lie in one bucket:
    joins and sums by that column need no exchange. The table has a name in this session only."""
    name = "salesmart_" + hashlib.md5(path.encode()).hexdigest()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{by}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def stage_bucketed(
    df: DataFrame, path: str, by: str, buckets: int, dealt: bool = False, codec: str | None = None
) -> DataFrame:
    """Write `df` in buckets of the column `by`, sorted in each, one file per bucket. Rows of one
    key that lie in one task already are `dealt`."""
    name = "salesmart_" + hashlib.md5(path.encode()).hexdigest()
    if not dealt:
        df = df.repartition(buckets, by)  # the way that the buckets are dealt
    writer = df.write.format("parquet").mode("overwrite").option("path", path)
    if codec:
        writer = writer.option("compression", codec)
    writer.bucketBy(buckets, by).sortBy(by).saveAsTable(name)
    return df.sparkSession.table(name)


# --- folders ------------------------------------------------------------------------------


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder on any file system Spark can reach; none if it is not there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(hadoop_path):
        return []
    return [x.getPath().getName() for x in system.listStatus(hadoop_path)]


def rename_path(spark: SparkSession, old: str, new: str) -> bool:
    """Rename a folder, unless there is one of the new name."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    system = paths(old).getFileSystem(spark._jsc.hadoopConfiguration())
    return not system.exists(paths(new)) and system.rename(paths(old), paths(new))
