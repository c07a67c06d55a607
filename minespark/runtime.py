"""Session, shared folder and small helpers that every operator uses."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a table may be broadcast; counted before it is.
BROADCAST_ROWS = 200_000
#: Files of different partitions that a task writes side by side.
WRITERS = 16


def session(app: str = "minespark", cpus: int | str = "*", shuffle_partitions: int = 8, shared: str | None = None) -> SparkSession:
    """A session with the settings that the operators expect (UTC, AQE on).

    The master is the one that spark-submit or the configuration names; `cpus` local threads only where none does.
    `shared` is the folder for intermediate tables (spark.checkpoint.dir) where none is configured.
    """
    SparkContext._ensure_initialized()  # from here on SparkConf knows what spark-submit was given
    given = SparkConf()
    builder = SparkSession.builder.appName(app)
    if not given.contains("spark.master"):
        builder = builder.master(f"local[{cpus}]")
    if shared and not given.contains("spark.checkpoint.dir"):
        builder = builder.config("spark.checkpoint.dir", shared)
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. On a cluster it must be set; a local session without it gets a temporary one."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="minespark-")
        spark.conf.set("spark.checkpoint.dir", found)
        _drop_at_exit(spark, found)
    return found


_to_drop: dict[str, SparkSession] = {}


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    if not _to_drop:
        atexit.register(release)
    _to_drop[path] = spark


def release() -> None:
    """Delete the tables that written() made. Results that still read them must be consumed before."""
    for path, spark in list(_to_drop.items()):
        try:
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session has ended; its folder goes with the cluster
            pass
        _to_drop.pop(path, None)


def temporary(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that release() deletes."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _drop_at_exit(spark, path)
    return path


def written(df: DataFrame, label: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """df as a Parquet table in the shared folder, read back.

    Cuts the lineage: what follows survives the loss of any executor, and a plan that is not
    deterministic (range bounds, partition numbers) is fixed from here on.
    """
    spark = df.sparkSession
    path = temporary(spark, label)
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    if partition_by:
        spark.conf.set(writers, WRITERS)  # else the rows are sorted by partition first
    try:
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(writers, before)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `limit` rows; counted, not assumed."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
