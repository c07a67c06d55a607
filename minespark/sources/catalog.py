"""Tables and files that exist: search, columns, row counts, stability, housekeeping."""

from __future__ import annotations

import re
import statistics
import time
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minespark.runtime import session


def tables(spark: SparkSession, pattern: str, *, like: bool = False, database: str = "default") -> list[str]:
    """Qualified names of the tables called `pattern`, or matching it with % and _ if `like`."""
    rx = re.compile("".join(".*" if c == "%" else "." if c == "_" and like else re.escape(c) for c in pattern.lower()) if like else re.escape(pattern.lower()))
    return sorted(f"{database}.{t.name}" for t in spark.catalog.listTables(database) if rx.fullmatch(t.name.lower()))


def table_fields(spark: SparkSession, table: str) -> dict[str, str]:
    """Lower-case columns and types, without the partition columns."""
    return {c.name.lower(): c.dataType for c in spark.catalog.listColumns(table) if not c.isPartition}


def period_counts(df: DataFrame, period: str, start: str | None = None, end: str | None = None, *, day: str | None = None) -> DataFrame:
    """(period, n) for periods within [start, end], in order. With a `day` column beside the month's: (period, day, n), start and end as yyyymmdd."""
    by = [period] if day is None else [period, day]
    at = F.col(period) if day is None else F.concat(F.col(period).cast("string"), F.lpad(F.col(day).cast("string"), 2, "0"))
    rows = df.where(at >= start) if start is not None else df
    rows = rows.where(at <= end) if end is not None else rows
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).orderBy(*by)


def family_shape(spark: SparkSession, names: Sequence[str], limit: float = 0.1) -> dict:
    """Rows and columns of each table; whether row counts vary (std/mean above the limit) or columns differ."""
    shape = {n: (spark.table(n).count(), tuple(spark.table(n).columns)) for n in names}
    counts = [c for c, _ in shape.values()]
    mean = statistics.fmean(counts) if counts else 0
    spread = statistics.stdev(counts) / mean if len(counts) > 1 and mean else 0.0
    return {"tables": shape, "spread": spread, "uneven": spread > limit, "columns_differ": len({frozenset(c) for _, c in shape.values()}) > 1}


def intermediate_tables(spark: SparkSession, prefix: str, period: str, *, mode: str = "older", database: str = "default") -> list[str]:
    """Tables named prefix..._yyyymm whose period is older than, equal to or any relative to `period` (older, equal, all)."""
    if mode not in ("older", "equal", "all"):
        raise ValueError(f"mode {mode}")
    out = []
    for name in tables(spark, f"{prefix}%", like=True, database=database):
        m = re.search(r"_(\d{6})$", name)
        if m and (mode == "all" or (m[1] < period if mode == "older" else m[1] == period)):
            out.append(name)
    return out


def drop_tables(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """Drop the named tables where they exist; gives their names."""
    out = []
    for n in names:
        if spark.catalog.tableExists(n):
            spark.sql(f"DROP TABLE IF EXISTS {'.'.join('`' + x + '`' for x in n.split('.'))}")
            out.append(n)
    return out


def partitions(spark: SparkSession, table: str) -> list[str]:
    """The partitions of a table, as column=value/..."""
    return sorted(r[0] for r in spark.sql(f"show partitions {table}").collect())  # metadata


def create_partitioned(spark: SparkSession, table: str, columns: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """An empty table with list partitions by one or several of its columns (given as SQL column definitions), where there is none of that name."""
    spark.sql(f"create table if not exists {table} ({columns}) using {fmt} partitioned by ({', '.join(partition_by)})")


def _files(root: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time in ms) of all files below a folder, in whatever file system its URI names."""
    spark = SparkSession.getActiveSession() or session()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(root))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out, it = [], fs.listFiles(path, True)
    while it.hasNext():
        f = it.next()
        out.append((f.getPath().toString().removeprefix("file:"), f.getLen(), f.getModificationTime()))
    return sorted(out)


def file_sizes(root: str) -> list[tuple[str, int]]:
    """All files below a folder with their bytes, by path: local, HDFS or any store that Hadoop knows."""
    return [f[:2] for f in _files(root)]


def select_files(root: str, pattern: str, *, older_than_days: float | None = None, newest_of_folder: bool = False) -> list[str]:
    """Files whose name matches the regular expression; only those of folders whose newest file is some days old, or each folder's newest."""
    rx = re.compile(pattern)
    files = [(*f[0].rpartition("/")[::2], f[2]) for f in _files(root)]
    newest = {}
    for folder, _, t in files:
        newest[folder] = max(t, newest.get(folder, 0))
    found = [f for f in files if rx.search(f[1])]
    if older_than_days is not None:
        found = [f for f in found if time.time() - newest[f[0]] / 1000 > older_than_days * 86400]
    if newest_of_folder:
        best: dict[str, tuple] = {}
        for f in found:
            if f[0] not in best or f[2] > best[f[0]][2]:
                best[f[0]] = f
        found = list(best.values())
    return sorted(f"{folder}/{name}" for folder, name, _ in found)


def delete_files(paths: Iterable[str], *, really: bool = False) -> list[str]:
    """Delete the files, only if `really`; gives those that exist."""
    context = (SparkSession.getActiveSession() or session()).sparkContext
    there = []
    for p in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(str(p))
        fs = path.getFileSystem(context._jsc.hadoopConfiguration())
        if fs.exists(path) and fs.getFileStatus(path).isFile():
            there.append(p)
            if really:
                fs.delete(path, False)
    return there
