"""Ranks, levels and exact quantiles of whole tables without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minespark.runtime import small, written


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """df with a row number 1..N in the given order.

    A range sort; each task numbers its own rows, and the task counts (one row each) give the offsets.
    Ties get different numbers, in an order of their own: give enough order columns.
    """
    t = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "rank")
    pid = F.shiftright("_at", 33)
    counts = t.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offset = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_before"))
    numbered = t.withColumn("_pid", pid).join(small(offset), "_pid")
    return numbered.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).select(*df.columns, name)


def level_of_rank(rank: Column, n: Column, levels: int = 100) -> Column:
    """Quantile level of a rank (1 is best): `levels` for the best, 1 for the worst."""
    reach = F.floor(((n - rank) * levels + (n - 2)) / F.greatest(n - 1, F.lit(1)))
    return F.greatest(F.lit(1), reach).cast("int")


def quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by, col, share, value): exact quantiles with linear interpolation between ranks, of each column and group.

    Nulls and NaN don't count; a column without values in a group gives no row. Null groups are groups.

    Values are counted first and range-sorted by group, column and value, so a group of any size spreads over tasks. The tasks'
    counts say in which task a rank lies; only those stretches are summed.
    """
    df = df.select(*(F.col(f"`{c}`").alias(f"_b{i}") for i, c in enumerate(by)), *(F.col(f"`{c}`").cast("double").alias(f"_c{i}") for i, c in enumerate(columns)))
    names, by = list(by), [f"_b{i}" for i in range(len(by))]  # no name of the caller's can clash
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    values = F.array(*(F.struct(F.lit(c).alias("col"), F.col(f"_c{i}").alias("x")) for i, c in enumerate(columns)))
    long = df.select(*by, key.alias("_g"), F.explode(values).alias("_v")).select(*by, "_g", "_v.col", "_v.x").where("x is not null and not isnan(x)")
    counts = long.groupBy(*by, "_g", "col", "x").agg(F.count(F.lit(1)).alias("n"))
    order = ["_g", "col", "x"]
    t = written(counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()), "quantiles")
    parts = t.groupBy("_g", "col", "pid").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("_g", "col")
    placed = parts.select("_g", "col", "pid", "n", (F.sum("n").over(group.orderBy("pid")) - F.col("n")).alias("before"), F.sum("n").over(group).alias("all"))
    place = F.col("share") * (F.col("all") - 1)
    asked = placed.withColumn("share", F.explode(F.array(*(F.lit(float(x)) for x in shares)))).withColumn("place", F.round(place, 9))
    ranks = F.array(F.struct(F.lit(0).alias("up"), (F.floor("place") + 1).alias("rank")), F.struct(F.lit(1).alias("up"), (F.ceil("place") + 1).alias("rank")))
    asked = asked.withColumn("_r", F.explode(ranks)).select("_g", "col", "pid", "before", "n", "share", "_r.up", "_r.rank", (F.col("place") - F.floor("place")).alias("part")).where("before < rank and rank <= before + n").drop("n")
    asked = written(asked, "quantiles-asked")  # two rows per group, column and share
    stretch = t.join(small(asked.select("_g", "col", "pid").distinct()), ["_g", "col", "pid"], "left_semi")
    upto = stretch.withColumn("upto", F.sum("n").over(Window.partitionBy("_g", "col", "pid").orderBy("x")))
    hit = upto.join(small(asked), ["_g", "col", "pid"]).where("before + upto - n < rank and rank <= before + upto")
    both = hit.groupBy(*by, "_g", "col", "share").agg(F.max("part").alias("part"), F.max(F.when(F.col("up") == 0, F.col("x"))).alias("lo"), F.max(F.when(F.col("up") == 1, F.col("x"))).alias("hi"))
    return both.select(*(F.col(b).alias(c) for b, c in zip(by, names)), "col", "share", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")).alias("value"))


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> dict[float, float | None]:
    """quantiles() of one column as a dictionary; None for an empty column."""
    found = {r.share: r.value for r in quantiles(df.select(F.col(f"`{column}`").alias("v")), ["v"], shares).collect()}  # a row per share
    return {s: found.get(float(s)) for s in shares}
