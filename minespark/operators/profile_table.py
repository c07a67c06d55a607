"""Profiles of tables as rows, one scan for all columns, and their comparison over periods."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minespark.operators.ranking import quantiles

#: Names of profile statistics (fixed values).
TOTAL, NULLS, ZEROS, NEGATIVES = "count_全量", "count_空值", "count_零值", "count_负值"
ALL_ROWS = "全量"
#: Dispersion (std / mean) beyond which a statistic differs greatly between periods (fixed value).
BIG_DISPERSION = 0.1


def profile_rows(
    df: DataFrame, *, period: str, numbers: Sequence[str], others: Sequence[str] = (), shares: Sequence[float] = (0.75,),
    cuts: Mapping[str, Sequence[float]] | None = None, values: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """(period, col_name, col_stat, col_value): counters of every column by period, from one aggregation and one unpivot.

    Quantiles come from one range sort (ranking.quantiles). Per column nulls; per number zeros, negatives and exact quantiles; `cuts`: counts in right-closed buckets; `values`: counts
    of chosen values. Empty periods give no rows.
    """
    stats: list[tuple[str, str, Column]] = [(ALL_ROWS, TOTAL, F.count(F.lit(1)))]
    for c in [*numbers, *others]:
        stats.append((c, NULLS, F.count_if(F.col(c).isNull())))
    for c in numbers:
        stats += [(c, ZEROS, F.count_if(F.col(c) == 0)), (c, NEGATIVES, F.count_if(F.col(c) < 0))]
        stats += [(c, f"分位数_{q:.0%}", F.lit(None)) for q in shares]  # filled in below
    for c, edges in (cuts or {}).items():
        bounds = [None, *edges, None]
        for lo, hi in zip(bounds, bounds[1:]):
            test = (F.lit(True) if lo is None else F.col(c) > lo) & (F.lit(True) if hi is None else F.col(c) <= hi)
            stats.append((c, f"count_({'-inf' if lo is None else lo}, {'inf' if hi is None else hi}]", F.count_if(test & F.col(c).isNotNull())))
    for c, chosen in (values or {}).items():
        stats += [(c, f"count_={v}", F.count_if(F.col(c).cast("string") == v)) for v in chosen]
    wide = df.groupBy(period).agg(*(x.cast("double").alias(f"s{i}") for i, (_, _, x) in enumerate(stats)))
    rows = F.array(*(F.struct(F.lit(c).alias("col_name"), F.lit(s).alias("col_stat"), F.col(f"s{i}").alias("col_value")) for i, (c, s, _) in enumerate(stats)))
    out = wide.select(period, F.explode(rows).alias("_r")).select(period, "_r.*")
    if not numbers or not shares:
        return out
    q = quantiles(df.select(F.col(period).alias("_p"), *numbers), numbers, shares, by=["_p"])
    name = F.concat(F.lit("分位数_"), F.round(F.col("share") * 100).cast("int"), F.lit("%"))
    q = q.select("_p", F.col("col").alias("_c"), name.alias("_s"), "value")
    return out.join(q, F.col(period).eqNullSafe(F.col("_p")) & (F.col("col_name") == F.col("_c")) & (F.col("col_stat") == F.col("_s")), "left").select(period, "col_name", "col_stat", F.coalesce("value", "col_value").alias("col_value"))


def profile_comparison(rows: DataFrame, *, period: str, periods: Sequence[str], big: float = BIG_DISPERSION) -> DataFrame:
    """(col_name, col_stat, v_<period>..., signature, exam_std, exam_mean, exam_sep, exam_result): a profile's periods side by side.

    signature has per period '1' if a count equals the rows, '0' if it is zero, else 'x'; blank for other statistics
    and the total. exam_result: 'all 1', 'all 0', 'different' for a mixed signature with a 1 or 0, 'large difference'
    for std/mean above `big`, else ''.
    """
    wide = rows.groupBy("col_name", "col_stat").pivot(period, list(periods)).agg(F.max("col_value"))
    total = wide.where((F.col("col_stat") == TOTAL) & (F.col("col_name") == ALL_ROWS)).select(*(F.col(p).alias(f"_t{i}") for i, p in enumerate(periods)))
    joined = wide.join(F.broadcast(total), how="left")
    counted = F.col("col_stat").startswith("count_") & (F.col("col_stat") != TOTAL)
    sign = F.concat(*(F.when(F.col(p) == 0, "0").when(F.col(p) == F.col(f"_t{i}"), "1").otherwise("x") for i, p in enumerate(periods)))
    values = F.array(*periods)
    full = F.filter(values, lambda x: x.isNotNull())
    n = F.size(full)
    mean = F.when(n > 0, F.aggregate(full, F.lit(0.0), lambda a, x: a + x) / n)
    with_mean = joined.select("*", F.when(counted, sign).otherwise("").alias("signature"), mean.alias("_mean"), n.alias("_n"), full.alias("_v"))
    squares = F.aggregate("_v", F.lit(0.0), lambda a, x: a + (x - F.col("_mean")) * (x - F.col("_mean")))
    std = F.when(F.col("_n") > 1, F.sqrt(squares / (F.col("_n") - 1)))
    out = with_mean.select("*", std.alias("_std"))
    sep = F.when(F.col("_mean") == 0, 0.0).otherwise(F.col("_std") / F.col("_mean"))
    m = len(periods)
    s = F.col("signature")
    verdict = F.when(s == "1" * m, "all 1").when(s == "0" * m, "all 0").when((s != "") & (s != "x" * m), "different").when(F.col("_sep") > big, "large difference").otherwise("")
    return out.withColumn("_sep", sep).select(
        "col_name", "col_stat", *(F.col(p).alias(f"v_{p}") for p in periods), "signature",
        F.round("_std", 3).alias("exam_std"), F.col("_mean").alias("exam_mean"), F.col("_sep").alias("exam_sep"), verdict.alias("exam_result"),
    )
