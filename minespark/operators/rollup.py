"""Roll-ups: members to groups, statistics of a plan joined back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minespark.operators.ranking import quantiles

#: Suffixes of rolled-up columns by method (fixed values).
SUFFIX = {"main": "_teamzk", "max": "_teammax", "sum": "_teamadd", "max_main": "_teammax"}


@dataclass(frozen=True)
class RollRule:
    """How a member column becomes a group column: main (the main member's value), max, sum, or max_main (as main, by the max suffix)."""

    column: str
    method: str
    db_type: str = "string"
    name: str | None = None

    @property
    def output(self) -> str:
        base = self.column.lower().replace("5g_flux", "flux_5g")
        return self.name or base + SUFFIX[self.method]


def roll_up(df: DataFrame, *, period: str, group: str, is_main: Column, rules: Sequence[RollRule]) -> DataFrame:
    """One row per period and group. Sums take nulls as 0, maxima ignore them; without a main member its values are null.

    One aggregation with map-side combine, whatever the number of rules.
    """
    def value(r: RollRule) -> Column:
        c = F.col(r.column)
        if r.method == "sum":
            return F.sum(F.coalesce(c, F.lit(0)))
        if r.method == "max":
            return F.max(c)
        if r.method in ("main", "max_main"):
            return F.max(F.when(is_main, c))
        raise ValueError(f"no method {r.method}")

    return df.groupBy(period, group).agg(*(value(r).alias(r.output) for r in rules))


def plan_statistics(df: DataFrame, *, plan: str, columns: Sequence[str], above: Sequence[int] = (0, 1, 2), shares: Sequence[float] = (0.25, 0.5)) -> DataFrame:
    """Per plan: rows, and per column counts above each limit, exact percentiles (linear) and the maximum."""
    aggs = [F.count(F.lit(1)).alias("cnt_spec")]
    for c in columns:
        aggs += [F.count_if(F.col(c) > x).alias(f"spec_count{x}_{c}") for x in above]
        aggs.append(F.max(c).alias(f"spec_max_{c}"))
    q = quantiles(df, columns, shares, by=[plan])
    one = lambda c, s: F.max(F.when((F.col("col") == c) & (F.col("share") == float(s)), F.col("value"))).alias(f"spec_pre{str(s).replace('.', '')}_{c}")
    wide = q.groupBy(F.col(plan).alias("_plan")).agg(*(one(c, s) for c in columns for s in shares))
    return df.groupBy(plan).agg(*aggs).join(wide, F.col(plan).eqNullSafe(F.col("_plan")), "left").drop("_plan")


def with_plan_statistics(df: DataFrame, *, plan: str, columns: Sequence[str], **how) -> DataFrame:
    """Each member beside its plan's statistics (left join, so members without a plan stay)."""
    return df.join(plan_statistics(df.where(F.col(plan).isNotNull()), plan=plan, columns=columns, **how), plan, "left")


def period_rates(df: DataFrame, *, period: str, positive: Column, limit: float | None = None) -> DataFrame:
    """(period, n, n_pos, wave[, alarm]): counts by period, and the positives' change against the period before.

    wave is (max - min) / min of both counts, null for the first and after a zero; alarm is wave >= limit.
    """
    counts = df.groupBy(period).agg(F.count(F.lit(1)).alias("n"), F.count_if(positive).alias("n_pos"))
    before = F.lag("n_pos").over(Window.orderBy(period))  # one row per period
    low, high = F.least(F.col("n_pos"), before), F.greatest(F.col("n_pos"), before)
    wave = F.when(before.isNotNull(), F.try_divide((high - low).cast("double"), low.cast("double")))
    out = counts.withColumn("wave", wave)
    return out if limit is None else out.withColumn("alarm", F.coalesce(F.col("wave") >= limit, F.lit(False)))


def label_rates(df: DataFrame, *, period: str, labels: Mapping[str, Column], limit: float | None = None) -> DataFrame:
    """(label, period, n, n_pos, wave[, alarm]): period_rates() of several labels from one scan."""
    counts = df.groupBy(period).agg(F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(f"_{i}") for i, c in enumerate(labels.values())))
    each = F.array(*(F.struct(F.lit(name).alias("label"), F.col(f"_{i}").alias("n_pos")) for i, name in enumerate(labels)))
    long = counts.select(period, "n", F.explode(each).alias("_x")).select("_x.label", period, "n", "_x.n_pos")
    before = F.lag("n_pos").over(Window.partitionBy("label").orderBy(period))  # one row per label and period
    low, high = F.least(F.col("n_pos"), before), F.greatest(F.col("n_pos"), before)
    out = long.withColumn("wave", F.when(before.isNotNull(), F.try_divide((high - low).cast("double"), low.cast("double"))))
    return out if limit is None else out.withColumn("alarm", F.coalesce(F.col("wave") >= limit, F.lit(False)))


def case_counts(df: DataFrame, positive: Column) -> tuple[int, int, float]:
    """(rows, positives, rate to three digits); no rows or one class is an error."""
    n, p = df.agg(F.count(F.lit(1)), F.count_if(positive)).first()
    if not n or p in (0, n):
        raise ValueError(f"{p} positives of {n} rows")
    return n, p, round(p / n, 3)


def rate_moved(before: float, after: float, limit: float = 0.05) -> bool:
    """Whether a rate changed by more than the limit, relative to before."""
    return before != after if before == 0 else abs(after - before) / before > limit
