"""Statistics for screening: WOE and IV, stability, correlation, drift, and expectations."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

if TYPE_CHECKING:
    from minespark.operators.prep import Fitted

#: Stability beyond which a score or feature has moved (fixed value).
PSI_LIMIT = 0.1


def melt(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep, col, v): one row per row and column, values as text."""
    pairs = F.array(*(F.struct(F.lit(c).alias("col"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns))
    return df.select(*keep, F.explode(pairs).alias("_col_v")).select(*keep, "_col_v.col", "_col_v.v")


def crosstab(df: DataFrame, columns: Sequence[str], label: str, positive: str, negative: str) -> DataFrame:
    """(col, v, n_pos, n_neg) over all columns in one pass; null is a value, other labels don't count."""
    y = F.col("_y")
    long = melt(df.withColumn("_y", F.col(label).cast("string")), columns, ["_y"])
    return long.where(y.isin(positive, negative)).groupBy("col", "v").agg(F.count_if(y == positive).alias("n_pos"), F.count_if(y == negative).alias("n_neg"))


def value_shares(df: DataFrame, column: str, label: str | None = None, positive: str = "1", negative: str = "0") -> DataFrame:
    """(v, n, share[, n_pos, n_neg]): counts of each value, null included."""
    y = F.col(label).cast("string") if label else None
    aggs = [F.count(F.lit(1)).alias("n")] + ([F.count_if(y == positive).alias("n_pos"), F.count_if(y == negative).alias("n_neg")] if label else [])
    counts = df.groupBy(F.col(column).alias("v")).agg(*aggs)
    return counts.join(F.broadcast(counts.agg(F.sum("n").alias("_all")))).withColumn("share", F.col("n") / F.col("_all")).drop("_all")


def value_table(df: DataFrame, columns: Sequence[str], label: str | None = None, positive: str = "1", negative: str = "0") -> DataFrame:
    """(col, v, n, share, percent[, n_pos, n_neg]): counts of all columns' values, null included, in one pass; percent is the share as text."""
    from minespark.functions.texts import percent_text

    y = F.col("_y")
    long = melt(df.withColumn("_y", F.col(label).cast("string") if label else F.lit(None).cast("string")), columns, ["_y"])
    more = [F.count_if(y == positive).alias("n_pos"), F.count_if(y == negative).alias("n_neg")] if label else []
    counts = long.groupBy("col", "v").agg(F.count(F.lit(1)).alias("n"), *more)
    rows = df.agg(F.count(F.lit(1)).alias("_all"))  # every column has a value, null or not, in each row
    share = F.col("n") / F.col("_all")
    return counts.join(F.broadcast(rows)).select("col", "v", "n", share.alias("share"), percent_text(share).alias("percent"), *(["n_pos", "n_neg"] if label else []))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, n, mean, std, lo, q25, q50, q75, hi): of each number column the values that aren't null or NaN; exact quartiles (linear), the sample's deviation."""
    from minespark.operators.ranking import quantiles

    x = lambda c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))
    one = lambda c: F.struct(F.lit(c).alias("col"), F.count(x(c)).alias("n"), F.avg(x(c)).alias("mean"), F.stddev_samp(x(c)).alias("std"), F.min(x(c)).alias("lo"), F.max(x(c)).alias("hi"))
    plain = df.agg(F.array(*(one(c) for c in columns)).alias("_x")).select(F.explode("_x").alias("_x")).select("_x.*")
    q = quantiles(df, columns, [0.25, 0.5, 0.75])
    wide = q.groupBy("col").agg(*(F.max(F.when(F.col("share") == s, F.col("value"))).alias(f"q{int(s * 100)}") for s in (0.25, 0.5, 0.75)))
    return plain.join(wide, "col", "left").select("col", "n", "mean", "std", "lo", "q25", "q50", "q75", "hi")


def woe_iv(counts: DataFrame) -> DataFrame:
    """counts (col, v, n_pos, n_neg) with woe and iv_part of each value. Zero cells count as 1, before the totals are taken."""
    one = counts.select("col", "v", F.greatest("n_pos", F.lit(1)).alias("p"), F.greatest("n_neg", F.lit(1)).alias("n"))
    total = one.groupBy("col").agg(F.sum("p").alias("_p"), F.sum("n").alias("_n"))
    rated = one.join(total, "col").select("col", "v", F.col("p").alias("n_pos"), F.col("n").alias("n_neg"), (F.col("p") / F.col("_p")).alias("_a"), (F.col("n") / F.col("_n")).alias("_b"))
    woe = F.ln(F.col("_a") / F.col("_b"))
    return rated.withColumn("woe", woe).withColumn("iv_part", (F.col("_a") - F.col("_b")) * F.col("woe")).drop("_a", "_b")


def information_values(woe: DataFrame, order: Column | None = None) -> DataFrame:
    """(col, iv, n_values, turns): the value of each column and how often its WOE turns along the values' order."""
    w = Window.partitionBy("col").orderBy(order if order is not None else F.col("v"))
    step = F.col("woe") - F.lag("woe").over(w)
    signs = woe.withColumn("_s", F.signum(step))
    turned = signs.withColumn("_t", (F.col("_s") * F.lag("_s").over(w) < 0).cast("int"))
    return turned.groupBy("col").agg(F.sum("iv_part").alias("iv"), F.count(F.lit(1)).alias("n_values"), F.coalesce(F.sum("_t"), F.lit(0)).alias("turns"))


def psi_parts(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("v",)) -> DataFrame:
    """(keys, n_old, n_new, r_old, r_new, psi_part) of two count tables (keys, n). Zero or missing counts are 1, before the totals."""
    on = list(keys)
    both = old.select(*on, F.col("n").alias("_o")).join(new.select(*on, F.col("n").alias("_n")), on, "full_outer")
    one = both.select(*on, F.greatest(F.coalesce("_o", F.lit(0)), F.lit(1)).alias("n_old"), F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1)).alias("n_new"))
    by = on[:-1]
    total = one.groupBy(*by).agg(F.sum("n_old").alias("_o"), F.sum("n_new").alias("_n"))
    rated = (one.join(total, by) if by else one.join(F.broadcast(total))).withColumn("r_old", F.col("n_old") / F.col("_o")).withColumn("r_new", F.col("n_new") / F.col("_n"))
    return rated.drop("_o", "_n").withColumn("psi_part", (F.col("r_new") - F.col("r_old")) * F.ln(F.col("r_new") / F.col("r_old")))


def psi(old: DataFrame, new: DataFrame) -> float:
    """Stability of two count tables (v, n); no common value is an error."""
    if not old.where("v is not null and n > 0").select("v").join(new.where("n > 0").select("v"), "v", "left_semi").limit(1).count():
        raise ValueError("the distributions have no value in common")
    return psi_parts(old, new).agg(F.sum("psi_part")).first()[0]


def psi_by_class(old: DataFrame, new: DataFrame, columns: Sequence[str], label: str, classes: Sequence[str]) -> DataFrame:
    """(col, psi): the greater of the classes' stabilities, all columns in one pass."""
    def counts(df: DataFrame) -> DataFrame:
        long = melt(df.withColumn("_y", F.col(label).cast("string")), columns, ["_y"]).where(F.col("_y").isin(list(classes)))
        return long.groupBy("col", F.col("_y").alias("y"), F.coalesce("v", F.lit("")).alias("v")).agg(F.count(F.lit(1)).alias("n"))

    parts = psi_parts(counts(old), counts(new), ["col", "y", "v"])
    return parts.groupBy("col", "y").agg(F.sum("psi_part").alias("psi")).groupBy("col").agg(F.max("psi").alias("psi"))


def band_counts(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """(v, n) of right-closed bands between the edges, the lowest edge included; values outside don't count."""
    return df.select(band(F.col(column), edges).alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))


def band(c: Column, edges: Sequence[float]) -> Column:
    """Number of the right-closed band, from 0."""
    out = F.when((c >= edges[0]) & (c <= edges[1]), 0)
    for i in range(1, len(edges) - 1):
        out = out.when((c > edges[i]) & (c <= edges[i + 1]), i)
    return out


def correlations(df: DataFrame, columns: Sequence[str], others: Sequence[str] | None = None) -> DataFrame:
    """(a, b, r): Pearson correlation of each pair of columns, or of each column with each of `others`; one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in (columns[i + 1 :] if others is None else others) if a != b]
    schema = "a string, b string, r double"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    stack = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(F.col(f"`{a}`").cast("double"), F.col(f"`{b}`").cast("double")).alias("r")) for a, b in pairs))
    return df.agg(stack.alias("_x")).select(F.explode("_x").alias("_x")).select("_x.*")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> dict[tuple[str, str], float | None]:
    """Pearson correlation of all pairs, both ways, from one pass that sums a Gram matrix; None where a column is constant."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    if len(columns) < 2:
        return {}
    names = [f"f{i}" for i in range(len(columns))]
    rows = df.select(*(F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(n) for c, n in zip(columns, names)))
    if not rows.limit(1).count():
        return {(a, b): None for a in columns for b in columns}
    m = Correlation.corr(VectorAssembler(inputCols=names, outputCol="v").transform(rows), "v").first()[0].toArray()
    return {(a, b): None if math.isnan(m[i, j]) else float(m[i, j]) for i, a in enumerate(columns) for j, b in enumerate(columns)}


def drop_correlated(pairs: Sequence[tuple[str, str, float]], iv: Mapping[str, float], limit: float) -> list[str]:
    """Columns to drop: by falling |r| down to the limit, of each pair still there the one of lower IV (tie: the second)."""
    gone: list[str] = []
    for a, b, r in sorted((p for p in pairs if p[2] is not None and abs(p[2]) >= limit), key=lambda p: (-abs(p[2]), p[0], p[1])):
        if a not in gone and b not in gone:
            gone.append(a if iv.get(a, 0) < iv.get(b, 0) else b)
    return gone


@dataclass(frozen=True)
class PsiTracker:
    """Value shares of a baseline's columns, numbers in bins, against which later rows are compared. Without a label there is one class."""

    columns: tuple[str, ...]
    bins: Fitted
    counts: DataFrame
    label: str | None
    classes: tuple[str, ...]
    limit: float

    def compare(self, df: DataFrame) -> DataFrame:
        """(col, psi, moved, new_values): the greatest stability over the classes, whether it reaches the limit, and the values that the baseline lacks."""
        now = _tracked(self.bins.apply(df), self.columns, self.label, self.classes)
        new = now.join(self.counts.select("col", "y", "v"), ["col", "y", "v"], "left_anti").groupBy("col").agg(F.count_distinct("v").alias("new_values"))
        found = psi_parts(self.counts, now, ["col", "y", "v"]).groupBy("col", "y").agg(F.sum("psi_part").alias("psi")).groupBy("col").agg(F.max("psi").alias("psi"))
        return found.join(new, "col", "left").select("col", "psi", (F.col("psi") >= self.limit).alias("moved"), F.coalesce("new_values", F.lit(0)).alias("new_values"))


def _tracked(df: DataFrame, columns: Sequence[str], label: str | None, classes: Sequence[str]) -> DataFrame:
    y = F.col(label).cast("string") if label else F.lit("")
    long = melt(df.withColumn("_y", y), columns, ["_y"])
    return (long.where(F.col("_y").isin(list(classes))) if label else long).groupBy("col", F.col("_y").alias("y"), F.coalesce("v", F.lit("")).alias("v")).agg(F.count(F.lit(1)).alias("n"))


def fit_tracker(baseline: DataFrame, numbers: Sequence[str], categories: Sequence[str], *, label: str | None = None, positive: str = "1", negative: str = "0", bins: int = 10, limit: float = PSI_LIMIT) -> PsiTracker:
    """A tracker of these rows: numbers in supervised bins if there is a label, else in `bins` of equal frequency (exact quantiles); null is a value."""
    from minespark.operators.prep import Fitted, fit_mdlp
    from minespark.operators.ranking import quantiles
    from minespark.runtime import written

    if label and numbers:
        step = fit_mdlp(baseline, numbers, label, positive, negative)
    else:
        cuts: dict[str, list[float]] = {c: [] for c in numbers}
        for r in quantiles(baseline, numbers, [i / bins for i in range(1, bins)]).collect() if numbers else []:  # bins - 1 rows per column
            cuts[r.col].append(r.value)
        step = Fitted("bins", (), {c: {"edges": [repr(x) for x in (-math.inf, *sorted(set(q)), math.inf)]} for c, q in cuts.items()})
    columns, classes = (*numbers, *categories), (positive, negative) if label else ("",)
    return PsiTracker(columns, step, written(_tracked(step.apply(baseline), columns, label, classes), "tracker"), label, classes, limit)


def quartile_drift(old: DataFrame, new: DataFrame, column: str, limit: float) -> DataFrame:
    """(v, r_old, r_new, moved): shares of a number within the old rows' quartile bands, the outer edges widened by 0.8 and 1.2."""
    from minespark.operators.ranking import exact_quantiles

    q = list(exact_quantiles(old, column, [0.0, 0.25, 0.5, 0.75, 1.0]).values())
    edges = sorted({q[0] * (0.8 if q[0] > 0 else 1.2), *q[1:4], q[4] * (1.2 if q[4] > 0 else 0.8)})
    shares = []
    for df in (old, new):
        n = band_counts(df, column, edges)
        shares.append(n.join(F.broadcast(n.agg(F.sum("n").alias("_a")))).select("v", (F.col("n") / F.col("_a")).alias("r")))
    both = shares[0].withColumnRenamed("r", "r_old").join(shares[1].withColumnRenamed("r", "r_new"), "v", "full_outer").fillna(0.0, ["r_old", "r_new"])
    return both.withColumn("moved", F.abs(F.col("r_new") - F.col("r_old")) > limit)


def panel_drift(panel: DataFrame, *, period: str, first: str, numbers: Sequence[str] = (), categories: Sequence[str] = (), limit: float = 0.1) -> DataFrame:
    """(col, period, v, r_old, r_new, moved): shares of each period's values beside those of the first period, for all columns at once.

    Numbers are banded by the first period's quartiles, outer edges widened by 0.8 and 1.2 (other values are band -1); categories count
    by value, null as ''. moved: the shares differ by more than the limit. One range sort for the quartiles, one aggregation for all shares.
    """
    from minespark.operators.ranking import quantiles

    edges: dict[str, list[float]] = {}
    for r in quantiles(panel.where(F.col(period) == first), numbers, [0.0, 0.25, 0.5, 0.75, 1.0]).orderBy("share").collect() if numbers else []:  # five rows per column
        edges.setdefault(r.col, []).append(r.value)
    cols = {}
    for c, q in edges.items():
        e = sorted({q[0] * (0.8 if q[0] > 0 else 1.2), *q[1:4], q[4] * (1.2 if q[4] > 0 else 0.8)})
        cols[c] = F.coalesce(band(F.col(c), e) if len(e) > 1 else F.lit(0), F.lit(-1)).cast("string").alias(c)
    cols |= {c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in categories}
    long = melt(panel.select(F.col(period).alias("_p"), *cols.values()), list(cols), ["_p"])
    counts = long.where("_p is not null").groupBy("col", "_p", "v").agg(F.count(F.lit(1)).alias("n"))
    shares = counts.withColumn("r", F.col("n") / F.sum("n").over(Window.partitionBy("col", "_p")))
    # a column's values, each with its share in every period, null where it doesn't occur
    periods = shares.select("col", "_p").distinct()
    spine = shares.select("col", "v").distinct().join(periods, "col")
    old = shares.where(F.col("_p") == first).select("col", "v", F.col("r").alias("r_old"))
    out = spine.join(shares.select("col", "_p", "v", F.col("r").alias("r_new")), ["col", "_p", "v"], "left").join(old, ["col", "v"], "left").fillna(0.0, ["r_old", "r_new"])
    return out.select("col", F.col("_p").alias(period), "v", "r_old", "r_new", (F.abs(F.col("r_new") - F.col("r_old")) > limit).alias("moved"))


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with one value (null is none) or none at all; one pass over all columns."""
    if not columns:
        return []
    text = [F.col(f"`{c}`").cast("string") for c in columns]
    row = df.agg(*(F.coalesce(F.min(x) == F.max(x), F.lit(True)).alias(f"_{i}") for i, x in enumerate(text))).first()
    return [c for c, one in zip(columns, row) if one]


def ks_auc(df: DataFrame, score: str, label: str, positive: str, negative: str) -> DataFrame:
    """(ks, auc) of a score: greatest gap of the cumulative shares, and the rank-sum area with ties by halves.

    Scores are counted first; the running sums go over distinct scores, range-sorted with per-task offsets.
    """
    from minespark.runtime import small, written

    y = F.col(label).cast("string")
    by = df.where(y.isin(positive, negative) & F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias("s")).agg(F.count_if(y == positive).alias("p"), F.count_if(y == negative).alias("n"))
    t = written(by.repartitionByRange("s").sortWithinPartitions("s").withColumn("pid", F.spark_partition_id()), "ks")
    sums = t.groupBy("pid").agg(F.sum("p").alias("sp"), F.sum("n").alias("sn"))
    w = Window.orderBy("pid")  # one row per task
    offset = sums.select("pid", (F.sum("sp").over(w) - F.col("sp")).alias("bp"), (F.sum("sn").over(w) - F.col("sn")).alias("bn"))
    total = sums.agg(F.sum("sp").alias("tp"), F.sum("sn").alias("tn"))
    run = Window.partitionBy("pid").orderBy("s")
    cum = t.join(small(offset), "pid").select("p", "n", (F.sum("p").over(run) + F.col("bp")).alias("cp"), (F.sum("n").over(run) + F.col("bn")).alias("cn")).join(F.broadcast(total))
    gap = F.abs(F.try_divide(F.col("cp").cast("double"), F.col("tp").cast("double")) - F.try_divide(F.col("cn").cast("double"), F.col("tn").cast("double")))
    area = F.col("p") * (F.col("cn") - F.col("n") + F.col("n") / 2)
    return cum.agg(F.max(gap).alias("ks"), F.try_divide(F.sum(area), (F.max("tp") * F.max("tn")).cast("double")).alias("auc"))


def require(df: DataFrame, checks: Mapping[str, Column]) -> None:
    """Every check must hold for every row (null fails); all are counted in one pass, violations are an error with counts."""
    names = list(checks)
    bad = df.agg(*(F.count_if(~F.coalesce(checks[n], F.lit(False))) for n in names)).first()
    found = {n: b for n, b in zip(names, bad) if b}
    if found:
        raise ValueError(f"violated: {found}")


def finite(columns: Sequence[str]) -> dict[str, Column]:
    """Checks that the columns have no null, NaN or infinity."""
    inf = float("inf")
    return {c: F.col(c).isNotNull() & ~F.col(c).cast("double").isin(float("nan"), inf, -inf) for c in columns}


def only_value(df: DataFrame, column: str):
    """The one value of a column; none or several are an error."""
    found = [r[0] for r in df.select(column).distinct().limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"{column} has {'no' if not found else 'several'} values")
    return found[0]


def entropy(*counts: float) -> float:
    total = sum(counts)
    return -sum(c / total * math.log(c / total) for c in counts if c) if total else 0.0
