"""Evaluation tables of scores: thresholds by population share and by grade, lift, and the choice of a model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Population shares and score grades of an evaluation table (fixed values).
SHARES = (0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
GRADES = (90, 80, 70, 60, 50, 40, 30, 20, 10, 0)
#: Weights of the first bands' precision in a model's indicator (fixed values).
WEIGHTS = (0.4, 0.3, 0.2, 0.1)


def score_thresholds(df: DataFrame, score: str, shares: Sequence[float] = SHARES) -> list[float]:
    """Scores at the quantiles 1 - share (linear), exact."""
    from minespark.operators.ranking import exact_quantiles

    wanted = {s: round(1 - s, 12) for s in shares}
    q = exact_quantiles(df, score, list(wanted.values()))
    return [q[wanted[s]] for s in shares]


def evaluation(df: DataFrame, *, score: str, label: str, positive: str, negative: str, thresholds: Sequence[float], null_label: str = "del", by: Sequence[str] = ()) -> DataFrame:
    """(by, band, threshold, counts, shares, precision, recall, lift): one row per threshold, in falling order of threshold.

    A row counts the scores at or above its threshold (cum_*) and those between it and the threshold before. precision is
    positives / all, null where a band is empty; lift is against the last cumulative precision, to one digit; recall and share against the
    last cumulative counts. Null labels are left out, or count by `null_label` as positive or negative; other labels are negative.

    Each row finds its band once; the bands' counts, a few rows, give all else.
    """
    y = F.col(label).cast("string")
    pos = (y == positive) if null_label != "positive" else (F.coalesce(y, F.lit(positive)) == positive)
    rows = df.where(F.col(score).isNotNull())
    rows = rows.where(y.isNotNull()) if null_label == "del" else rows
    bandno = None
    for i, t in enumerate(thresholds):
        test = F.col(score) >= t
        bandno = F.when(test, i) if bandno is None else bandno.when(test, i)
    counts = rows.select(*by, bandno.alias("band"), F.coalesce(pos, F.lit(False)).alias("_p")).where("band is not null").groupBy(*by, "band").agg(F.count_if("_p").alias("n_pos"), F.count_if(~F.col("_p")).alias("n_neg"))
    spark = df.sparkSession
    grid = F.broadcast(spark.createDataFrame([(i, float(t)) for i, t in enumerate(thresholds)], "band int, threshold double"))
    frame = counts.select(*by).distinct().join(grid) if by else grid
    full = frame.join(counts, [*by, "band"], "left").fillna(0, ["n_pos", "n_neg"])
    w = Window.partitionBy(*by).orderBy("band")
    whole = Window.partitionBy(*by)
    cum = full.withColumn("cum_pos", F.sum("n_pos").over(w)).withColumn("cum_neg", F.sum("n_neg").over(w)).withColumn("_p", F.sum("n_pos").over(whole)).withColumn("_n", F.sum("n_neg").over(whole))
    ratio = lambda a, b: F.try_divide(a.cast("double"), b.cast("double"))
    c = F.col
    base = ratio(c("_p"), c("_p") + c("_n"))
    own, upto = ratio(c("n_pos"), c("n_pos") + c("n_neg")), ratio(c("cum_pos"), c("cum_pos") + c("cum_neg"))
    return cum.select(
        *by, "band", "threshold", "n_pos", "n_neg", "cum_pos", "cum_neg",
        ratio(c("n_pos") + c("n_neg"), c("_p") + c("_n")).alias("share"), ratio(c("cum_pos") + c("cum_neg"), c("_p") + c("_n")).alias("cum_share"),
        own.alias("precision"), upto.alias("cum_precision"), ratio(c("n_pos"), c("_p")).alias("recall"), ratio(c("cum_pos"), c("_p")).alias("cum_recall"),
        F.round(F.try_divide(own, base), 1).alias("lift"), F.round(F.try_divide(upto, base), 1).alias("cum_lift"),
    )


def with_f1(table: DataFrame) -> DataFrame:
    p, r = F.col("cum_precision"), F.col("cum_recall")
    return table.withColumn("f1", F.try_divide(2 * p * r, p + r))


def indicator(table: Sequence) -> float:
    """Weighted precision (percent) of the first four bands."""
    return sum(w * 100 * (r.precision or 0.0) for w, r in zip(WEIGHTS, table))


def weaknesses(table: Sequence, bands: int = 8) -> list[str]:
    """Why an evaluation table (by population shares) marks a weak model; empty if it doesn't."""
    rows = list(table)[:bands]
    found = []
    if len({r.threshold for r in rows}) == 1:
        found.append("one score")
    precise = [r.precision for r in rows if r.precision is not None]
    last = table[-1].cum_precision if len(table) else None
    if precise and precise[0] == 1.0 and all(p in (0.0, 1.0) for p in precise):
        found.append("separable")
    inner = [p for p in precise if p != 1.0 and p != last]
    if any(b > a for a, b in zip(inner, inner[1:])):
        found.append("precision rises")
    if len(inner) > 1 and len(set(inner)) < len(inner):
        found.append("equal precisions")
    shares = [r.cum_share for r in rows]
    if len(set(shares)) < len(shares):
        found.append("repeated share")
    return found


def choose(tables: dict[str, Sequence]) -> tuple[str | None, dict[str, dict]]:
    """(best, verdicts): of the models without weaknesses the one of greatest (indicator, first precision); None if all are weak."""
    verdicts = {n: {"indicator": indicator(t), "first": (t[0].precision or 0.0) if len(t) else 0.0, "weak": weaknesses(t)} for n, t in tables.items()}
    good = [n for n, v in verdicts.items() if not v["weak"]]
    return (max(good, key=lambda n: (verdicts[n]["indicator"], verdicts[n]["first"])) if good else None), verdicts
