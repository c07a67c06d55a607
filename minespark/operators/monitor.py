"""Later performance of scores: joined to the labels that came true, and reported per model, age and group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minespark.functions.periods import month_add, month_list
from minespark.operators.ranking import quantiles
from minespark.runtime import small, written


def followed(scores: DataFrame, labels: DataFrame, models: Mapping[str, tuple[str, int]], *, perform: str, n: int, period: str, entity: str, label_period: str = "fixed") -> DataFrame:
    """Scores of the last n months with the label that came true: plus ymonth, stat_batch, col_flag, flag_value.

    `models` maps a model to (label column, lag in months). Score months end at perform - lag. Labels are those of that
    last month for all batches ('fixed'), or of each score's own month ('own'). Both sides are pruned by period first; the labels are unpivoted, so that
    one scan of each side and one join serve all models. `scores` has no column col_flag.
    """
    spark = scores.sparkSession
    last = {name: month_add(perform, -lag) for name, (_, lag) in models.items()}
    asked = [(name, m, m if label_period == "own" else last[name], flag) for name, (flag, _) in models.items() for m in month_list(last[name], periods=-n)]
    asked = F.broadcast(spark.createDataFrame(asked, "model_name string, _m string, _lm string, col_flag string"))  # models x n rows
    flags = sorted({flag for flag, _ in models.values()})
    months = sorted({m for x in last.values() for m in month_list(x, periods=-n)})
    rows = scores.where(F.col("model_name").isin(list(models)) & F.col(period).isin(months)).join(asked.withColumnRenamed("_m", period), ["model_name", period])
    pairs = F.array(*(F.struct(F.lit(f).alias("f"), F.col(f).cast("int").alias("y")) for f in flags))
    side = labels.where(F.col(period).isin(months)).select(F.col(period).alias("_lm"), entity, F.explode(pairs).alias("_x")).select("_lm", entity, F.col("_x.f").alias("col_flag"), F.col("_x.y").alias("flag_value"))
    batch = F.round(F.months_between(F.to_date(F.lit(perform), "yyyyMM"), F.to_date(F.col(period), "yyyyMM"))).cast("int")
    return rows.join(side, ["_lm", entity, "col_flag"], "left").select(*scores.columns, F.lit(perform).alias("ymonth"), batch.alias("stat_batch"), "col_flag", "flag_value")


def monitor_report(followed_scores: DataFrame, *, positive: str = "1", negative: str = "0", by: Sequence[str] = ("model_name", "stat_batch", "exe_sam"), shares: Sequence[float] = (0.2, 0.4), score: str = "score", label: str = "flag_value", null_label: str = "del") -> DataFrame:
    """(by, share, n, n_pos, rate, cum_pos, cum_precision, cum_recall, cum_lift): the top shares of each group.

    Bands are looked up by their share, not their place. Thresholds are each group's exact quantiles
    (ranking.quantiles); the counts are one aggregation with map-side combine, so no group is gathered in one task.
    """
    rows = followed_scores.where(F.col(score).isNotNull())
    y = F.col(label).cast("string")
    rows = rows.where(y.isNotNull()) if null_label == "del" else rows.withColumn(label, F.coalesce(y, F.lit(positive if null_label == "positive" else negative)))
    key = F.to_json(F.struct(*by)).alias("_g")
    y = F.col(label).cast("string") == positive
    t = quantiles(rows.select(key, score), [score], [round(1 - x, 12) for x in shares], by=["_g"])
    named = F.coalesce(*(F.when(F.col("share") == round(1 - x, 12), F.lit(float(x))) for x in shares))
    t = written(t.select("_g", named.alias("share"), F.col("value").alias("_t")), "monitor-thresholds")  # a row per group and share
    each = rows.select(*by, key, score, y.alias("_y")).join(small(t), "_g")
    reached = F.col(score) >= F.col("_t")
    tables = each.groupBy(*by, "share").agg(F.count(F.lit(1)).alias("n"), F.count_if("_y").alias("n_pos"), F.count_if(reached).alias("cum_n"), F.count_if(reached & F.col("_y")).alias("cum_pos"))
    r = lambda a, b: F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
    return tables.select(*by, "share", "n", "n_pos", r("n_pos", "n").alias("rate"), "cum_n", "cum_pos", r("cum_pos", "cum_n").alias("cum_precision"), r("cum_pos", "n_pos").alias("cum_recall"), F.round(F.try_divide(r("cum_pos", "cum_n"), r("n_pos", "n")), 2).alias("cum_lift"))
