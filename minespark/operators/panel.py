"""Panels of entity and period: assembly from tables, recent periods, padding, quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minespark.functions.periods import add_months, day_of_next_month, month_add, month_list
from minespark.functions.predicates import where
from minespark.operators.sampling import hash_key, quota
from minespark.runtime import small, written
from minespark.spec import ModelSpec, TableSpec


def assemble(frames: dict[str, DataFrame], tables: Sequence[TableSpec], *, entity: str, period: str, at: str, label: DataFrame | None = None, columns: Sequence[str] | None = None, seed: int = 0) -> DataFrame:
    """The wide table of one period: main table, left-joined additions, day data, pivoted scores and label, with a random order `rn_key`.

    Every side is filtered to its period before it is joined by entity; day tables by the day that
    `day_of_next_month` names, their columns behind `prefix`. The order key is a hash of the id: no sort is needed.
    The set of frames must be that of the table specifications.
    """
    if set(frames) != {t.name for t in tables}:
        raise ValueError(f"tables differ: {sorted(set(frames) ^ {t.name for t in tables})}")
    main = [t for t in tables if t.role == "main"]
    if len(main) != 1:
        raise ValueError("exactly one main table is needed")
    out = frames[main[0].name].where(F.col(period) == at)
    for t in tables:
        if t.role == "main":
            continue
        df = frames[t.name]
        if t.role == "day":
            side = day_lookup(df, at=at, day_column=t.day_column, day=t.day_of_next_month, entity=entity, prefix=t.prefix or "dayvalue_")
        elif t.pivot:
            side = pivot_scores(df.where(F.col(period) == at), entity=entity, name=t.pivot[0], value=t.pivot[1])
        else:
            side = df.where(F.col(period) == at).drop(period)
        out = out.join(side, list(t.on) or [entity], "left")
    if label is not None:
        out = out.join(label.where(F.col(period) == at).drop(period), entity, "left")
    out = out.withColumn("rn_key", hash_key(F.col(entity), seed))
    return out if columns is None else out.select(*columns, "rn_key")


def day_lookup(df: DataFrame, *, at: str, day_column: str, day: int, entity: str, prefix: str = "dayvalue_") -> DataFrame:
    """The rows of one day of the month after `at`, their columns behind the prefix."""
    rows = df.where(F.col(day_column).cast("string") == day_of_next_month(at, day)).drop(day_column)
    return rows.select(entity, *(F.col(c).alias(prefix + c) for c in rows.columns if c != entity))


def day_ready(df: DataFrame, *, at: str, day_column: str, day: int) -> int:
    """Rows of the needed day; 0 means it is not loaded yet."""
    return df.where(F.col(day_column).cast("string") == day_of_next_month(at, day)).count()


def pivot_scores(df: DataFrame, *, entity: str, name: str, value: str, names: Sequence[str] | None = None) -> DataFrame:
    """Long scores to one column per name (the greatest value). Give `names` to spare the pass that finds them."""
    return df.groupBy(entity).pivot(name, list(names) if names else None).agg(F.max(value))


def recent_periods(panel: DataFrame, chosen: DataFrame, *, entity: str, period: str, at: str, n: int) -> DataFrame:
    """The last n periods up to `at` of the chosen entities. The periods are pruned at the scan."""
    months = month_list(at, periods=-n)
    return panel.where(F.col(period).between(months[0], months[-1])).join(chosen.select(entity).distinct(), entity)


def base_table(panel: DataFrame, spec: ModelSpec, step: str, *, seed: int = 0, narrow: bool = True) -> DataFrame:
    """The panel rows a step works on, with user_acct_month and data_use.

    train: validation rows first (timein_count of the newest month), then positives up to their limit and negatives up to limit x ratio,
    of the training month and `cumulated_months` before it. test: up to timeout_limit rows. predict: all rows. Choice
    is by a hash of id and month, so it is the same in every run and on every cluster. Each user comes with the n_recent
    periods up to each of its base months: one scan of the panel and one join, whatever the number of base months. The candidates (id, month, label)
    are written first, so that the picks of each class read them and not the panel again; with narrow=False nothing runs until the table is read.
    """
    m, e = spec.col_month, spec.col_id
    if step == "predict":
        months, picks = [spec.month_predict], where(panel.where(F.col(m) == spec.month_predict), spec.condition).select(e, F.col(m).alias("user_acct_month"), F.lit("data_predict").alias("data_use"))
    elif step in ("train", "test"):
        months = month_list(month_add(spec.month_train, -spec.cumulated_months), spec.month_train) if step == "train" else [spec.month_test]
        users = where(panel.where(F.col(m).isin(months)), spec.condition).where(F.col(spec.label).cast("string").isin(spec.positive, spec.negative))
        users = users.select(e, F.col(m).alias("user_acct_month"), F.col(spec.label).cast("string").alias("y"))
        users = written(users, "users") if narrow else users
        key = hash_key(F.concat_ws("_", F.col(e).cast("string"), "user_acct_month"), seed)
        if step == "test":
            picks = quota(users, {None: spec.timeout_limit}, key=key).withColumn("data_use", F.lit("data_timeout"))
        else:
            timein = quota(users.where(F.col("user_acct_month") == spec.month_train), {None: spec.timein_count}, key=key)
            rest = users.join(timein.select(e, "user_acct_month"), [e, "user_acct_month"], "left_anti")
            limits = {spec.positive: spec.positive_limit, spec.negative: int(spec.positive_limit * spec.train_ratio)}
            picks = timein.withColumn("data_use", F.lit("data_timein")).unionByName(quota(rest, limits, by="y", key=key).withColumn("data_use", F.lit("data_train")))
        picks = picks.select(e, "user_acct_month", "data_use")
    else:
        raise ValueError(f"no step {step}")
    first = month_list(months[0], periods=-spec.n_recent)[0]
    rows = panel.where(F.col(m).between(first, months[-1])).join(picks, e)
    start = add_months(F.col("user_acct_month"), 1 - spec.n_recent)
    return rows.where((F.col(m).cast("string") >= start) & (F.col(m) <= F.col("user_acct_month")))


def gate(panel: DataFrame, *, entity: str, period: str, n: int, label: str | None = None, at: str | None = None, equate: str = "fill") -> DataFrame:
    """The n-period panel without null periods and without entities whose label is null at `at`; repeated (entity, period) is an error.

    Incomplete entities are dropped (equate='del') or their missing periods filled with nulls ('fill').
    """
    rows = panel.where(F.col(period).isNotNull())
    if label is not None:
        rows = rows.join(rows.where((F.col(period) == at) & F.col(label).isNotNull()).select(entity).distinct(), entity, "left_semi")
    twice = rows.groupBy(entity, period).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    if twice:
        raise ValueError(f"({entity}, {period}) is repeated")
    if equate == "del":
        return complete_only(rows, entity=entity, period=period, n=n)
    if equate != "fill":
        raise ValueError(f"equate {equate}")
    return pad(rows, entity=entity, period=period)


def base_counts(base: DataFrame, spec: ModelSpec) -> DataFrame:
    """(user_acct_month, data_use, period, label, n, n_users) of a base table."""
    label = F.col(spec.label).cast("string") if spec.label in base.columns else F.lit(None).cast("string")
    return base.groupBy("user_acct_month", "data_use", F.col(spec.col_month).alias("period"), label.alias("label")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(spec.col_id).alias("n_users"))


def check_base(counts: DataFrame, n: int) -> list[str]:
    """What is wrong with a base table by its counts: of each user month and data use, other than n periods, or other numbers of users in them."""
    by = counts.groupBy("user_acct_month", "data_use", "period").agg(F.sum("n_users").alias("u")).groupBy("user_acct_month", "data_use").agg(F.count(F.lit(1)).alias("k"), F.min("u").alias("lo"), F.max("u").alias("hi"))
    bad = by.where((F.col("k") != n) | (F.col("lo") != F.col("hi"))).orderBy("user_acct_month", "data_use").collect()  # a row per base month and use
    return [f"{r.user_acct_month} {r.data_use}: {r.k} periods, {r.lo} to {r.hi} users" for r in bad]


def complete_only(panel: DataFrame, *, entity: str, period: str, n: int) -> DataFrame:
    """Rows of entities that have n different periods."""
    full = panel.groupBy(entity).agg(F.count_distinct(period).alias("_n")).where(F.col("_n") == n)
    return panel.join(full.select(entity), entity, "left_semi")


def pad(panel: DataFrame, *, entity: str, period: str, periods: Sequence[str] | None = None) -> DataFrame:
    """A row for every entity and period, missing ones with nulls. The periods are those given or found (a few)."""
    found = panel.select(period).distinct() if periods is None else panel.sparkSession.createDataFrame([(p,) for p in periods], f"{period} {dict(panel.dtypes)[period]}")
    span = found.agg(F.collect_set(period).alias("_p"))
    spine = panel.select(entity).distinct().join(F.broadcast(span)).select(entity, F.explode("_p").alias(period))
    return spine.join(panel, [entity, period], "left").select(*panel.columns)


def fill_missing(df: DataFrame, *, numbers: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """Null numbers become 0, null categories 'unknown'; dates stay."""
    fixed = {c: F.coalesce(F.col(c), F.lit(0)) for c in numbers} | {c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in categories}
    return df.withColumns(fixed)


def without_period(entities: DataFrame, panel: DataFrame, *, entity: str, period: str, at: str) -> DataFrame:
    """Entities that have no row at a period."""
    return entities.join(panel.where(F.col(period) == at).select(entity), entity, "left_anti")


def allowed_only(scores: DataFrame, allowed: DataFrame, *, entity: str) -> DataFrame:
    """Scores of the allowed entities."""
    return scores.join(small(allowed.select(entity)), entity, "left_semi")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
