"""The queries p1 to p3 and p5 over the monthly group tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minespark.functions.normal import entity_key, flag, month_of, trimmed
from minespark.operators.asof import attributes_as_of
from minespark.operators.profile_sorted import ColumnRule, Profile, ks_distances, profile, value_distances
from minespark.operators.snapshots import period_order, snapshot_changes, version_history
from minespark.runtime import small, written

INFO = "dm_zc_yw_moxing_team_info_m"
TARGET = "tablename_cre_kdteam_target"
SCORE = "table_score_flag_month"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """One row for each target row with a usable snapshot row: (target_id, info_id)."""
    month = month_of(F.col("month_id"), F.col("acct_month")).cast("int")
    events = _table(spark, d, TARGET).select(entity_key(F.col("user_no")).alias("k"), "target_id", "event_time", month.alias("m"))
    changes = _table(spark, d, INFO).select(entity_key(F.col("zk_user_no")).alias("k"), "info_id", "load_time", month.alias("m"))
    return attributes_as_of(
        events, changes, key="k", event_id="target_id", event_time="event_time", event_period="m", change_id="info_id", known_at="load_time", change_period="m"
    )


def _states(spark: SparkSession, d: str) -> DataFrame:
    """The snapshot rows with key, month and compared attributes in their normal forms."""
    return _table(spark, d, INFO).select(
        entity_key(F.col("zk_user_no")).alias("zk_user_no"),
        month_of(F.col("month_id"), F.col("acct_month")).alias("month_id"),
        "load_time",
        "info_id",
        trimmed(F.col("area_no_teamzk")).alias("area_no"),
        flag(F.col("is_valid_teamzk")).alias("is_valid"),
        trimmed(F.col("std_user_status_name_teamzk")).alias("status"),
        flag(F.col("is_5g_main_offer_teamzk")).alias("is_5g_main"),
        trimmed(F.col("sig_offer_spec_id_teamzk")).alias("offer_id"),
        F.col("fk_num_teamzk").alias("fk_num"),
    )


_SNAPSHOT = {"key": "zk_user_no", "period": "month_id", "known_at": "load_time", "row_id": "info_id"}


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Groups added, removed or changed between consecutive snapshot months: (month_id, zk_user_no, change_kind)."""
    return snapshot_changes(_states(spark, d), **_SNAPSHOT, attrs=["area_no", "is_valid", "status", "is_5g_main", "offer_id", "fk_num"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Versions of status and 5G flag of each group: (zk_user_no, valid_from, valid_to)."""
    return version_history(_states(spark, d), **_SNAPSHOT, attrs=["status", "is_5g_main"]).select("zk_user_no", "valid_from", "valid_to")


def _full_loads(spark: SparkSession, d: str) -> DataFrame:
    """(load, m, branch_no) of the full loads of the group table, once each."""
    log = _table(spark, d, "load_log").where((trimmed(F.col("tablename")) == INFO) & (F.lower(trimmed(F.col("load_kind"))) == "full"))
    return log.select(F.col("load_id").alias("load"), month_of(F.col("acct_month")).alias("m"), "branch_no").dropna(subset=["load"]).dropDuplicates(["load"])


def _load_pairs(loads: DataFrame) -> DataFrame:
    """(load, earlier): each full load with the same branch's in the preceding snapshot month.

    Every snapshot month has full loads, so the months are those of the loads: a few rows.
    """
    months = period_order(loads, "m")
    later = loads.join(months.select("m", "prev_m"), "m").where("prev_m is not null")
    earlier = loads.select("branch_no", F.col("m").alias("prev_m"), F.col("load").alias("earlier"))
    return later.join(earlier, ["branch_no", "prev_m"]).select("load", "earlier")


def _profile(spark: SparkSession, d: str) -> tuple[Profile, DataFrame]:
    rules = _table(spark, d, "exam_rule").dropDuplicates(["col_name"]).orderBy("col_name").limit(10_001).collect()
    if len(rules) > 10_000:
        raise ValueError("exam_rule lists more than 10,000 columns")
    info = _table(spark, d, INFO)
    columns = [ColumnRule(r.col_name, r.is_number == 1, r.is_coded == 1, r.pattern) for r in rules if r.col_name in info.columns]
    loads = _full_loads(spark, d)
    full = info.join(small(loads.select(F.col("load").alias("load_id"))), "load_id", "left_semi")
    return profile(full, columns, "load_id"), loads


#: Statistics of a recorded profile and the places of the measured ones (fixed values).
STATISTICS = {
    "count_空值": "n_null",
    "count_不同值": "n_distinct",
    "count_格式不符": "n_bad",
    "count_零值": "n_zero",
    "count_负值": "n_neg",
    "最小值": "lo",
    "最大值": "hi",
    "分位数_75%": "q",
}
ROWS_COLUMN, ROWS_STATISTIC = "全量", "count_全量"
#: Limits beyond which a column has changed from one load to the next (fixed values).
NULL_SHIFT, VALUE_SHIFT, QUANTILE_FACTOR = 0.1537, 0.2037, 2


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Wrong entries of the recorded profile, and columns that changed between loads: (load_id, col_name, finding)."""
    p, loads = _profile(spark, d)
    names = F.broadcast(spark.createDataFrame([(i, r.name, r.pattern is not None, r.number, r.coded) for i, r in enumerate(p.rules)], "c int, col_name string, has_pattern boolean, number boolean, coded boolean"))
    stats = written(p.stats, "profile-stats")
    true = stats.join(names, "c")
    kind = "decimal(38,4)"
    value = F.map_from_arrays(F.array(*map(F.lit, STATISTICS)), F.array(*(F.col(x).cast(kind) for x in STATISTICS.values())))
    wide = true.select("load", "col_name", "has_pattern", "number", F.explode(value).alias("col_stat", "true_value"))
    defined = F.when(F.col("col_stat") == "count_格式不符", F.col("has_pattern")).when(F.col("col_stat").isin("count_空值", "count_不同值"), True).otherwise(F.col("number"))
    wide = wide.where(defined).select("load", "col_name", "col_stat", "true_value")
    rows = stats.groupBy("load").agg(F.max("n_rows").cast(kind).alias("true_value"))
    wide = wide.unionByName(rows.select("load", F.lit(ROWS_COLUMN).alias("col_name"), F.lit(ROWS_STATISTIC).alias("col_stat"), "true_value"))
    # a full load of which no row arrived has counts of zero
    recorded = _table(spark, d, "tablename_exam_v").select(F.col("load_id").alias("load"), trimmed(F.col("col_name")).alias("col_name"), trimmed(F.col("col_stat")).alias("col_stat"), F.col("col_value").cast(kind).alias("col_value"))
    recorded = recorded.join(small(loads.select("load")), "load", "left_semi")
    known = [(r.name, s) for r in p.rules for s in STATISTICS if (r.pattern is not None if s == "count_格式不符" else r.number or s in ("count_空值", "count_不同值"))]
    known = F.broadcast(spark.createDataFrame([*known, (ROWS_COLUMN, ROWS_STATISTIC)], "col_name string, col_stat string"))
    compared = recorded.join(known, ["col_name", "col_stat"], "left_semi").join(wide, ["load", "col_name", "col_stat"], "left")
    true_value = F.when(F.col("col_stat").startswith("count_"), F.coalesce("true_value", F.lit(0).cast(kind))).otherwise(F.col("true_value"))
    wrong = compared.where(~true_value.eqNullSafe(F.col("col_value"))).select("load", "col_name", F.col("col_stat").alias("finding"))

    pairs = written(_load_pairs(loads), "profile-pairs")
    share = F.try_divide(F.col("n_null").cast("double"), F.col("n_rows").cast("double"))
    now = stats.select("load", "c", share.alias("nulls"), F.col("q"))
    was = stats.select(F.col("load").alias("earlier"), "c", share.alias("nulls0"), F.col("q").alias("q0"))
    both = now.join(small(pairs), "load").join(was, ["earlier", "c"])
    null_shift = both.where(F.abs(F.col("nulls") - F.col("nulls0")) > NULL_SHIFT).select("load", "c", F.lit("null_shift").alias("finding"))
    q, q0 = F.col("q"), F.col("q0")
    far = (q0 > 0) & ((q > q0 * QUANTILE_FACTOR) | (q * QUANTILE_FACTOR < q0))
    quantile_shift = both.where(far).select("load", "c", F.lit("quantile_shift").alias("finding"))
    value_shift = value_distances(p, pairs).where(F.col("distance") > VALUE_SHIFT).select("load", "c", F.lit("value_shift").alias("finding"))
    shifts = null_shift.unionByName(quantile_shift).unionByName(value_shift).join(names.select("c", "col_name"), "c").select("load", "col_name", "finding")
    return wrong.unionByName(shifts).distinct().select(F.col("load").alias("load_id"), "col_name", "finding")


def p5_ks(spark: SparkSession, d: str) -> DataFrame:
    """Kolmogorov-Smirnov distance of each number column between consecutive full loads of a branch."""
    p, loads = _profile(spark, d)
    names = F.broadcast(spark.createDataFrame([(i, r.name) for i, r in enumerate(p.rules)], "c int, col_name string"))
    found = ks_distances(p, written(_load_pairs(loads), "profile-pairs")).join(names, "c")
    return found.select(F.col("load").alias("load_id"), F.col("earlier").alias("earlier_load_id"), "col_name", F.round("ks", 9).alias("ks"))
