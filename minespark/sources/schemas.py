"""Schemas of the monthly group tables, built from rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

#: Labels of mobile and broadband groups (fixed values).
MOBILE_LABELS = [
    "flag_lw", "flag_notacct", "flag_badstatus", "flag_ls", "flag_rh", "flag_kj", "flag_wf", "flag_fk", "flag_gq", "flag_down", "flag_yb", "flag_hj", "flag_dxb", "flag_5gb", "flag_cl",
]
BROADBAND_LABELS = ["flag_lw", "flag_notacct", "flag_badstatus", "flag_ls"]
#: Columns of the group supplement that are counts, and that are quantiles and maxima (fixed values).
SUPPLEMENT_COUNTS = [
    "spec_count0_fk", "spec_count1_fk", "spec_count2_fk", "spec_count0_wf", "spec_count1_wf", "spec_count2_wf", "spec_count0_kj", "spec_count1_kj", "spec_count2_kj",
]
SUPPLEMENT_VALUES = [
    "spec_pre025_fk", "spec_pre05_fk", "spec_max_fk", "spec_pre025_wf", "spec_pre05_wf", "spec_max_wf", "spec_pre025_kj", "spec_pre05_kj", "spec_max_kj",
]


def label_schema(labels: Sequence[str], key: str = "zk_user_no", spare: int = 5) -> StructType:
    names = [*labels, *(f"flag_{i}" for i in range(1, spare + 1))]
    return StructType([StructField("month_id", StringType()), StructField(key, StringType()), *(StructField(n, IntegerType()) for n in names), StructField("acct_month", StringType())])


def supplement_schema() -> StructType:
    out = [StructField("month_id", StringType()), StructField("zk_user_no", StringType()), StructField("cnt_spec", LongType())]
    for i in range(0, 9, 3):  # three counts, then three values, of each item
        out += [StructField(c, LongType()) for c in SUPPLEMENT_COUNTS[i : i + 3]] + [StructField(c, IntegerType()) for c in SUPPLEMENT_VALUES[i : i + 3]]
    return StructType([*out, StructField("acct_month", StringType())])


def profile_schema() -> StructType:
    return StructType([StructField(c, StringType()) for c in ("col_name", "col_stat")] + [StructField("col_value", DecimalType(30, 4))] + [StructField(c, StringType()) for c in ("acct_month", "tablename")])


def group_schema(spec) -> StructType:
    """The wide group table of a roll-up specification (minespark.operators.rollup): one column per rule, then the partition."""
    kinds = {"string": StringType(), "int": IntegerType(), "bigint": LongType()}
    out = [StructField("month_id", StringType()), StructField("zk_user_no", StringType())]
    for rule in spec:
        t = rule.db_type.lower()
        out.append(StructField(rule.output, DecimalType(*map(int, t[8:-1].split(","))) if t.startswith("decimal(") else kinds.get(t, StringType())))
    return StructType([*out, StructField("acct_month", StringType())])


SCHEMAS = {"mobile_labels": label_schema(MOBILE_LABELS), "broadband_labels": label_schema(BROADBAND_LABELS, "user_no"), "supplement": supplement_schema(), "profile": profile_schema()}
