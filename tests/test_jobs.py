"""Texts, descriptions, trackers, dictionaries, logs and jobs: nulls, empty tables and odd values."""

import logging
import math
import warnings

import pytest
from pyspark.sql import functions as F

from minespark.functions import arithmetic, texts
from minespark.logs import LogStore, run_jobs
from minespark.operators import report, rollup, stats
from minespark.sources import catalog, io
from minespark.spec import CATEGORY, NUMBER, FieldSpec, field_use, table_columns


def test_interval_and_percent_texts(spark, rows):
    assert texts.interval_label(-math.inf, 0.5) == "(-inf, 0.5]" and texts.interval_bounds("(-inf, 0.5]") == (-math.inf, 0.5)
    with pytest.raises(ValueError):
        texts.interval_bounds("other")
    df = spark.createDataFrame([(1, 0.5), (2, 2.0), (3, 9.0), (4, None)], "i int, x double")
    out = df.select("i", texts.interval_of(F.col("x"), [-math.inf, 1, 3, math.inf]).alias("t"))
    assert rows(out) == [(1, "(-inf, 1]"), (2, "(1, 3]"), (3, "(3, inf]"), (4, None)]
    assert rows(out.select("i", texts.lower_bound(F.col("t")))) == [(1, -math.inf), (2, 1.0), (3, 3.0), (4, None)]
    assert df.select(texts.interval_of(F.col("x"), [0, 9])).first()[0] == "(0, 9]"
    p = spark.createDataFrame([(0.1234,), (1.0,), (None,)], "x double").select(texts.percent_text(F.col("x")).alias("t"), texts.percent_text(F.col("x"), 0).alias("u"))
    assert [tuple(r) for r in p.collect()] == [("12.3%", "12%"), ("100.0%", "100%"), (None, None)]
    assert [r[0] for r in spark.createDataFrame([("12.5%",), ("x",), (None,)], "t string").select(texts.percent_value(F.col("t"))).collect()] == [0.125, None, None]
    assert [r[0] for r in spark.createDataFrame([(1.0,), (0.0,), (None,)], "x double").select(arithmetic.guarded_log(F.col("x"))).collect()] == [0.0, math.log(1e-10), None]


def test_descriptions(spark, rows):
    df = spark.createDataFrame([(1.0, None, "a"), (3.0, None, None), (float("nan"), None, "a"), (None, None, "b")], "x double, y int, c string")
    got = {r["col"]: r for r in stats.describe(df, ["x", "y"]).collect()}
    assert (got["x"].n, got["x"].mean, got["x"].lo, got["x"].q50, got["x"].hi) == (2, 2.0, 1.0, 2.0, 3.0) and (got["y"].n, got["y"].mean, got["y"].q25) == (0, None, None)
    assert {r["col"]: r.n for r in stats.describe(df.limit(0), ["x"]).collect()} == {"x": 0}
    table = stats.value_table(df, ["c"])
    assert rows(table) == [("c", "a", 2, 0.5, "50.0%"), ("c", "b", 1, 0.25, "25.0%"), ("c", None, 1, 0.25, "25.0%")]
    assert stats.value_table(df.limit(0), ["c"]).collect() == []
    rates = rollup.label_rates(spark.createDataFrame([("1", 1), ("1", None), ("2", 1), ("2", 1)], "m string, y int"), period="m", labels={"a": F.coalesce(F.col("y") == 1, F.lit(False)), "b": F.lit(False)}, limit=1.0)
    assert rows(rates) == [("a", "1", 2, 1, None, False), ("a", "2", 2, 2, 1.0, True), ("b", "1", 2, 0, None, False), ("b", "2", 2, 0, None, False)]


def test_tracker(spark):
    base = spark.createDataFrame([(float(i % 100), "ab"[i % 2], str(int(i % 100 > 60))) for i in range(400)] + [(None, None, "1")], "x double, c string, y string")
    same = stats.fit_tracker(base, ["x"], ["c"])
    assert {r["col"]: (round(r.psi, 9), r.moved, r.new_values) for r in same.compare(base).collect()} == {"x": (0.0, False, 0), "c": (0.0, False, 0)}
    other = base.where("x > 70 or x is null").withColumn("c", F.lit("z"))
    assert all(r.moved for r in same.compare(other).collect()) and {r["col"]: r.new_values for r in same.compare(other).collect()}["c"] == 1
    labelled = stats.fit_tracker(base, ["x"], ["c"], label="y")
    assert len(labelled.bins.rules["x"]["edges"]) == 3  # cut at the label's change
    assert not any(r.moved for r in labelled.compare(base).collect()) and labelled.compare(base.limit(0)).where("moved").count() >= 0


def test_dictionary_rules():
    specs = [
        FieldSpec("a", kind=NUMBER, table="t"), FieldSpec("b", kind=CATEGORY, table="t", recent=False), FieldSpec("gone", kind=NUMBER, table="t", available=False), FieldSpec("a", kind=NUMBER, table="t"),
        FieldSpec("q", kind=NUMBER, origin="manual_python", formula="a / gone"), FieldSpec("r", kind=NUMBER, origin="manual_python", formula="a + a", auto=False, is_cause=False, must_remain=True), FieldSpec("id", table="u", into_model=False, current=False),
    ]
    use = field_use(specs)
    assert use.numbers == ("a", "a", "r") and use.categories == ("b",) and use.no_recent == ("b", "r") and use.no_current == ("r", "id")
    assert use.not_causes == use.must_remain == ("r",) and use.formulas == {"r": "a + a"}
    assert table_columns(specs, "t") == ["a", "b", "gone"] and table_columns(specs, "none") == []


def test_log_store_and_jobs(spark):
    log = logging.getLogger("minespark")
    with LogStore("j", ignore=["noise"]) as store:
        said = run_jobs(spark, {"a": lambda: log.info("one %d", 1), "b": lambda: 1 / 0, "c": lambda: log.info("noise")}, at_once=2)
        warnings.warn("careful", stacklevel=1)
    log.info("after")
    assert said == {"a": "succeed", "b": "ZeroDivisionError: division by zero", "c": "succeed"}
    got = store.frame(spark).collect()
    assert {(r.job, r.level, r.text) for r in got} == {("j", "INFO", "one 1"), ("j", "ERROR", "b: division by zero"), ("j", "WARNING", "careful")}
    assert LogStore().frame(spark).collect() == []

    def full():
        raise MemoryError

    with pytest.raises(MemoryError):
        run_jobs(spark, {"x": full})


def test_sql_text_and_literals(spark):
    text = "select a, (select max(b) from t where x = 'a  from b') from u group by a"
    lines = io.sql_text(text).split("\n")
    assert lines[0].startswith("select a") and "from u" in lines and any("'a  from b'" in x for x in lines)
    for v in ("it's", 'a"b', "back\\slash", None, 5, 1.5, True):
        assert spark.sql(f"select {io.sql_literal(v)} as v").first().v == (v if not isinstance(v, float) else pytest.approx(v))


def test_bad_numbers_are_named(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "n string")
    assert io.read_data(spark, df, numbers=["n"]).count() == 3
    with pytest.raises(Exception, match="n has a value that is no number: x"):
        io.read_data(spark, df, numbers=["n"], bad_numbers="error").collect()
    with pytest.raises(ValueError):
        io.read_data(spark, df, bad_numbers="other")


def test_day_counts_and_partitions(spark, rows, tmp_path):
    df = spark.createDataFrame([("202401", 9), ("202401", 10), ("202402", 1), (None, 1)], "m string, d int")
    assert rows(catalog.period_counts(df, "m", "20240110", day="d")) == [("202401", 10, 1), ("202402", 1, 1)]
    spark.sql(f"create database jobtest location '{tmp_path}/db'")
    try:
        catalog.create_partitioned(spark, "jobtest.p", "x int, m string, d string", ["m", "d"])
        spark.sql("insert into jobtest.p values (1, '1', 'a'), (2, '2', 'b')")
        assert catalog.partitions(spark, "jobtest.p") == ["m=1/d=a", "m=2/d=b"]
    finally:
        spark.sql("drop database jobtest cascade")


def test_chart_and_report(spark):
    from types import SimpleNamespace as R

    assert report.chart_rows([report.Bin(1, 2, 1, 3), report.Bin(0, 1, 0, 0)]) == [("(0, 1]", 0, 0.0, 0.0), ("(1, 2]", 4, 1.0, 0.25)] and report.chart_rows([]) == []
    trained = R(label=("y", "1", "0"), tables={"s": [R(cum_precision=0.5, cum_recall=0.5, asDict=lambda: {"band": 0})]}, importances=lambda comments, most: [("a", 1.0, comments["a"])])
    df = spark.createDataFrame([("1",), ("0",), (None,)], "y string")
    iv = spark.createDataFrame([("a", 0.1)], "col string, iv double")
    out = report.report(trained, comments={"a": "A"}, sizes={"s": df}, iv=iv, psi=iv.withColumnRenamed("iv", "psi"), fields=iv.select("col", F.lit("A").alias("comment")))
    assert out["sizes"] == {"s": {"n": 3, "n_pos": 1, "n_neg": 1}} and out["effects"]["s"] == [{"band": 0, "f1": 0.5}] and out["importances"] == [("a", 1.0, "A")] and out["screening"].count() == 1
