from datetime import date

import pytest
from pyspark.sql import functions as F

from minespark.config import load_config
from minespark.functions import arithmetic, formula, periods, predicates
from minespark.functions.normal import entity_key, flag, month_of, trimmed
from minespark.spec import FieldSpec, ModelSpec, check_fields, kind_of_type, model_specs, read_infos, read_rows, text_to_frame, typed_literal


def test_normal_forms(spark, rows):
    df = spark.createDataFrame([(" z01 ", "2024-01", "202312", "1.0"), ("", "2024 02 ", "202312", " 1"), (None, None, "2023-12", ""), ("\tA　", "bad", "x", "yes ")], "k string, m string, a string, f string")
    got = [tuple(r) for r in df.select(entity_key(F.col("k")), month_of(F.col("m"), F.col("a")), flag(F.col("f")) == flag(F.lit("1")), trimmed(F.col("k"))).collect()]
    assert got == [("Z01", "202401", True, "z01"), (None, "202402", True, None), (None, "202312", None, None), ("A", None, False, "A")]


def test_periods(spark):
    assert periods.month_add("202411", 3) == "202502" and periods.month_add(202401, -1) == 202312 and periods.month_add("20240131", 1) == "20240231"
    assert periods.month_list("202311", "202402") == ["202311", "202312", "202401", "202402"]
    assert periods.month_list(202402, periods=-3) == [202312, 202401, 202402] and periods.month_list("202402", periods=2) == ["202402", "202403"]
    with pytest.raises(ValueError):
        periods.month_list("202401")
    assert periods.days_in_month("202402") == 29 and periods.day_of_next_month("202312", 5) == "20240105"
    assert periods.first_of_latest_run([202001, 202002, 202003, 202004]) == 202001
    assert periods.first_of_latest_run([202001, 202003, 202004]) == 202003
    df = spark.createDataFrame([("202401",), ("20240215",), (None,), ("23000101",), ("x",)], "d string")
    assert [r[0] for r in df.select(periods.parse_partial_date(F.col("d"))).collect()] == [date(2024, 1, 1), date(2024, 2, 15), None, date(2262, 4, 1), None]
    assert [r[0] for r in df.select(periods.add_months(F.substring("d", 1, 6), 1)).collect()] == ["202402", "202403", None, "230002", None]
    m = periods.months_between_rounded(F.lit("2024-03-01").cast("date"), periods.parse_partial_date(F.col("d")))
    assert [r[0] for r in df.select(m).collect()][:3] == [2, 0, -99999]


def test_align(spark, rows):
    df = spark.createDataFrame([("202103", "202103", 1), ("202104", "202104", 1), ("202105", "202105", 1), ("202105", "202104", 2)], "b string, m string, id int")
    got = periods.align_months(df, base="b", period="m", entity="id").select("a_period", "a_entity")
    assert rows(got) == [("202104", "202105_2"), ("202105", "202103_1"), ("202105", "202104_1"), ("202105", "202105_1")]


def test_conjuncts():
    assert predicates.conjuncts(None) == predicates.conjuncts(float("nan")) == predicates.conjuncts("") == predicates.conjuncts([]) == []
    assert predicates.conjuncts("a = 1 and (b = 2 or c = 3) and d between 1 and 2") == ["a = 1", "(b = 2 or c = 3)", "d between 1 and 2"]
    assert predicates.conjuncts(["x = 1", "", "(y = 2 and z = 'p and q')"]) == ["x = 1", "y = 2", "z = 'p and q'"]
    assert predicates.conjuncts("a = 1 or b = 2") == ["a = 1 or b = 2"]
    assert predicates.conjuncts("case when a = 1 and b = 2 then 1 end = 1 and c = 3") == ["case when a = 1 and b = 2 then 1 end = 1", "c = 3"]
    assert predicates.where_text("a = 1") == "where a = 1" and predicates.where_text(None) == ""
    assert predicates.where_text(["a = 1 or b = 2", "c = 3"]) == "where (a = 1 or b = 2) and c = 3"


def test_referenced_columns():
    text = "substr(a, 1, 6) > '202001' and cast(b as text) in ('x', 'y') and c::int is not null and t.d not like '%e%' and f <= 1.5"
    assert predicates.referenced_columns(text) == ["a", "b", "c", "d", "f"]
    assert predicates.without_columns("a = 1 and dayvalue_b > 2 and (c = 1 or dayvalue_d = 2)", "dayvalue_") == (["a = 1"], ["dayvalue_b > 2", "(c = 1 or dayvalue_d = 2)"])


def test_where_and_shard(spark, rows):
    df = spark.createDataFrame([(1, "a1"), (2, "a2"), (3, "b1")], "x int, id string")
    assert rows(predicates.where(df, ["x >= 2", "id <> 'z'"]).select("x")) == [(2,), (3,)]
    assert rows(df.where(predicates.shard(F.col("id"), [1])).select("x")) == [(1,), (3,)]


def test_safe_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (6.0, 3.0), (4.0, -1.0)], "a double, b double")
    floor = arithmetic.fit_floor(df, F.col("b"))
    assert floor == 3.0  # of two positives the second smallest
    assert [r[0] for r in df.select(arithmetic.safe_div(F.col("a"), F.col("b"), floor)).collect()] == [1 / 3, 1 / 3, 0.0, 2.0, 4 / 3]
    negative = spark.createDataFrame([(-1.0,), (-4.0,), (0.0,)], "b double")
    assert arithmetic.fit_floor(negative, F.col("b")) == -4.0
    assert arithmetic.fit_floor(negative.where("b = 0"), F.col("b")) == 1.0
    assert arithmetic.fit_floor(negative.limit(0), F.col("b")) == 1.0


def value(spark, df, name, text, **how):
    return [r[0] for r in df.select(formula.column(formula.parse(name, text), **{"period": "m"} | how).alias("v")).collect()]


def test_formulas(spark):
    df = spark.createDataFrame([("202402", 29.0, 2.0, "p", "20240101"), ("202401", None, 5.0, None, None)], "m string, a double, b double, c string, d string")
    assert value(spark, df, "x", "a / days_month") == [1.0, 0.0]
    assert value(spark, df, "x", "a + b + b") == [33.0, 10.0]
    assert value(spark, df, "x", "a - b") == [27.0, -5.0]
    assert value(spark, df, "paste_x", "(c, m)") == ["p_202402", "unknown_202401"]
    assert value(spark, df, "greatest_x", "{a: 'A', b: 'B'}") == ["A", "B"]
    assert value(spark, df, "casewhen_x", "{a>=1: 'one', a>=20 & b<3: 'two', else: 'none'}") == ["two", "none"]
    assert value(spark, df, "casewhen_x", "{a==29 | b==5: 1}") == [1, 1]
    assert value(spark, df, "ago_b", "{'notago_tovalue': -1}", newest=F.lit("202402")) == [-1.0, 5.0]
    assert value(spark, df, "x", "current_date - d")[1] == -99999
    for bad in ("a * b", "f(a)", "a - b - c", ""):
        with pytest.raises(ValueError):
            formula.parse("x", bad)


def test_lineage():
    f = {n: formula.parse(n, t) for n, t in (("x", "a + b"), ("y", "x - c"), ("z", "y / d"))}
    assert formula.closure(["z"], f) == ["a", "b", "x", "c", "y", "d", "z"]
    assert formula.base_columns(["avg__z", "valuecnt__e~1", "add__a__y"], f) == ["a", "b", "c", "d", "e"]
    assert formula.without_unavailable(["a", "c", "x", "y", "z"], ["b"], f) == ["a", "c"]
    with pytest.raises(ValueError):
        formula.closure(["p"], {"p": formula.parse("p", "q + a"), "q": formula.parse("q", "p + a")})


def test_spec_text(spark, rows):
    assert [typed_literal(x) for x in ("'1'", "12", "1.0", "-3", "ab", '"q"')] == ["1", 12, 1.0, -3, "ab", "q"]
    head, table = read_rows("a\tb\t\n1\tnp.nan\tz\n2\n")
    assert head == ["a", "b"] and table == [{"a": "1", "b": None}, {"a": "2", "b": None}]
    assert rows(text_to_frame(spark, "a\tb\n1\tx\ny\tNone", {"a": "int"})) == [(1, "x"), (None, None)]
    assert read_rows("") == ([], [])
    infos = read_infos("model_name\tratios\tn\nm1\t[1, 'actual']\t3\n#m2\tNone\t4", literal=["ratios"], typed=["n"])
    assert infos == {"m1": {"model_name": "m1", "ratios": [1, "actual"], "n": 3}}
    assert set(read_infos("model_name\n#m2\nm1", keep_marked=True)) == {"m1", "m2"}
    spec = model_specs({"m1": {"short_name": "s", "month_train": "202401", "other": 1}}, {"m1": {"ratios": [1], "iv_limit": 0.1}})["m1"]
    assert (spec.ratios, spec.iv_limit, spec.positive_limit, spec.extra) == ((1,), 0.1, 10000, {"other": 1})
    with pytest.raises(ValueError):
        model_specs({}, {"m1": {}})
    with pytest.raises(ValueError):
        ModelSpec("m", "m", "202401", positive="1", negative="1")
    assert kind_of_type("DECIMAL(20,4)") == "数值型" and kind_of_type("varchar(3)") == "类别型" and kind_of_type("timestamp") == "日期型"
    with pytest.raises(ValueError):
        kind_of_type("blob")
    assert check_fields([FieldSpec("a", table="t"), FieldSpec("a", table="u"), FieldSpec("b", origin="manual_python")], ["t", "v"]) == ["a occurs more than once", "b: no formula", "table u is unknown", "table v has no field"]


def test_config(tmp_path):
    (tmp_path / "e").write_text("# comment\nDATA_DIR='x y'\nn_recent=4\njdbc_password=p\n")
    c = load_config(tmp_path / "e", {"MINESPARK_N_RECENT": "5"})
    assert (c.data_dir, c.n_recent, c.shown()["jdbc_password"]) == ("x y", 5, "***")
    with pytest.raises(ValueError):
        load_config(None, {"MINESPARK_NONE": "1"})
