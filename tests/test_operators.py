import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from minespark.operators import evaluate, features, labels, model, monitor, panel, prep, ranking, rollup, sampling, score, stats
from minespark.operators.report import Bin, clean_bins, merge, merge_similar, merge_small, merge_turning
from minespark.spec import ModelSpec, TableSpec


def test_roll_up(spark, rows):
    df = spark.createDataFrame([("1", "g", 1, 5, 2, "x"), ("1", "g", 0, None, 9, "y"), ("1", "h", 0, 3, None, "z")], "p string, g string, is_main int, amount int, days int, name string")
    rules = [rollup.RollRule("name", "main"), rollup.RollRule("days", "max"), rollup.RollRule("amount", "sum"), rollup.RollRule("days", "max_main", name="mm")]
    assert rows(rollup.roll_up(df, period="p", group="g", is_main=F.col("is_main") == 1, rules=rules)) == [("1", "g", "x", 9, 5, 2), ("1", "h", None, None, 3, None)]
    assert rollup.RollRule("5G_FLUX_x", "sum").output == "flux_5g_x_teamadd"
    assert rollup.case_counts(df, F.col("is_main") == 1) == (3, 1, 0.333)
    with pytest.raises(ValueError):
        rollup.case_counts(df, F.col("p") == "1")
    assert rollup.rate_moved(0.1, 0.106) and not rollup.rate_moved(0.1, 0.104)


def test_labels(spark, rows):
    df = spark.createDataFrame([("202401", 1, "1", 1), ("202401", 2, "1", 1), ("202401", 3, None, 5), ("202402", 1, "0", 2), ("202402", 3, "1", None)], "m string, id int, acct string, fk int")
    rules = [labels.LabelRule("gone", "b.id is null"), labels.LabelRule("unbilled", "not (b.acct = '1')", "b.id is null"), labels.increase_rule("more", "fk"), labels.newly_has_rule("any", "fk", "a.acct = '1'")]
    got = labels.next_period_labels(df, rules, entity="id", period="m", at="202401", ahead=1, spare=1)
    assert rows(got.drop("month_id")) == [(1, 0, 1, 1, 1, None), (2, 1, None, 0, 0, None), (3, 0, 0, 0, 0, None)]


PANEL = [("a", "202401", 1.0, "u"), ("a", "202402", 3.0, None), ("a", "202403", 2.0, "v"), ("b", "202402", 4.0, "u"), ("b", "202403", None, "u"), ("c", "202401", 5.0, "w")]
SCHEMA = "id string, m string, x double, c string"


def test_panel(spark, rows):
    df = spark.createDataFrame(PANEL, SCHEMA)
    full = panel.gate(df, entity="id", period="m", n=3)
    assert full.count() == 9 and rows(full.where("id = 'c' and m = '202402'")) == [("c", "202402", None, None)]
    assert rows(panel.gate(df, entity="id", period="m", n=3, equate="del").select("id").distinct()) == [("a",)]
    assert rows(panel.gate(df, entity="id", period="m", n=3, label="c", at="202403", equate="del").select("id").distinct()) == [("a",)]
    with pytest.raises(ValueError):
        panel.gate(df.union(df), entity="id", period="m", n=3)
    filled = panel.fill_missing(full, numbers=["x"], categories=["c"])
    assert rows(filled.where("id = 'c' and m = '202402'")) == [("c", "202402", 0.0, "unknown")]
    with pytest.raises(ValueError):
        panel.assemble({"a": df}, [TableSpec("main", "b")], entity="id", period="m", at="202401")


def test_recent_features(spark):
    df = panel.fill_missing(panel.pad(spark.createDataFrame(PANEL, SCHEMA), entity="id", period="m"), numbers=["x"], categories=["c"])
    defs = features.fitted(df, features.recent_defs(["x"], {"c": ["u"]}), period="m", at="202403")
    got = {r.id: r.asDict() for r in features.recent_features(df, defs, entity="id", period="m", at="202403", floors={"x": 1.0}).collect()}
    a = got["a"]
    assert (a["avg__x"], a["std__x"], a["min__x"], a["max__x"], a["sep__x"], a["wave__x"], a["grow__x"], a["more0cnt__x"], a["valuecnt__c~u"]) == (2, 1, 1, 3, 0.5, 1, 1, 3, 1)
    zero = df.withColumn("x", F.lit(0.0))
    r = features.recent_features(zero, features.recent_defs(["x"], None, ["sep", "wave"]), entity="id", period="m", at="202403").first()
    assert (r["sep__x"], r["wave__x"]) == (0, 1)
    many = [features.FeatureDef("avg", ("x",))] * 1
    features.AGGS_AT_ONCE, kept = 2, features.AGGS_AT_ONCE
    try:
        assert features.recent_features(df, defs, entity="id", period="m", at="202403", floors={"x": 1.0}).where("id = 'a'").first().asDict() == a
    finally:
        features.AGGS_AT_ONCE = kept
    assert many[0].name == "avg__x" and features.field_pairs("abc") == [("a", "b"), ("a", "c"), ("b", "c")]


def test_sampling(spark):
    df = spark.range(300).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"), (F.col("id") % 3).alias("s"))
    key = sampling.hash_key(F.col("id"))
    how = {"label": "y", "positive": "1", "negative": "0", "key": key}
    one = sampling.down_sample(df, positive_limit=20, ratio=2, **how)
    assert (one.where("y = 1").count(), one.where("y = 0").count()) == (20, 40)
    assert {r.id for r in one.collect()} == {r.id for r in sampling.down_sample(df.repartition(7), positive_limit=20, ratio=2, **how).collect()}
    strata = sampling.down_sample(df, positive_limit=20, ratio=2, stratified="s", **how).where("y = 0").groupBy("s").count().collect()
    assert all(13 <= r["count"] <= 14 for r in strata)
    assert sampling.down_sample(df, positive_limit=500, ratio=50, **how).count() == 300
    assert sampling.usable_ratios([1, 3, 20], 10, 50) == [1, 3, "actual"] and sampling.usable_ratios([1], 10, 50) == [1]


def test_ranks_and_quantiles(spark, rows):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "id int, s double").repartition(5)
    got = ranking.global_rank(df, [F.desc("s"), F.asc("id")]).collect()
    want = sorted(((r.id, r.s) for r in got), key=lambda x: (-x[1], x[0]))
    assert [(r.id, r.s) for r in sorted(got, key=lambda r: r["rank"])] == want and sorted(r["rank"] for r in got) == list(range(1, 51))
    q = ranking.exact_quantiles(df, "s", [0, 0.1, 0.33, 1])
    assert all(abs(v - np.quantile([i % 7 for i in range(50)], p)) < 1e-12 for p, v in q.items())
    assert ranking.exact_quantiles(df.limit(0), "s", [0.5]) == {0.5: None}
    groups = spark.createDataFrame([(g, float(x), None) for g, n in (("a", 9), (None, 4), ("hot", 400)) for x in range(n)] + [("e", None, None), ("n", float("nan"), 1.0)], "_g string, x double, col double").repartition(6)
    q2 = {(r._1, r.col, r.share): r.value for r in ranking.quantiles(groups, ["x", "col"], [0.25, 0.5], by=["_g"]).withColumnRenamed("_g", "_1").collect()}
    assert q2 == {("a", "x", 0.25): 2.0, ("a", "x", 0.5): 4.0, (None, "x", 0.25): 0.75, (None, "x", 0.5): 1.5, ("hot", "x", 0.25): 99.75, ("hot", "x", 0.5): 199.5, ("n", "col", 0.25): 1.0, ("n", "col", 0.5): 1.0}
    lv = score.ranked(spark.range(100).select("id", F.col("id").cast("double").alias("score")), ties=[("id", True)])
    assert all(r.score_level == max(1, r.id + 1) for r in lv.collect())


def test_woe_and_psi(spark):
    df = spark.createDataFrame([("a", "1")] * 3 + [("a", "0")] + [("b", "0")] * 4 + [(None, "1"), ("a", "2")], "v string, y string")
    woe = {r.v: r for r in stats.woe_iv(stats.crosstab(df, ["v"], "y", "1", "0")).collect()}
    # zero cells are 1 before the totals: P = 3 + 1 + 1, N = 1 + 4 + 1
    assert math.isclose(woe["a"].woe, math.log((3 / 5) / (1 / 6))) and math.isclose(woe["b"].woe, math.log((1 / 5) / (4 / 6))) and math.isclose(woe[None].woe, math.log((1 / 5) / (1 / 6)))
    old = spark.createDataFrame([("x", 10), ("y", 0), ("z", 5)], "v string, n long")
    new = spark.createDataFrame([("x", 5), ("w", 4)], "v string, n long")
    want = sum((b / 11 - a / 17) * math.log((b / 11) / (a / 17)) for a, b in ((10, 5), (1, 1), (5, 1), (1, 4)))
    assert math.isclose(stats.psi(old, new), want)
    with pytest.raises(ValueError):
        stats.psi(old, spark.createDataFrame([("q", 1)], "v string, n long"))
    assert stats.drop_correlated([("a", "b", 0.9), ("b", "c", -0.95), ("a", "c", 0.85), ("a", "d", None)], {"a": 2, "b": 1, "c": 1}, 0.8) == ["c", "b"]


def test_panel_drift(spark):
    rows = [("1", float(i), "a") for i in range(1, 9)] + [("2", float(i), "b" if i > 4 else "a") for i in range(5, 13)] + [("2", None, None), (None, 1.0, "a")]
    df = spark.createDataFrame(rows, "m string, x double, c string")
    got = {(r.col, r.m, r.v): (r.r_old, r.r_new, r.moved) for r in stats.panel_drift(df, period="m", first="1", numbers=["x"], categories=["c"], limit=0.3).collect()}
    assert got["c", "2", "b"] == (0.0, 8 / 9, True) and got["c", "2", "a"] == (1.0, 0.0, True) and got["c", "2", ""] == (0.0, 1 / 9, False)
    assert [got["x", "2", str(v)][1] for v in range(-1, 4)] == [4 / 9, 0.0, 0.0, 2 / 9, 3 / 9] and got["x", "1", "0"] == (0.25, 0.25, False)
    assert stats.constant_columns(df.withColumn("k", F.lit(None)), ["m", "x", "k"]) == ["k"]


def test_expectations(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "a")], "x double, k string")
    with pytest.raises(ValueError, match="x"):
        stats.require(df, stats.finite(["x"]))
    stats.require(df.limit(1), stats.finite(["x"]))
    assert stats.only_value(df, "k") == "a"
    with pytest.raises(ValueError):
        stats.only_value(df, "x")


def test_mdlp_edges():
    x = np.arange(100.0)
    assert prep.mdlp_edges(x, (x >= 50) * 10, (x < 50) * 10) == [-math.inf, 49.5, math.inf]
    assert prep.mdlp_edges(x, np.ones(100), np.ones(100)) == [-math.inf, math.inf]
    three = np.where((x >= 30) & (x < 60), 9, 1)
    assert prep.mdlp_edges(x, three, 10 - three) == [-math.inf, 29.5, 59.5, math.inf]
    assert len(prep.mdlp_edges(x, three, 10 - three, bin_limit=2)) == 3
    assert prep.mdlp_edges(np.array([]), np.array([]), np.array([])) == [-math.inf, math.inf]


def test_mdlp_of_many_values(spark):
    # mostly zero, classes that change within a two-percent tail, and a column with many noisy bins
    rnd = np.random.default_rng(3)
    n = 60_000
    tail = np.where(rnd.random(n) < 0.02, np.round(rnd.gamma(2.0, 500.0, n), 2), 0.0)
    wave = np.round(rnd.random(n) * 4000, 1)
    few = rnd.integers(0, 40, n).astype(float)
    y = np.where(tail > 0, (tail > 1200) | (np.floor(tail / 150) % 2 == 1), rnd.random(n) < 0.3 + 0.2 * np.sin(wave / 300) + 0.004 * few).astype(int)
    df = spark.createDataFrame(list(zip(tail.tolist(), wave.tolist(), few.tolist(), map(str, y.tolist()))), "tail double, wave double, few double, y string").repartition(5)

    def want(x: np.ndarray, bin_limit: int | None = None) -> list[float]:
        values, at = np.unique(x, return_inverse=True)
        edges = prep.mdlp_edges(values, np.bincount(at, y), np.bincount(at, 1 - y), bin_limit=bin_limit)
        held = np.bincount(np.searchsorted(edges[1:-1], x, side="left"), minlength=len(edges) - 1)
        return [edges[0], *(e for e, h in zip(edges[1:-1], held) if h >= 30), edges[-1]]

    columns = {"tail": tail, "wave": wave, "few": few}
    assert len(np.unique(tail)) > 1000 and len(np.unique(wave)) > 5000 and len(want(tail)) > 6
    for how in ({}, {"histogram": 20}, {"bin_limit": 4}):
        got = prep.fit_mdlp(df, list(columns), "y", "1", "0", **how).rules
        assert {c: [float(e) for e in r["edges"]] for c, r in got.items()} == {c: want(x, how.get("bin_limit")) for c, x in columns.items()}


def test_steps(spark, rows):
    df = spark.createDataFrame([(float(i), "abc"[i % 3] if i % 10 else None, "1" if i % 3 == 0 else "0") for i in range(300)], "x double, c string, y string")
    bins = prep.fit_mdlp(df.withColumn("y", (F.col("x") > 99.5).cast("string")).withColumn("y", F.when(F.col("y") == "true", "1").otherwise("0")), ["x"], "y", "1", "0")
    assert [r[0] for r in bins.apply(spark.createDataFrame([(-5.0,), (99.5,), (99.6,), (None,), (1e9,)], "x double")).collect()] == [0, 0, 1, None, 1]
    step, iv = prep.fit_woe(df, ["c"], "y", "1", "0")
    assert prep.Fitted.from_json(step.to_json()) == step and iv["c"] > 1
    assert step.apply(spark.createDataFrame([("new",)], "c string")).first()[0] == 0.0
    assert rows(prep.fit_unseen(df, ["c"]).apply(spark.createDataFrame([("zzz",), (None,), ("b",)], "c string"))) == [("a",), ("a",), ("b",)]
    hot = prep.fit_onehot(df, ["c"], label="y", positive="1", negative="0", iv_limit=0.0)
    out = hot.apply(spark.createDataFrame([("a",), ("q",), (None,)], "c string"))
    assert "c" not in out.columns and [r["c~a"] for r in out.collect()] == [1, 0, 0]
    drop, merge_ = prep.fit_prefilter(df.withColumn("k", F.lit(1)), ["x", "k"], ["c"], valuecount_limit=5)
    assert drop.dropped == ("k",) and merge_.rules == {}
    clamp = prep.fit_outliers(df, ["x"], k=0.1)
    assert prep.drop_outliers(df, clamp).count() < 300 == clamp.apply(df).count()
    assert prep.fit_impute(df.withColumn("n", F.lit(None).cast("double")), ["n", "x"], "mean").dropped == ("n",)
    with pytest.raises(ValueError):
        prep.fit_impute(df, ["x"], "guess")
    ints = spark.createDataFrame([("1", "1"), ("-2", "x"), (None, "3")], "p string, q string")
    assert prep.fit_toint(ints, ["p", "q"]).apply(ints).dtypes == [("p", "int"), ("q", "string")]


def test_onehot_of_too_many_values(spark):
    df = spark.createDataFrame([(f"v{i % 60}", "ab"[i % 2], str(i % 2)) for i in range(600)], "many string, few string, y string")
    for how in ({}, {"iv_limit": 0.0, "label": "y"}):
        with pytest.raises(ValueError, match="more than 50 values: .'many'"):
            prep.fit_onehot(df, ["many", "few"], limit=50, **how)
        assert not prep.fit_onehot(df, ["many", "few"], limit=60, **how).dropped


def test_stability_by_class(spark):
    old = spark.createDataFrame([("a", "1")] * 4 + [("b", "1")] * 4 + [("a", "0")] * 5, "v string, y string")
    new = spark.createDataFrame([("a", "1")] * 6 + [("b", "1")] * 2 + [("a", "0")] * 5, "v string, y string")
    want = sum((n - o) * math.log(n / o) for o, n in ((4 / 8, 6 / 8), (4 / 8, 2 / 8)))
    assert math.isclose(stats.psi_by_class(old, new, ["v"], "y", ["1", "0"]).first().psi, want)
    assert {r.v: r.share for r in stats.value_shares(old, "v", "y").collect()} == {"a": 9 / 13, "b": 4 / 13}


def test_evaluation(spark):
    df = spark.createDataFrame([(90.0, "1"), (80.0, "1"), (80.0, None), (70.0, "0"), (10.0, "2"), (None, "1")], "s double, y string")
    e = evaluate.evaluation(df, score="s", label="y", positive="1", negative="0", thresholds=[85, 75, 0]).orderBy("band").collect()
    assert [(r.n_pos, r.n_neg, r.cum_pos, r.cum_neg) for r in e] == [(1, 0, 1, 0), (1, 0, 2, 0), (0, 2, 2, 2)]
    assert [r.precision for r in e] == [1, 1, 0] and e[0].lift == 2.0 and e[2].cum_lift == 1.0 and e[1].cum_recall == 1
    as_neg = evaluate.evaluation(df, score="s", label="y", positive="1", negative="0", thresholds=[0], null_label="negative").first()
    assert (as_neg.n_pos, as_neg.n_neg) == (2, 3)
    r = stats.ks_auc(df, "s", "y", "1", "0").first()
    assert (r.ks, r.auc) == (1.0, 1.0)
    with_gaps = evaluate.evaluation(df, score="s", label="y", positive="1", negative="0", thresholds=[99, 0]).orderBy("band").first()
    assert with_gaps.precision is None and with_gaps.n_pos == 0


def test_choice():
    from types import SimpleNamespace as R

    t = lambda ps: [R(precision=p, threshold=90 - i, cum_share=(i + 1) / 10, cum_precision=0.1) for i, p in enumerate(ps)]
    best, verdicts = evaluate.choose({"a": t([0.5, 0.4, 0.3, 0.2]), "b": t([0.6, 0.4, 0.3, 0.2]), "c": t([0.2, 0.9, 0.3, 0.2])})
    assert best == "b" and "precision rises" in verdicts["c"]["weak"] and not verdicts["a"]["weak"]
    assert evaluate.choose({"c": t([0.2, 0.9])})[0] is None


def test_reasons_and_bands(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "p string, q string")
    out = score.top_reasons(df, {"p": {"a": 0.5, "b": -1.0}, "q": {"x": 0.5, "": 0.2}}, n=2, comments={"p": "P"}, rare={"q": ["zz"]}).collect()
    assert [(r.colname_top1, r.colname_top2, r.colwoe_top1) for r in out] == [("p", "q", 0.5), ("q", None, 0.2)]
    s = spark.createDataFrame([(95.0,), (50.0,), (1.0,), (None,)], "s double")
    assert [r[0] for r in s.select(score.score_band(F.col("s"), [90, 50, 0])).collect()] == [0, 1, 2, None]
    assert score.exported(spark.createDataFrame([(1, 2, 3)], "a_teamzk int, b_teamzk int, b int")).columns == ["a", "b_teamzk", "b"]


def test_monitor(spark, rows):
    s = spark.createDataFrame([("m", "202401", "u1"), ("m", "202402", "u1"), ("m", "202402", "u2"), ("o", "202402", "u1")], "model_name string, acct_month string, user string")
    y = spark.createDataFrame([("202402", "u1", 1), ("202401", "u1", 0)], "acct_month string, user string, flag int")
    how = {"perform": "202403", "n": 2, "period": "acct_month", "entity": "user"}
    cols = ["acct_month", "user", "stat_batch", "flag_value"]
    assert rows(monitor.followed(s, y, {"m": ("flag", 1)}, **how).select(cols)) == [("202401", "u1", 2, 1), ("202402", "u1", 1, 1), ("202402", "u2", 1, None)]
    assert rows(monitor.followed(s, y, {"m": ("flag", 1)}, label_period="own", **how).select(cols))[0] == ("202401", "u1", 2, 0)


def test_bins():
    bins = [Bin(0, 1, 1, 99), Bin(1, 2, 0, 3), Bin(2, 3, 20, 80), Bin(3, 4, 21, 79), Bin(4, 5, 50, 50)]
    assert [b.hi for b in merge_small(bins, 10)] == [2, 3, 4, 5]
    assert [b.hi for b in merge_similar(bins, 0.02)] == [2, 4, 5]
    with pytest.raises(ValueError):
        merge([bins[0], bins[2]], 0)
    bent = [Bin(i, i + 1, n, 100 - n) for i, n in enumerate([10, 20, 5, 30, 12, 50])]
    assert len(merge_turning(bent, 0.95)) < 6
    assert sum(b.n for b in clean_bins(bins)) == sum(b.n for b in bins)


@pytest.fixture(scope="module")
def churn(spark):
    rnd = random.Random(1)
    out = []
    for i in range(700):
        base = rnd.random()
        y = "1" if rnd.random() < 0.05 + 0.6 * base**2 else "0"
        for m in ("202401", "202402", "202403"):
            if rnd.random() > 0.03:
                out.append((f"u{i}", m, 100 * base + rnd.random() * 20, rnd.random() * 10, rnd.choice("abc") if base < 0.6 else "d", y))
    return spark.createDataFrame(out, "user_no string, acct_month string, x double, z double, c string, label string").cache()


def test_workflow(spark, churn, tmp_path):
    from minespark.plans.workflow import day_data, performance, predict, train_and_test

    spec = ModelSpec("churn", "churn", "202403", month_test="202403", month_predict="202403", n_recent=3, iv_limit=0.05, timein_count=100, positive_limit=200, ratios=(1.0,))
    how = {"numbers": ["x", "z"], "categories": {"c": ["a", "d"]}}
    algorithms = model.grid("logistic", {"regParam": [0.01]})
    result = train_and_test(churn, spec, algorithms=algorithms, **how)
    assert len(result.choice.verdicts) == 1 and any("x" in c for c in result.plan.iv)
    best = result.choice.best or next(iter(model.cycle(churn.where("acct_month = '202403'"), {"s": churn.where("acct_month = '202403'")}, numbers=["x", "z"], categories=["c"], label=("label", "1", "0"), models=algorithms, key=sampling.hash_key(F.col("user_no"))).values()))
    best.save(str(tmp_path / "m"))
    again = model.Trained.load(str(tmp_path / "m"))
    assert again.inputs == best.inputs and again.steps == best.steps
    if result.choice.best is not None:
        scored = predict(churn, result, **how)
        n = scored.count()
        assert n == churn.where("acct_month = '202403'").count()
        labelled = scored.join(churn.where("acct_month = '202403'").select("user_no", "label"), "user_no")
        assert stats.ks_auc(labelled, "score", "label", "1", "0").first().auc > 0.65
        assert performance(labelled, spec, best.thresholds).count() == 12
        assert {"score_rank", "score_level", "colname_top1"} <= set(scored.columns)
    dated = spec.with_condition(["x > 1", "dayvalue_a = 1"])
    assert day_data(dated, None, day_column="d", day=15, inputs=["x"]).condition == ("x > 1",)
    with pytest.raises(ValueError):
        day_data(dated, None, day_column="d", day=15, inputs=["dayvalue_a"])


def test_training_with_cumulated_months_and_formulas(spark, churn, tmp_path, monkeypatch):
    """Two base months of the same users, a derived quotient with a fitted floor, a saved result that predicts by what training learned."""
    from minespark.plans import workflow
    from minespark.plans.workflow import TrainResult, aligned, predict, train_and_test

    monkeypatch.setattr(workflow.models, "best_of", lambda trained, on: model.Choice(next(iter(trained.values())), {}, ()))  # weak or not
    rows = churn.unionByName(churn.where("acct_month = '202401'").withColumn("acct_month", F.lit("202312"))).withColumn("old", F.when(F.col("x") > 20, F.col("x") / 100))
    spec = ModelSpec("churn", "churn", "202403", month_test="202403", month_predict="202403", n_recent=3, cumulated_months=1, iv_limit=0.02, timein_count=100, positive_limit=400, train_ratio=2.0, ratios=("actual",))
    base = panel.base_table(rows, spec, "train")
    both = aligned(base.where("data_use = 'data_train'"), spec, "202403")
    assert {r[0] for r in both.select("acct_month").distinct().collect()} == {"202401", "202402", "202403"}
    assert {r[0] for r in both.select(F.substring("user_no", 1, 7)).distinct().collect()} == {"202402_", "202403_"}
    assert panel.check_base(panel.base_counts(base, spec), 3) != []  # users lack months
    assert panel.check_base(panel.base_counts(base, spec).withColumn("n_users", F.lit(1)).groupBy("user_acct_month", "data_use", "period").agg(F.sum("n_users").alias("n_users")).withColumn("n_users", F.lit(5)), 3) == []
    how = {"numbers": ["x", "q", "old"], "categories": {"c": ["a", "d"]}, "formulas": {"q": "x / z"}, "scores": ["old"]}
    result = train_and_test(rows, spec, algorithms=model.grid("logistic", {"regParam": [0.01]}), retrain_limit=0, **how)
    assert set(result.plan.floors) == {"q"} and result.plan.floors["q"] > 0
    few_columns = workflow._pruned(rows.withColumn("unused", F.lit(1)), spec.with_condition(["z > 1"]), numbers=["q"], categories={}, formulas={"q": "x / z"}, scores=[])
    assert sorted(few_columns.columns) == ["acct_month", "label", "user_no", "x", "z"]
    grown = [d for d in result.plan.recent if d.method == "grow"]
    assert all(d.floor is not None for d in grown)
    best = result.choice.best
    result.save(str(tmp_path / "r"))
    again = TrainResult.load(str(tmp_path / "r"))
    assert again.plan == result.plan and again.spec == result.spec and again.choice.best.tables == best.tables and again.choice.best.bands == best.bands
    few = rows.where("substr(user_no, 2) < '300'")  # other rows than those of training: nothing may be fitted again
    cols = ["user_no", "score", "score_cut", "precision", "lift", "score_rank", "score_psi"]
    assert sorted(map(tuple, predict(few, result).select(cols).collect())) == sorted(map(tuple, predict(few, again).select(cols).collect()))
    one = predict(few, again).where("score_cut = 0").first()
    assert one is None or (one.precision, one.lift) == (best.tables["timein"][0].precision, best.tables["timein"][0].lift)


def test_retraining(spark):
    from types import SimpleNamespace as R

    table = lambda p: {"s": [R(precision=p, threshold=1, cum_share=1.0, cum_precision=p)] * 4}
    best = model.Trained("actual/woe/m", [prep.Fitted("drop", ("b",)), prep.Fitted("woe", ("c", "gone"), {})], ["a"], None, ("y", "1", "0"), table(0.5))
    asked = []
    again = lambda p: lambda columns: asked.append(list(columns)) or model.Trained("n", [], ["a"], None, ("y", "1", "0"), table(p))
    choice = model.Choice(best, {}, ())
    assert model.retrain(choice, again(0.5), ["a", "b", "c"], "s", limit=2) is choice and asked == []
    same, moved = (model.retrain(choice, again(p), ["a", "b", "c"], "s") for p in (0.52, 0.3))
    assert asked == [["a"], ["a"]] and same.best.name == "n" and same.warnings == () and "moved" in moved.warnings[0]
    assert model.retrain(model.Choice(None, {}, ()), again(1), ["a"], "s").best is None


def test_nulls_left_by_the_steps(spark):
    df = spark.createDataFrame([(float(i), None if i == 3 else 1.0, str(i % 2)) for i in range(20)], "a double, b double, y string")
    estimator = next(iter(model.grid("logistic", {"regParam": [0.1]}).values()))
    assert model.train_one(df, [], estimator, "m", ["a", "b"], ("y", "1", "0")).inputs == ["a", "b"]
    with pytest.raises(ValueError, match="'b': 1"):
        model.train_one(df, [], estimator, "m", ["a", "b"], ("y", "1", "0"), nulls="error")
    assert len(model.default_models()) == 5
    t = model.train_one(df, [], estimator, "m", ["a", "b"], ("y", "1", "0"))
    assert [x[2] for x in t.importances({"a": "A"})] in (["A", ""], ["", "A"]) and len(t.importances(most=1)) == 1


def test_low_iv_and_unknown_values(spark):
    rows = [("a", "u", "1")] * 30 + [("a", "v", "0")] * 10 + [("b", "v", "0")] * 30 + [("c", "w", "1")] * 5 + [("c", "w", "0")] * 5
    df = spark.createDataFrame(rows, "p string, q string, y string")
    low = prep.fit_low_iv(df, ["p", "q"], "y", "1", "0", iv_limit=0.01)
    assert low.rules == {"p": {"values": ["c"], "to": prep.LOW_IV}, "q": {"values": ["w"], "to": prep.LOW_IV}} and low.dropped == ()
    assert prep.fit_low_iv(df, ["p"], "y", "1", "0", iv_limit=99).dropped == ("p",)
    step = prep.fit_onehot(df, ["p"], ordinal=True, unknown="error")
    other = spark.createDataFrame([("a",), (None,), ("c",)], "p string")
    assert [r.p for r in step.apply(other).collect()] == [0, -1, 2]
    with pytest.raises(Exception, match="unknown value z"):
        step.apply(spark.createDataFrame([("z",)], "p string")).collect()
    assert [r.p for r in prep.fit_onehot(df, ["p"], ordinal=True).apply(spark.createDataFrame([("z",)], "p string")).collect()] == [-1]
    with pytest.raises(ValueError, match="more than 2"):
        prep.fit_woe(df, ["p"], "y", "1", "0", gap_limit=0, limit=2)


def test_columns_of_many_values_are_joined(spark):
    """WOE codes, ordinals and reasons of 300 values come from broadcast joins; they are those of the plan's own look-up."""
    rows = [(f"v{i % 300}" if i % 7 else None, "ab"[i % 2], str(int(i % 300 > 150))) for i in range(3000)]
    df = spark.createDataFrame(rows, "c string, d string, y string")
    step, _ = prep.fit_woe(df, ["c", "d"], "y", "1", "0", gap_limit=0)
    assert len(step.rules["c"]["woe"]) == 301 and "BroadcastHashJoin" in step.apply(df)._jdf.queryExecution().executedPlan().toString()
    other = df.limit(500).unionByName(spark.createDataFrame([("new", "a", "1")], df.schema))
    got = sorted((r.c, r.d) for r in step.apply(other).collect())
    want = sorted((step.rules["c"]["woe"].get(r.c or "", 0.0), step.rules["d"]["woe"][r.d]) for r in other.collect())
    assert got == want
    codes = prep.fit_onehot(df, ["c"], ordinal=True)
    place = {v: i for i, v in enumerate(sorted({r[0] for r in rows if r[0]}))}
    assert sorted(r.c for r in codes.apply(other).collect()) == sorted(place.get(r.c, -1) for r in other.collect())
    woe = {c: r["woe"] for c, r in step.rules.items()}
    top = score.top_reasons(other, woe, n=1).collect()
    assert all(r.colwoe_top1 is None or abs(r.colwoe_top1 - max(woe["c"].get(r.c or "", -999.0), woe["d"][r.d])) < 1e-12 for r in top) and "_w_0" not in top[0].asDict()


def test_predict_reasons(spark):
    from minespark.plans.explore import FeaturePlan
    from minespark.plans.workflow import TrainResult, predict

    # c = "r" is the best sign of the label, but 10 rows hold it in the month to score; d is nearly c, e a weaker sign of its own
    kinds = [("r", 60, 0.95), ("h", 300, 0.7), ("l", 640, 0.1)]
    rnd = random.Random(2)
    train = [(f"t{i}", c, c if i % 50 else "l", "y" if rnd.random() < 0.2 + 0.4 * y else "n", str(int(y))) for i, (c, y) in enumerate((c, rnd.random() < p) for c, n, p in kinds for _ in range(n))]
    t = spark.createDataFrame(train, "user_no string, c string, d string, e string, label string")
    steps = model.fit_pipeline(t, [], ["c", "d", "e"], "label", "1", "0", r_limit=1.1)
    assert {"c", "d", "e"} <= set(next(s for s in steps if s.kind == "woe").rules) and [prep.Fitted.from_json(s.to_json()) for s in steps] == steps
    best = model.train_one(t, steps, next(iter(model.grid("logistic", {"regParam": [0.01]}).values())), "m", ["c", "d", "e"], ("label", "1", "0"))
    best.thresholds = [50.0, 0.0]
    spec = ModelSpec("m", "m", "202403", month_predict="202404", n_recent=1)
    result = TrainResult(spec, FeaturePlan((), ("c", "d", "e"), ("c", "d", "e")), model.Choice(best, {}, ()))
    rows = [(f"u{i}", "202404", c, c, "y") for c, n in (("r", 10), ("h", 90), ("l", 100)) for i in (f"{c}{j}" for j in range(n))]
    panel_rows = spark.createDataFrame(rows, "user_no string, acct_month string, c string, d string, e string")
    how = {"numbers": [], "categories": {"c": [], "d": [], "e": []}}
    reasons = lambda **x: {(r.c, r.colname_top1, r.colcomment_top1, r.colname_top2) for r in predict(panel_rows, result, **how, **x).select("c", "colname_top1", "colcomment_top1", "colname_top2").collect()}
    assert reasons(comments={"c": "C"}) == {("r", "e", "e", None), ("h", "c", "C", "e"), ("l", "e", "e", None)}
    assert reasons(at_most=9, r_limit=1.1, not_causes=["e"]) == {("r", "d", "d", "c"), ("h", "c", "c", "d"), ("l", None, None, None)}
    assert score.rare_values(spark.createDataFrame([("a",), (None,)], "v string"), {"v": {"a": -1.0, "": 0.5}}, threshold=0, at_most=1) == {"v": [""]}


def test_base_table_is_reproducible(spark, churn):
    spec = ModelSpec("m", "m", "202403", timein_count=50, positive_limit=40, train_ratio=2, cumulated_months=1)
    count = lambda df: {(r.data_use, r.user_acct_month): r.n for r in df.groupBy("data_use", "user_acct_month").agg(F.count_distinct("user_no").alias("n")).collect()}
    a, b = (count(panel.base_table(df, spec, "train")) for df in (churn, churn.repartition(9)))
    assert a == b and a["data_timein", "202403"] == 50 and sum(n for (use, _), n in a.items() if use == "data_train") == 120
    assert count(panel.base_table(churn, spec, "train", narrow=False)) == a
    with pytest.raises(ValueError):
        panel.base_table(churn, spec, "none")
