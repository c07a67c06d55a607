"""Queries over the reference operators, each beside its SQL (none where SQL can't express it)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minespark.functions import arithmetic, formula
from minespark.functions.normal import entity_key, flag, month_of, trimmed
from minespark.functions.periods import align_months, latest_runs, months_between_rounded, parse_partial_date
from minespark.operators import evaluate, features, labels, monitor, panel, prep, profile_table, ranking, rollup, sampling, score, stats
from minespark.operators import report
from minespark.operators.snapshots import latest_states
from minespark.plans import problem_sql as S
from minespark.plans.problems import INFO, SCORE, TARGET
from minespark.runtime import written
from minespark.sources import catalog, io
from minespark.spec import TableSpec
from minespark.streaming import drift

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def ym(c: str):
    return F.date_format(F.col(c), "yyyyMM")


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`").cast("double"), digits) for c in cols})


# --- roll-ups, labels, assembly

@query("""
select strftime(l_shipdate, '%Y%m') as month, l_orderkey, max(case when l_linenumber = 1 then l_extendedprice end) as price_teamzk,
    max(l_quantity) as l_quantity_teammax, max(case when l_linenumber = 1 then l_returnflag end) as l_returnflag_teamzk,
    cast(sum(cast(l_extendedprice as decimal(18,2))) as double) as price_teamadd
from lineitem group by 1, 2
""")  # fmt: skip
def q01_rollup_main_max_sum(spark, d):
    rows = table(spark, d, "lineitem").select(ym("l_shipdate").alias("month"), "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.col("l_extendedprice").alias("price"), F.col("l_extendedprice").cast("decimal(18,2)").alias("exact"))
    rules = [rollup.RollRule("price", "main"), rollup.RollRule("l_quantity", "max"), rollup.RollRule("l_returnflag", "main"), rollup.RollRule("exact", "sum", name="price_teamadd")]
    return rollup.roll_up(rows, period="month", group="l_orderkey", is_main=F.col("l_linenumber") == 1, rules=rules).withColumn("price_teamadd", F.col("price_teamadd").cast("double"))


@query("""
with p as (
    select o_orderpriority, count(*) as cnt_spec, count(*) filter (o_totalprice > 100000) as a, count(*) filter (o_totalprice > 200000) as b,
        quantile_cont(o_totalprice, 0.25) as p25, quantile_cont(o_totalprice, 0.5) as p50, max(o_totalprice) as m from orders group by 1
)
select o_orderkey, cnt_spec, a as above1, b as above2, round(p25, 4) as pre025, round(p50, 4) as pre05, m as most from orders join p using (o_orderpriority)
""")
def q02_plan_group_stats(spark, d):
    out = rollup.with_plan_statistics(table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), plan="o_orderpriority", columns=["o_totalprice"], above=(100000, 200000))
    c = "o_totalprice"
    return out.select("o_orderkey", "cnt_spec", F.col(f"spec_count100000_{c}").alias("above1"), F.col(f"spec_count200000_{c}").alias("above2"), F.round(f"spec_pre025_{c}", 4).alias("pre025"), F.round(f"spec_pre05_{c}", 4).alias("pre05"), F.col(f"spec_max_{c}").alias("most"))


STATE_SQL = f"""
r as (
    select {S.key('zk_user_no')} as k, {S.MONTH} as m, info_id, load_time, {S.trimmed('std_user_status_name_teamzk')} as status, {S.flag('is_acct_teamzk')} as acct,
        {S.flag('is_valid_teamzk')} as valid, fk_num_teamzk as fk, cast(arpu_teamadd as double) as arpu, {S.trimmed('sig_offer_spec_id_teamzk')} as offer, open_months_teamzk as open_months
    from dm_zc_yw_moxing_team_info_m
),
s as (
    select * exclude (rn) from (select *, row_number() over (partition by k, m order by load_time desc nulls last, info_id) as rn from r where k is not null and m is not null) where rn = 1
)"""


def group_states(spark, d) -> DataFrame:
    """Each group's state by month, with the attributes that labels need."""
    t = table(spark, d, INFO)
    cols = {
        "status": trimmed(F.col("std_user_status_name_teamzk")), "acct": flag(F.col("is_acct_teamzk")), "valid": flag(F.col("is_valid_teamzk")),
        "fk": F.col("fk_num_teamzk"), "arpu": F.col("arpu_teamadd").cast("double"), "offer": trimmed(F.col("sig_offer_spec_id_teamzk")), "open_months": F.col("open_months_teamzk"),
    }
    rows = t.select(entity_key(F.col("zk_user_no")).alias("zk"), month_of(F.col("month_id"), F.col("acct_month")).alias("month"), "load_time", "info_id", *(c.alias(n) for n, c in cols.items()))
    s = latest_states(rows, key="zk", period="month", known_at="load_time", row_id="info_id", attrs=list(cols))
    return s.select("k", "m", *(F.col(f"a{i}").alias(n) for i, n in enumerate(cols)))


@query(f"""
with {STATE_SQL}
select a.m as month_id, a.k, case when b.k is null then 1 else 0 end as flag_lw,
    case when b.k is null then null when not (b.acct = '1.0000000000') then 1 else 0 end as flag_notacct,
    case when b.k is null then null when not (b.status = '在用') then 1 else 0 end as flag_badstatus,
    case when b.k is null or not (b.acct = '1.0000000000') or not (b.status = '在用') then 1 else 0 end as flag_ls,
    case when b.fk > a.fk then 1 else 0 end as flag_fk,
    case when not (a.acct = '1.0000000000' and a.open_months >= 3) or b.k is null or c.k is null then null when (a.offer <> b.offer) and c.arpu > a.arpu then 1 else 0 end as flag_gq,
    case when not (a.acct = '1.0000000000' and a.open_months >= 3) or b.k is null or c.k is null then null when (a.offer <> b.offer) and c.arpu < a.arpu then 1 else 0 end as flag_down,
    cast(null as integer) as flag_1
from (select * from s where m = '202401') a left join (select * from s where m = '202402') b on a.k = b.k left join (select * from s where m = '202403') c on a.k = c.k
""")
def q03_label_next_period(spark, d):
    elig = "a.acct = '1.0000000000' and a.open_months >= 3"
    how = {"entity": "k", "eligible": elig, "changed": "a.offer <> b.offer", "amount": "arpu"}
    rules = [*labels.presence_rules("k", "b.acct = '1.0000000000'", "b.status = '在用'"), labels.increase_rule("flag_fk", "fk"), labels.change_rule("flag_gq", direction=">", **how), labels.change_rule("flag_down", direction="<", **how)]
    return labels.next_period_labels(group_states(spark, d), rules, entity="k", period="m", at="202401", spare=1)


UD = "select user_id, strftime(ts, '%Y%m%d') as day, sum(cast(value as decimal(18,2))) as x, count(*) as n, count(*) filter (event_type = 'error') as n_err from events group by 1, 2"


def user_days(spark, d) -> DataFrame:
    e = table(spark, d, "events")
    return e.groupBy("user_id", F.date_format("ts", "yyyyMMdd").alias("day")).agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("x"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("n_err"))


@query(f"""
with u as ({UD})
select a.day as month_id, a.user_id, case when b.user_id is null then 1 else 0 end as flag_lw,
    case when b.user_id is null then null when not (b.n > b.n_err) then 1 else 0 end as flag_notacct,
    case when b.user_id is null then null when not (b.n < 4) then 1 else 0 end as flag_badstatus,
    case when b.user_id is null or b.n_err > 0 or not (b.n < 4) then 1 else 0 end as flag_ls
from (select * from u where day = '20240110') a left join (select * from u where day = '20240111') b using (user_id)
""")
def q04_label_two_status(spark, d):
    rules = labels.presence_rules("user_id", "b.n > b.n_err", "b.n < 4", churn="b.n_err > 0")
    return labels.next_period_labels(user_days(spark, d), rules, entity="user_id", period="day", at=["20240110", "20240111"])


OM = "select o_custkey as id, strftime(o_orderdate, '%Y%m') as month, count(*) as n, sum(cast(o_totalprice as decimal(18,2))) as x, max(o_orderstatus) as st from orders group by 1, 2"


def customer_months(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_custkey").alias("id"), ym("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("x"), F.max("o_orderstatus").alias("st"))


@query(f"""
with om as ({OM}), c as (select c_custkey as id, c_mktsegment, n_name from customer join nation on c_nationkey = n_nationkey)
select om.id, om.n, cast(om.x as double) as x, c_mktsegment, n_name, case when b.id is null then 1 else 0 end as gone, md5(cast(om.id as varchar)) as rn_key
from om left join c using (id) left join (select * from om where month = '199611') b using (id) where om.month = '199610'
""")
def q05_wide_assembly(spark, d):
    om = customer_months(spark, d)
    extra = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("id"), F.lit("199610").alias("month"), "c_mktsegment", "n_name")
    now = om.where("month = '199610'").select("id", "month")
    gone = now.join(om.where("month = '199611'").select("id", F.lit(0).alias("_b")), "id", "left").select("id", "month", F.coalesce("_b", F.lit(1)).alias("gone"))
    tables = [TableSpec("main", "om"), TableSpec("add", "extra", on=("id",))]
    out = panel.assemble({"om": om, "extra": extra}, tables, entity="id", period="month", at="199610", label=gone, columns=["id", "n", "x", "c_mktsegment", "n_name", "gone"])
    return out.withColumn("x", F.col("x").cast("double"))


@query(f"""
with om as ({OM}), e as ({UD}),
m as (select id, n from om where month = '199612')
select m.id, m.n, cast(e.n as bigint) as dayvalue_n, cast(e.x as double) as dayvalue_x from m left join (select * from (select user_id as id, '1997' || substr(day, 5) as day, n, x from e) where day = '19970115') e using (id)
""")
def q06_day_offset_lookup(spark, d):
    daily = user_days(spark, d).select(F.col("user_id").alias("id"), F.concat(F.lit("1997"), F.substring("day", 5, 4)).alias("day"), "n", F.col("x").cast("double").alias("x"))
    side = panel.day_lookup(daily, at="199612", day_column="day", day=15, entity="id")
    return customer_months(spark, d).where("month = '199612'").select("id", "n").join(side, "id", "left")


@query("""
select user_id, max(value) filter (event_type = 'click') as click, max(value) filter (event_type = 'error') as error, max(value) filter (event_type = 'purchase') as purchase,
    max(value) filter (event_type = 'signup') as signup, max(value) filter (event_type = 'view') as "view" from events group by 1
""")
def q07_score_pivot(spark, d):
    return panel.pivot_scores(table(spark, d, "events").select("user_id", "event_type", "value"), entity="user_id", name="event_type", value="value", names=["click", "error", "purchase", "signup", "view"])


@query(f"with om as ({OM}) select om.id, om.month, om.n from om join (select distinct id from om where month = '199806' and n >= 1) c using (id) where month between '199804' and '199806'")
def q08_recent_n_inner(spark, d):
    om = customer_months(spark, d)
    return panel.recent_periods(om, om.where("month = '199806' and n >= 1"), entity="id", period="month", at="199806", n=3).select("id", "month", "n")


PAD = f"""
u as ({UD}), p as (select * from u where day between '20240120' and '20240124'),
z as (
    select s.user_id, s.day, coalesce(p.x, 0) as x, coalesce(p.n, 0) as n
    from (select user_id, day from (select distinct user_id from p), (select unnest(['20240120','20240121','20240122','20240123','20240124']) as day)) s left join p using (user_id, day)
)"""


def padded(spark, d) -> DataFrame:
    rows = user_days(spark, d).where("day between '20240120' and '20240124'").select("user_id", "day", F.col("x").cast("double").alias("x"), "n")
    out = panel.pad(rows, entity="user_id", period="day", periods=[f"202401{i}" for i in range(20, 25)])
    return panel.fill_missing(out, numbers=["x", "n"], categories=[])


@query(f"with {PAD} select user_id, day, cast(x as double) as x, n from z")
def q09_pad_missing(spark, d):
    return padded(spark, d)


@query(f"with {PAD} select user_id, day, n from p where user_id in (select user_id from p group by 1 having count(distinct day) = 5)")
def q10_drop_incomplete(spark, d):
    rows = user_days(spark, d).where("day between '20240120' and '20240124'").select("user_id", "day", "n")
    return panel.complete_only(rows, entity="user_id", period="day", n=5)


@query("select o_custkey, o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')")
def q11_semi_limit(spark, d):
    allowed = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return panel.allowed_only(table(spark, d, "orders").select("o_custkey", "o_orderkey"), allowed, entity="o_custkey")


@query(f"with om as ({OM}) select c_custkey as id from customer where c_custkey not in (select id from om where month = '199703')")
def q12_anti_absent(spark, d):
    return panel.without_period(table(spark, d, "customer").select(F.col("c_custkey").alias("id")), customer_months(spark, d), entity="id", period="month", at="199703")


@query("select c_custkey as id, c_acctbal as bal, c_mktsegment as seg, cast(null as integer) as nation from customer union all select s_suppkey, s_acctbal, null, s_nationkey from supplier")
def q13_union_models(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    return panel.union_all([a, table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("nation"))])


@query("""
select c_custkey, c_mktsegment from (select *, row_number() over (partition by c_mktsegment order by md5(cast(c_custkey as varchar))) as r from customer)
where c_mktsegment = 'BUILDING' and r <= 40 or c_mktsegment = 'MACHINERY' and r <= 80
""")
def q14_quota_sample(spark, d):
    return sampling.quota(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), {"BUILDING": 40, "MACHINERY": 80}, by="c_mktsegment", key=sampling.hash_key(F.col("c_custkey")))


@query("select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as double) as l_linenumber, l_shipmode from (select l_orderkey, l_linenumber, l_linestatus as l_shipmode, l_quantity from lineitem) where l_quantity > 45 and l_shipmode in ('O')")
def q15_read_options(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("L_ORDERKEY"), "l_linenumber", F.col("l_linestatus").alias("l_shipmode"), "l_quantity")
    return io.read_data(spark, rows, condition=["l_quantity > 45", "l_shipmode in ('O')"], leave=["l_quantity"], chars=["l_orderkey"], numbers=["l_linenumber"])


@query("select r_name, count(*) as n from nation join region on n_regionkey = r_regionkey group by 1")
def q16_sql_on_frames(spark, d):
    return io.sql_on_frames(spark, "select r_name, count(*) as n from nat join reg on n_regionkey = r_regionkey group by 1", {"nat": table(spark, d, "nation"), "reg": table(spark, d, "region")})


# --- features

def recent(spark, d, *methods) -> DataFrame:
    rows = padded(spark, d)
    defs = features.fitted(rows, features.recent_defs(["x"], None, methods), period="day", at="20240124")
    return features.recent_features(rows, defs, entity="user_id", period="day", at="20240124")


@query(f"with {PAD} select user_id, round(avg(cast(x as double)), 6) as avg__x, round(stddev_samp(cast(x as double)), 6) as std__x, cast(min(x) as double) as min__x, cast(max(x) as double) as max__x from z group by 1")
def q17_recent_avg_std_min_max(spark, d):
    return rounded(recent(spark, d, "avg", "std", "min", "max"), "avg__x", "std__x")


@query(f"""with {PAD} select user_id, round(case when sum(x) = 0 then 0 else stddev_samp(cast(x as double)) / avg(cast(x as double)) end, 6) as sep__x,
round(case when sum(x) = 0 then 1 else cast(max(x) - min(x) as double) / avg(cast(x as double)) end, 6) as wave__x from z group by 1""")
def q18_recent_sep_wave(spark, d):
    return rounded(recent(spark, d, "sep", "wave"), "sep__x", "wave__x")


@query(f"""with {PAD}, g as (select user_id, cast(max(x) filter (day = '20240124') as double) as now, avg(cast(x as double)) filter (day < '20240124') as was from z group by 1),
pos as (select was, row_number() over (order by was) as r, count(*) over () as n from g where was > 0),
f as (select was as floor from pos where r = least(1000, (n + 99) // 100, n - 1) + 1)
select user_id, round(now / greatest(was, floor), 6) as grow__x from g, f""")
def q19_recent_grow(spark, d):
    return rounded(recent(spark, d, "grow"), "grow__x")


@query(f"""with {PAD}, q as (select quantile_cont(cast(x as double), 0.25) as q from z where day = '20240124')
select user_id, count(*) filter (x > 0) as more0cnt__x, count(*) filter (cast(x as double) > q) as moreq25cnt__x from z, q group by 1""")
def q20_months_above(spark, d):
    return recent(spark, d, "more0cnt", "moreq25cnt")


@query("""select user_id, count(*) filter (event_type = 'click') as "valuecnt__event_type~click", count(*) filter (event_type = 'view') as "valuecnt__event_type~view" from events group by 1""")
def q21_value_months(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("day"))
    return features.recent_features(rows, features.recent_defs([], {"event_type": ["click", "view"]}), entity="user_id", period="day", at="20240130")


@query("""select c_custkey, c_mktsegment, cast(c_mktsegment = 'BUILDING' as integer) as "c_mktsegment~BUILDING", cast(c_mktsegment = 'MACHINERY' as integer) as "c_mktsegment~MACHINERY" from customer""")
def q22_onehot_now(spark, d):
    defs = [features.FeatureDef("onehot", ("c_mktsegment",), v) for v in ("BUILDING", "MACHINERY")]
    return features.current_features(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), defs)


@query("""with p as (select p_partkey, cast(p_size - 25 as double) as a, p_retailprice as b from part),
pos as (select a, row_number() over (order by a) as r, count(*) over () as n from p where a > 0), f as (select a as floor from pos where r = least(1000, (n + 99) // 100, n - 1) + 1)
select p_partkey, round(a + b, 6) as add__a__b, round(a - b, 6) as sub__a__b, round(a * b, 6) as mult__a__b, round(b / greatest(a, floor), 6) as div__b__a from p, f""")
def q23_pair_ops(spark, d):
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") - 25).cast("double").alias("a"), F.col("p_retailprice").alias("b"), F.lit("1").alias("m"))
    defs = [*(features.FeatureDef(m, ("a", "b")) for m in ("add", "sub", "mult")), features.FeatureDef("div", ("b", "a"))]
    out = features.current_features(p, features.fitted(p, defs, period="m", at="1"))
    return rounded(out.drop("a", "b", "m"), "add__a__b", "sub__a__b", "mult__a__b", "div__b__a")


def _formula(df: DataFrame, name: str, text: str, **how) -> DataFrame:
    return df.withColumn(name, formula.column(formula.parse(name, text), **{"period": "month"} | how))


@query("select p_partkey, p_brand || '_' || p_type as paste_brand_type from part")
def q24_paste_cross(spark, d):
    return _formula(table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), "paste_brand_type", "(p_brand, p_type)").select("p_partkey", "paste_brand_type")


@query("""with c as (select o_custkey, count(*) filter (o_orderstatus = 'O') as n_o, count(*) filter (o_orderstatus = 'P') as n_p, count(*) filter (o_orderstatus = 'F') as n_f from orders group by 1)
select o_custkey, case when n_o >= n_p and n_o >= n_f then 'open' when n_p >= n_f then 'part' else 'full' end as greatest_status from c""")
def q25_greatest_label(spark, d):
    c = table(spark, d, "orders").groupBy("o_custkey").agg(*(F.count_if(F.col("o_orderstatus") == s).alias(f"n_{s.lower()}") for s in "OPF"))
    return _formula(c, "greatest_status", "{n_o: 'open', n_p: 'part', n_f: 'full'}").select("o_custkey", "greatest_status")


@query("""select o_orderkey, case when o_totalprice >= 200000 and o_orderstatus <> 'F' then 'big' when o_orderpriority = '1-URGENT' then 'fast' when o_totalprice < 50000 then 'small' else 'other' end as casewhen_kind from orders""")
def q26_casewhen_rules(spark, d):
    text = "{o_totalprice<50000: 'small', o_orderpriority=='1-URGENT': 'fast', o_totalprice>=200000 & o_orderstatus!='F': 'big', else: 'other'}"
    return _formula(table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus"), "casewhen_kind", text).select("o_orderkey", "casewhen_kind")


@query(f"""with om as ({OM}) select id, month, round(cast(x as double) / day(last_day(strptime(month || '01', '%Y%m%d'))), 6) as per_day, cast(x as double) + n as total, n - cast(x as double) as less from om""")
def q27_formula_arith(spark, d):
    om = customer_months(spark, d).select("id", "month", "n", F.col("x").cast("double").alias("x"))
    out = _formula(_formula(_formula(om, "per_day", "x / days_month"), "total", "x + n"), "less", "n - x")
    return rounded(out.select("id", "month", "per_day", "total", "less"), "per_day")


@query("""select o_orderkey, case when o_orderstatus = 'F' then -99999 else cast(round_even(date_diff('day', cast(o_orderdate as date), date '2001-09-01') / 30.0, 0) as integer) end as months from orders""")
def q28_months_between(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") != "F", F.date_format("o_orderdate", "yyyyMMdd")).alias("t"))
    return o.select("o_orderkey", months_between_rounded(parse_partial_date(F.lit("200109")), parse_partial_date(F.col("t"))).alias("months"))


@query(f"with om as ({OM}) select id, month, case when month = '200107' then -1 else n end as ago_n from om")
def q29_ago_value(spark, d):
    return _formula(customer_months(spark, d), "ago_n", "{'notago_tovalue': -1}", newest=F.lit("200107")).select("id", "month", "ago_n")


@query(f"""with om as ({OM}), b as (select '199605' as base, * from om where month between '199603' and '199605' union all select '199703', * from om where month between '199701' and '199703')
select base || '_' || id as a_entity, strftime(strptime(month || '01', '%Y%m%d') + to_months(cast(case base when '199605' then 10 else 0 end as integer)), '%Y%m') as a_period, n from b""")
def q30_period_align(spark, d):
    om = customer_months(spark, d)
    both = om.where("month between '199603' and '199605'").withColumn("base", F.lit("199605")).unionByName(om.where("month between '199701' and '199703'").withColumn("base", F.lit("199703")))
    return align_months(both, base="base", period="month", entity="id").select("a_entity", "a_period", "n")


# --- profiles and statistics

@query("""with c as (select strftime(o_orderdate, '%Y%m') as month, count(*) as n, count(*) filter (o_orderstatus = 'F') as n_pos from orders group by 1),
l as (select *, lag(n_pos) over (order by month) as b from c)
select month, n, n_pos, case when b is not null then round((greatest(n_pos, b) - least(n_pos, b)) / nullif(least(n_pos, b), 0), 6) end as wave from l""")
def q31_period_counts(spark, d):
    o = table(spark, d, "orders").select(ym("o_orderdate").alias("month"), "o_orderstatus")
    out = rollup.period_rates(o, period="month", positive=F.col("o_orderstatus") == "F")
    return rounded(out, "wave")


@query("select strftime(o_orderdate, '%Y%m') as month, count(*) as n from orders where strftime(o_orderdate, '%Y%m') between '199601' and '199712' group by 1")
def q32_catalog_counts(spark, d):
    return catalog.period_counts(table(spark, d, "orders").select(ym("o_orderdate").alias("month")), "month", "199601", "199712")


PROFILE_SQL = """
pr as (
    select substr(strftime(o_orderdate, '%Y%m'), 1, 4) as year, unnest([
        {'c': '全量', 's': 'count_全量', 'v': cast(count(*) as double)}, {'c': 'o_totalprice', 's': 'count_空值', 'v': count(*) - count(o_totalprice)}, {'c': 'st', 's': 'count_空值', 'v': count(*) - count(nullif(o_orderstatus, 'F'))},
        {'c': 'o_totalprice', 's': 'count_零值', 'v': count(*) filter (o_totalprice = 0)}, {'c': 'o_totalprice', 's': 'count_负值', 'v': count(*) filter (o_totalprice < 0)},
        {'c': 'o_totalprice', 's': '分位数_75%', 'v': quantile_cont(o_totalprice, 0.75)}, {'c': 'o_totalprice', 's': 'count_(-inf, 100000]', 'v': count(*) filter (o_totalprice <= 100000)},
        {'c': 'o_totalprice', 's': 'count_(100000, 300000]', 'v': count(*) filter (o_totalprice > 100000 and o_totalprice <= 300000)}, {'c': 'o_totalprice', 's': 'count_(300000, inf]', 'v': count(*) filter (o_totalprice > 300000)},
        {'c': 'st', 's': 'count_=O', 'v': count(*) filter (o_orderstatus = 'O')}]) as x
    from orders group by 1
)"""


def order_profile(spark, d) -> DataFrame:
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy").alias("year"), "o_totalprice", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("st"))
    return profile_table.profile_rows(o, period="year", numbers=["o_totalprice"], others=["st"], cuts={"o_totalprice": [100000, 300000]}, values={"st": ["O"]})


@query(f"with {PROFILE_SQL} select year, x.c as col_name, x.s as col_stat, round(x.v, 4) as col_value from pr")
def q33_profile_vertical(spark, d):
    return rounded(order_profile(spark, d), "col_value", digits=4)


@query(f"with {PROFILE_SQL} select year, x.c as col_name, x.s as col_stat, cast(x.v as bigint) as n from pr where x.s like 'count_(%' or x.s like 'count_=%'")
def q34_profile_buckets(spark, d):
    rows = order_profile(spark, d).where("col_stat like 'count_(%' or col_stat like 'count_=%'")
    return rows.select("year", "col_name", "col_stat", F.col("col_value").cast("long").alias("n"))


@query(f"""with {PROFILE_SQL},
w as (select x.c as col_name, x.s as col_stat, max(x.v) filter (year = '1996') as a, max(x.v) filter (year = '1997') as b, max(x.v) filter (year = '1998') as c from pr group by 1, 2),
t as (select a as ta, b as tb, c as tc from w where col_stat = 'count_全量'),
g as (select w.*, case when col_stat like 'count_%' and col_stat <> 'count_全量' then
    (case when a = 0 then '0' when a = ta then '1' else 'x' end) || (case when b = 0 then '0' when b = tb then '1' else 'x' end) || (case when c = 0 then '0' when c = tc then '1' else 'x' end) else '' end as signature,
    (a + b + c) / 3 as m from w, t),
h as (select *, sqrt(((a-m)*(a-m) + (b-m)*(b-m) + (c-m)*(c-m)) / 2) as sd from g)
select col_name, col_stat, round(a, 4) as v_1996, round(b, 4) as v_1997, round(c, 4) as v_1998, signature, round(m, 4) as exam_mean, round(case when m = 0 then 0 else sd / m end, 6) as exam_sep,
    case when signature = '111' then 'all 1' when signature = '000' then 'all 0' when signature not in ('', 'xxx') then 'different' when (case when m = 0 then 0 else sd / m end) > 0.1 then 'large difference' else '' end as exam_result
from h""")
def q35_profile_horizontal(spark, d):
    out = profile_table.profile_comparison(order_profile(spark, d), period="year", periods=["1996", "1997", "1998"])
    return rounded(rounded(out.drop("exam_std"), "v_1996", "v_1997", "v_1998", "exam_mean", digits=4), "exam_sep")


def labelled_orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.date_format("o_orderdate", "yyyy").alias("year"), "o_totalprice", F.when(F.col("o_totalprice") > 250000, "1").otherwise("0").alias("y"))


WOE_SQL = """
lo as (select o_orderkey, o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y') as year, case when o_totalprice > 250000 then 1 else 0 end as y from orders),
lg as (select 'o_orderstatus' as col, o_orderstatus as v, y from lo union all select 'o_orderpriority', o_orderpriority, y from lo union all select 'year', year, y from lo),
c as (select col, v, greatest(sum(y), 1) as p, greatest(count(*) - sum(y), 1) as n from lg group by 1, 2),
w as (select col, v, cast(p as bigint) as n_pos, cast(n as bigint) as n_neg, ln((p / sum(p) over (partition by col)) / (n / sum(n) over (partition by col))) as woe, p / sum(p) over (partition by col) - n / sum(n) over (partition by col) as dif from c)"""


def order_woe(spark, d) -> DataFrame:
    return stats.woe_iv(stats.crosstab(labelled_orders(spark, d), ["o_orderstatus", "o_orderpriority", "year"], "y", "1", "0"))


@query(f"with {WOE_SQL} select col, v, n_pos, n_neg, round(woe, 6) as woe, round(dif * woe, 9) as iv_part from w")
def q36_woe_iv(spark, d):
    return rounded(rounded(order_woe(spark, d), "woe"), "iv_part", digits=9)


@query(f"""with {WOE_SQL}, s as (select *, sign(woe - lag(woe) over (partition by col order by v)) as g from w), t as (select *, case when g * lag(g) over (partition by col order by v) < 0 then 1 else 0 end as u from s)
select col, round(sum(dif * woe), 9) as iv, count(*) as n_values, cast(sum(u) as bigint) as turns from t group by 1""")
def q37_iv_ranking(spark, d):
    return rounded(stats.information_values(order_woe(spark, d)), "iv", digits=9)


PSI_ORDERS = """
o as (select v, greatest(n, 1) as n from (select o_orderpriority as v, count(*) as n from orders where year(o_orderdate) = 1996 group by 1)),
n as (select v, greatest(n, 1) as n from (select o_orderpriority as v, count(*) as n from orders where year(o_orderdate) = 1997 group by 1)),
j as (select v, coalesce(o.n, 1) as a, coalesce(n.n, 1) as b from o full join n using (v)), r as (select v, a, b, a / sum(a) over () as ra, b / sum(b) over () as rb from j)"""


@query(f"with {PSI_ORDERS} select v, a as n_old, b as n_new, round((rb - ra) * ln(rb / ra), 9) as psi_part from r")
def q38_psi_two_periods(spark, d):
    o = labelled_orders(spark, d)
    counts = lambda y: o.where(F.col("year") == y).groupBy(F.col("o_orderpriority").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(stats.psi_parts(counts("1996"), counts("1997")).select("v", "n_old", "n_new", "psi_part"), "psi_part", digits=9)


@query("""with l as (select l_returnflag, l_linestatus, year(l_shipdate) as yr, case when l_discount > 0.05 then '1' else '0' end as y from lineitem where year(l_shipdate) in (1996, 1997)),
g as (select 'l_returnflag' as col, y, yr, l_returnflag as v from l union all select 'l_linestatus', y, yr, l_linestatus from l),
c as (select col, y, v, greatest(1, count(*) filter (yr = 1996)) as a, greatest(1, count(*) filter (yr = 1997)) as b from g group by 1, 2, 3),
r as (select col, y, a / sum(a) over (partition by col, y) as ra, b / sum(b) over (partition by col, y) as rb from c)
select col, round(max(p), 9) as psi from (select col, y, sum((rb - ra) * ln(rb / ra)) as p from r group by 1, 2) group by 1""")
def q39_psi_by_class(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("yr"), F.when(F.col("l_discount") > 0.05, "1").otherwise("0").alias("y"))
    return rounded(stats.psi_by_class(rows.where("yr = 1996"), rows.where("yr = 1997"), ["l_returnflag", "l_linestatus"], "y", ["1", "0"]), "psi", digits=9)


@query("""select unnest([{'a': 'l_quantity', 'b': 'l_extendedprice', 'r': round(corr(l_quantity, l_extendedprice), 6)}, {'a': 'l_quantity', 'b': 'l_discount', 'r': round(corr(l_quantity, l_discount), 6)},
{'a': 'l_extendedprice', 'b': 'l_discount', 'r': round(corr(l_extendedprice, l_discount), 6)}], recursive := true) from lineitem""")
def q40_corr_pairs(spark, d):
    return rounded(stats.correlations(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), "r")


@query()
def q41_corr_greedy(spark, d):
    p = table(spark, d, "part").select(F.col("p_retailprice").alias("a"), (F.col("p_retailprice") * 2 + F.col("p_size")).alias("b"), F.col("p_size").alias("c"), (F.col("p_partkey") + F.col("p_size") * 3).alias("d"))
    pairs = [tuple(r) for r in stats.correlations(p, ["a", "b", "c", "d"]).collect()]
    gone = stats.drop_correlated(pairs, {"a": 0.4, "b": 0.3, "c": 0.2, "d": 0.1}, 0.8)
    return spark.createDataFrame([(x, x in gone) for x in "abcd"], "col string, dropped boolean")


@query("""with q as (select quantile_cont(o_totalprice, [0.0, 0.25, 0.5, 0.75, 1.0]) as q from orders where year(o_orderdate) = 1996),
b as (select year(o_orderdate) as y, case when o_totalprice < q[1] * 0.8 or o_totalprice > q[5] * 1.2 then null when o_totalprice <= q[2] then 0 when o_totalprice <= q[3] then 1 when o_totalprice <= q[4] then 2 else 3 end as v from orders, q where year(o_orderdate) in (1996, 1997)),
c as (select v, count(*) filter (y = 1996) as a, count(*) filter (y = 1997) as b from b where v is not null group by 1)
select v, round(a / sum(a) over (), 6) as r_old, round(b / sum(b) over (), 6) as r_new, abs(a / sum(a) over () - b / sum(b) over ()) > 0.01 as moved from c""")
def q42_drift_compare(spark, d):
    o = labelled_orders(spark, d)
    return rounded(stats.quartile_drift(o.where("year = '1996'"), o.where("year = '1997'"), "o_totalprice", 0.01), "r_old", "r_new")


# --- preparation

def fitted_rows(spark, steps: list[prep.Fitted]) -> DataFrame:
    rows = [(s.kind, c, v) for s in steps for c, v in [*((c, "dropped") for c in s.dropped), *((c, ",".join(r["values"])) for c, r in s.rules.items())]]
    return spark.createDataFrame(rows, "kind string, col string, v string")


@query("""with m as (select p_name as v, count(*) as n from part group by 1), b as (select p_brand as v, count(*) as n from part group by 1), t as (select p_type as v, count(*) as n from part group by 1), a as (select count(*) as rows from part)
select 'drop' as kind, 'one' as col, 'dropped' as v union all
select 'drop', 'p_name', 'dropped' where (select count(*) from m) >= 10 or (select max(n) from m) <= (select rows from a) // 30 or (select max(n) from m) / (select rows from a) >= 0.95 union all
select 'drop', 'p_brand', 'dropped' where (select count(*) from b) >= 10 or (select max(n) from b) <= (select rows from a) // 30 union all
select 'drop', 'p_type', 'dropped' where (select count(*) from t) >= 10 or (select max(n) from t) <= (select rows from a) // 30 union all
select 'merge', 'p_type', string_agg(v, ',' order by v) from t where n <= (select rows from a) // 6 and (select count(*) from t) < 10 having count(*) > 0 and (select max(n) from t) > (select rows from a) // 6""")
def q43_prefilter_stats(spark, d):
    p = table(spark, d, "part").select("p_name", "p_brand", "p_type", F.lit("x").alias("one"))
    n = p.count()
    drop, _ = prep.fit_prefilter(p, [], ["p_name", "p_brand", "p_type", "one"], unique_limit=10, valuecount_limit=n // 30)
    _, merge = prep.fit_prefilter(p.select("p_type"), [], ["p_type"], unique_limit=10, valuecount_limit=n // 6)
    return fitted_rows(spark, [drop, merge])


@query()
def q44_mdlp_bins(spark, d):
    o = labelled_orders(spark, d).withColumn("x", F.col("o_totalprice") + F.pmod(F.col("o_orderkey") * 7919, F.lit(80000)))
    step = prep.fit_mdlp(o, ["x"], "y", "1", "0")
    return step.apply(o).groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == "1").alias("n_pos"))


@query("""with k as (select o_orderpriority as v, count(*) as n from orders where year(o_orderdate) = 1996 and o_orderpriority <> '5-LOW' group by 1), m as (select v from k order by n desc, v limit 1)
select o_orderkey, case when o_orderpriority in (select v from k) then o_orderpriority else (select v from m) end as o_orderpriority from orders""")
def q45_newvalue_mode(spark, d):
    o = labelled_orders(spark, d).select("o_orderkey", "year", "o_orderpriority")
    return prep.fit_unseen(o.where("year = '1996' and o_orderpriority <> '5-LOW'"), ["o_orderpriority"]).apply(o).drop("year")


@query("""with t as (select info_id, cast(arpu_teamadd as double) as a, cast(data_flux_teamadd as double) as b, sex_teamzk as s, sig_offer_spec_name_teamzk as o from dm_zc_yw_moxing_team_info_m),
m as (select avg(arpu_teamadd) as ma, quantile_cont(b, 0.5) as mb from t join dm_zc_yw_moxing_team_info_m using (info_id)), f as (select s from t where s is not null group by 1 order by count(*) desc, s limit 1)
select info_id, cast(a is null as integer) as missing__a, round(coalesce(a, ma), 4) as a, round(coalesce(b, mb), 4) as b, coalesce(s, (select s from f)) as s, coalesce(o, 'unknown') as o from t, m""")
def q46_impute(spark, d):
    t = table(spark, d, INFO).select("info_id", F.col("arpu_teamadd").alias("a"), F.col("data_flux_teamadd").cast("double").alias("b"), F.col("sex_teamzk").alias("s"), F.col("sig_offer_spec_name_teamzk").alias("o"))
    mean = float(t.agg(F.avg("a")).first()[0])
    t = t.withColumn("a", F.col("a").cast("double"))
    steps = [prep.fit_indicator(["a"]), prep.fit_impute(t, ["a"], "constant", mean), prep.fit_impute(t, ["b"], "median"), prep.fit_impute(t, ["s"], "most_frequent"), prep.fit_impute(t, ["o"], "constant", "unknown")]
    return rounded(prep.apply_all(steps, t), "a", "b", digits=4)


@query("""with c as (select p_brand as v, count(*) as n, count(*) over () as k from part group by 1), r as (select *, row_number() over (order by n, v) as r, sum(case when n < least(100, (select count(*) from part) // 50) then 1 else 0 end) over () as few from c)
select p_partkey, case when p_brand in (select v from r where r <= greatest(k - 10 + 1, few)) then '其他_countlow' else p_brand end as p_brand from part""")
def q47_value_converter(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_brand")
    return prep.fit_value_converter(p, ["p_brand"], bin_limit=10).apply(p)


@query("""with q as (select quantile_cont(o_totalprice, 0.25) as a, quantile_cont(o_totalprice, 0.75) as b from orders), l as (select a - 0.5 * (b - a) as lo, b + 0.5 * (b - a) as hi from q)
select o_orderkey, round(greatest(lo, least(hi, o_totalprice)), 4) as o_totalprice, o_totalprice between lo and hi as kept from orders, l""")
def q48_outlier_iqr(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    step = prep.fit_outliers(o, ["o_totalprice"], k=0.5)
    kept = prep.drop_outliers(o, step).select("o_orderkey", F.lit(True).alias("kept"))
    return rounded(step.apply(o).join(kept, "o_orderkey", "left").withColumn("kept", F.coalesce("kept", F.lit(False))), "o_totalprice", digits=4)


@query("select c_custkey, round((c_acctbal - avg(c_acctbal) over ()) / stddev_pop(c_acctbal) over (), 6) as z, round((c_acctbal - min(c_acctbal) over ()) / (max(c_acctbal) over () - min(c_acctbal) over ()), 6) as u from customer")
def q49_scale(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("z"), F.col("c_acctbal").alias("u"))
    return rounded(prep.apply_all([prep.fit_scale(c, ["z"]), prep.fit_scale(c, ["u"], "minmax")], c), "z", "u")


# --- evaluation, scores, monitoring

SCORED = "sc as (select o_orderkey, (o_orderkey * 7919 % 1000) / 10.0::double as score, o_orderstatus as y from orders)"
EVAL = """
b as (select i, t, (select count(*) from sc where score >= t and y = 'F') as cp, (select count(*) from sc where score >= t and y in ('O', 'P')) as cn from th),
e as (select *, cp - coalesce(lag(cp) over (order by i), 0) as p, cn - coalesce(lag(cn) over (order by i), 0) as n, max(cp) over () as tp, max(cn) over () as tn from b)
select i as band, round(t, 6) as threshold, p as n_pos, n as n_neg, cp as cum_pos, cn as cum_neg, round((p + n) / (tp + tn), 6) as share, round((cp + cn) / (tp + tn), 6) as cum_share, round(p / nullif(p + n, 0), 6) as precision,
    round(cp / nullif(cp + cn, 0), 6) as cum_precision, round(p / nullif(tp, 0), 6) as recall, round(cp / nullif(tp, 0), 6) as cum_recall from e"""


def scored_orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", (F.pmod(F.col("o_orderkey") * 7919, F.lit(1000)) / F.lit(10.0)).alias("score"), F.col("o_orderstatus").alias("y"))


def evaluated(spark, d, thresholds) -> DataFrame:
    out = evaluate.evaluation(scored_orders(spark, d), score="score", label="y", positive="F", negative="O", thresholds=thresholds)
    return rounded(out.drop("lift", "cum_lift"), "threshold", "share", "cum_share", "precision", "cum_precision", "recall", "cum_recall")


@query(f"with {SCORED}, th as (select cast(row_number() over (order by p) - 1 as integer) as i, (select quantile_cont(score, 1 - p) from sc) as t from (select unnest([0.01, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) as p)),".replace("(select quantile_cont(score, 1 - p) from sc)", "(select list_extract(quantile_cont(score, [0.99, 0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.0]), row_number() over (order by p)) from sc)").replace("(select list_extract(", "list_extract((select ").replace("0.0]), row_number() over (order by p)) from sc)", "0.0]) from sc), row_number() over (order by p))") + EVAL)
def q50_lift_table_pop(spark, d):
    return evaluated(spark, d, evaluate.score_thresholds(scored_orders(spark, d), "score"))


@query(f"with {SCORED}, th as (select cast(row_number() over (order by t desc) - 1 as integer) as i, cast(t as double) as t from (select unnest([90, 80, 70, 60, 50, 40, 30, 20, 10, 0]) as t)),{EVAL}")
def q51_lift_table_grades(spark, d):
    return evaluated(spark, d, evaluate.GRADES)


@query(f"""with {SCORED}, c as (select score, count(*) filter (y = 'F') as p, count(*) filter (y = 'O') as n from sc where y in ('F', 'O') group by 1),
u as (select *, sum(p) over (order by score) as cp, sum(n) over (order by score) as cn, sum(p) over () as tp, sum(n) over () as tn from c)
select round(max(abs(cp / tp - cn / tn)), 6) as ks, round(sum(p * (cn - n + n / 2)) / (max(tp) * max(tn)), 6) as auc from u""")
def q52_ks_auc(spark, d):
    return rounded(stats.ks_auc(scored_orders(spark, d), "score", "y", "F", "O"), "ks", "auc")


@query(f"with {SCORED}, b as (select case when score <= 10 then 0 else cast(ceil(score / 10) - 1 as integer) end as v, count(*) as n from sc group by 1) select v, n, round(n / sum(n) over (), 6) as share from b")
def q53_score_bands(spark, d):
    n = stats.band_counts(scored_orders(spark, d), "score", list(range(0, 101, 10)))
    return rounded(n.join(F.broadcast(n.agg(F.sum("n").alias("a")))).select("v", "n", (F.col("n") / F.col("a")).alias("share")), "share")


@query("""with r as (select c_custkey, row_number() over (order by c_acctbal desc, c_custkey) as score_rank, count(*) over () as n from customer)
select c_custkey, score_rank, cast(greatest(1, ((n - score_rank) * 100 + n - 2) // (n - 1)) as integer) as score_level from r""")
def q54_rank_levels(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("score"))
    return score.ranked(c, ties=[("c_custkey", True)]).drop("score")


@query(f"""with {WOE_SQL}, k as (select o_orderkey, x.col, x.v, x.o from (select o_orderkey, unnest([{{'col': 'o_orderstatus', 'v': o_orderstatus, 'o': 0}}, {{'col': 'o_orderpriority', 'v': o_orderpriority, 'o': 1}}, {{'col': 'year', 'v': year, 'o': 2}}]) as x from lo)),
r as (select o_orderkey, k.col, k.v, woe, row_number() over (partition by o_orderkey order by woe desc, o) as r from k join w on k.col = w.col and k.v = w.v)
select o_orderkey, max(col) filter (r = 1 and woe > 0) as colname_top1, max(v) filter (r = 1 and woe > 0) as colvalue_top1, round(max(woe) filter (r = 1 and woe > 0), 6) as colwoe_top1,
    max(col) filter (r = 2 and woe > 0) as colname_top2, max(v) filter (r = 2 and woe > 0) as colvalue_top2, round(max(woe) filter (r = 2 and woe > 0), 6) as colwoe_top2 from r group by 1""")
def q55_top_reasons(spark, d):
    woe: dict[str, dict[str, float]] = {c: {} for c in ("o_orderstatus", "o_orderpriority", "year")}
    for r in order_woe(spark, d).collect():  # a row per value of three short columns
        woe[r.col][r.v] = r.woe
    out = score.top_reasons(labelled_orders(spark, d).select("o_orderkey", *woe), woe, n=2)
    return rounded(out.drop(*woe, "colcomment_top1", "colcomment_top2"), "colwoe_top1", "colwoe_top2")


@query("""with u as (select c_custkey as id, 'a' as model, c_acctbal as s, cast(c_nationkey as double) as w from customer union all select s_suppkey, 'b', s_acctbal, s_nationkey from supplier),
x as (select *, 0.7::double * (s - min(s) over ()) / (max(s) over () - min(s) over ()) + (w - min(w) over ()) / (max(w) over () - min(w) over ()) as t from u)
select id, model, round(100 * ((t - min(t) over ()) / (max(t) over () - min(t) over ())), 2) as model_level from x""")
def q56_combine_models(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("a").alias("model"), F.col("c_acctbal").alias("s"), F.col("c_nationkey").cast("double").alias("w"))
    b = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("b").alias("model"), F.col("s_acctbal").alias("s"), F.col("s_nationkey").cast("double").alias("w"))
    return score.combined([a, b], {"s": 0.7, "w": None}, front=["id"]).select("id", "model", "model_level")


@query("""with l as (select user_no, flag_lw, flag_ls, acct_month from tablename_cre_kdteam_target)
select s.score_id, s.model_name, '202404' as ymonth, cast(date_diff('month', strptime(s.acct_month || '01', '%Y%m%d'), date '2024-04-01') as integer) as stat_batch, 'flag_lw' as col_flag, l.flag_lw as flag_value
from table_score_flag_month s left join (select * from l where acct_month = '202403') l using (user_no) where s.model_name = '离网识别_甲' and s.acct_month in ('202403', '202402')
union all
select s.score_id, s.model_name, '202404', cast(date_diff('month', strptime(s.acct_month || '01', '%Y%m%d'), date '2024-04-01') as integer), 'flag_ls', l.flag_ls
from table_score_flag_month s left join (select * from l where acct_month = '202402') l using (user_no) where s.model_name = '副卡意向' and s.acct_month in ('202402', '202401')""")
def q57_monitor_join(spark, d):
    s = table(spark, d, SCORE).select("score_id", "model_name", "acct_month", "user_no")
    out = monitor.followed(s, table(spark, d, TARGET), {"离网识别_甲": ("flag_lw", 1), "副卡意向": ("flag_ls", 2)}, perform="202404", n=2, period="acct_month", entity="user_no")
    return out.select("score_id", "model_name", "ymonth", "stat_batch", "col_flag", "flag_value")


@query(f"""with s as (select score_id, {S.trimmed('model_name')} as model_name, {S.six('acct_month')} as m, {S.key('user_no')} as k, col_flag from table_score_flag_month),
f as (select model_name, case when model_name = '副卡意向' then 'flag_ls' else min({S.trimmed('col_flag')}) end as col_flag, case when model_name = '副卡意向' then ['202402', '202401'] else ['202403', '202402'] end as months from s where model_name is not null group by 1),
t as (select {S.key('user_no')} as k, {S.MONTH} as m, flag_lw, flag_notacct, flag_badstatus, flag_ls, load_time, target_id from tablename_cre_kdteam_target),
l as (select * from (select *, row_number() over (partition by k, m order by load_time desc nulls last, target_id) as rn from t where k is not null and m is not null) where rn = 1)
select s.score_id, s.model_name, '202404' as ymonth, cast(date_diff('month', strptime(s.m || '01', '%Y%m%d'), date '2024-04-01') as integer) as stat_batch, f.col_flag,
    case f.col_flag when 'flag_lw' then flag_lw when 'flag_notacct' then flag_notacct when 'flag_badstatus' then flag_badstatus when 'flag_ls' then flag_ls end as flag_value
from s join f using (model_name) left join l on s.k = l.k and l.m = f.months[1] where list_contains(f.months, s.m)""")
def q57_monitor_all_models(spark, d):
    """All models, by the tables' conventions: normal forms of model, month and key, the latest delivery of a label. A label that the target table lacks is null."""
    t, y = table(spark, d, SCORE), table(spark, d, TARGET)
    s = written(t.select("score_id", trimmed(F.col("model_name")).alias("model_name"), month_of(F.col("acct_month")).alias("month"), entity_key(F.col("user_no")).alias("k"), trimmed(F.col("col_flag")).alias("own_flag")), "followed-scores")
    models = {r.model_name: (r.f, 1) for r in s.where("model_name is not null").groupBy("model_name").agg(F.min("own_flag").alias("f")).collect()} | {"副卡意向": ("flag_ls", 2)}  # a row per model
    flags = ["flag_lw", "flag_notacct", "flag_badstatus", "flag_ls"]
    rows = y.select(entity_key(F.col("user_no")).alias("key"), month_of(F.col("month_id"), F.col("acct_month")).alias("month"), "load_time", "target_id", *flags)
    latest = latest_states(rows, key="key", period="month", known_at="load_time", row_id="target_id", attrs=flags)
    lacking = sorted({f for f, _ in models.values()} - set(flags))
    labelled = written(latest.select("k", F.col("m").alias("month"), *(F.col(f"a{i}").alias(c) for i, c in enumerate(flags)), *(F.lit(None).cast("int").alias(c) for c in lacking)), "followed-labels")
    out = monitor.followed(s, labelled, models, perform="202404", n=2, period="month", entity="k")
    return out.select("score_id", "model_name", "ymonth", "stat_batch", "col_flag", "flag_value")


@query("""with r as (select trim(model_name) as m, stat_batch as b, exe_sam as e, score, flag_value as y from table_score_flag_month where score between 0 and 1 and not isnan(score) and flag_value is not null),
g as (select m, b, e, count(*) as n, count(*) filter (y = 1) as np, quantile_cont(score, 0.8) as t2, quantile_cont(score, 0.6) as t4 from r group by 1, 2, 3),
x as (select g.m, g.b, g.e, g.n, np, t, share, count(*) as cn, count(*) filter (y = 1) as cp from (select *, t2 as t, 0.2 as share from g union all select *, t4, 0.4 from g) g
    join r on r.m is not distinct from g.m and r.b is not distinct from g.b and r.e is not distinct from g.e and r.score >= t - 1e-12 group by all)
select m as model_name, b as stat_batch, e as exe_sam, cast(share as double) as share, n, np as n_pos, cn as cum_n, cp as cum_pos, round(cp / cn, 6) as cum_precision, round(cp / nullif(np, 0), 6) as cum_recall from x""")
def q58_monitor_report(spark, d):
    s = table(spark, d, SCORE).where("score between 0 and 1").withColumn("model_name", trimmed(F.col("model_name")))
    out = monitor.monitor_report(s.select("model_name", "stat_batch", "exe_sam", "score", "flag_value"))
    return rounded(out.drop("rate", "cum_lift"), "cum_precision", "cum_recall")


@query("select count(*) as n from events where strftime(ts, '%Y%m%d') = '20240115'")
def q59_day_readiness(spark, d):
    e = table(spark, d, "events").select(F.date_format("ts", "yyyyMMdd").alias("day"))
    return spark.createDataFrame([(panel.day_ready(e, at="202312", day_column="day", day=15),)], "n long")


@query()
def q60_bin_cleanup(spark, d):
    o = labelled_orders(spark, d).withColumn("b", F.floor(F.col("o_totalprice") / 20000).cast("int"))
    counts = o.groupBy("b").agg(F.count_if(F.col("o_orderstatus") == "F").alias("p"), F.count_if(F.col("o_orderstatus") != "F").alias("n")).orderBy("b").collect()
    bins = report.clean_bins([report.Bin(float(r.b), float(r.b + 1), r.p, r.n) for r in counts])
    return spark.createDataFrame([(b.lo, b.hi, b.n_pos, b.n_neg) for b in bins], "lo double, hi double, n_pos long, n_neg long")


@query("""with d as (select distinct user_id, date_diff('day', date '2024-01-01', cast(ts as date)) as d from events), g as (select *, d - row_number() over (partition by user_id order by d) as g from d),
r as (select user_id, g, min(d) as s, max(d) as e, count(*) as n from g group by 1, 2)
select user_id, cast(max_by(s, e) as integer) as run_start, cast(max(e) as integer) as run_end, max_by(n, e) as run_length from r group by 1""")
def q61_gaps_islands(spark, d):
    e = table(spark, d, "events").select("user_id", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("d"))
    return latest_runs(e, entity="user_id", day_number="d")


@query()
def q62_train_score_small(spark, d):
    from minespark.operators import model

    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("size"), "p_retailprice", "p_type", F.when((F.col("p_size") > 25) & (F.pmod(F.col("p_partkey") * 7919, F.lit(10)) < 8), "1").otherwise("0").alias("y"))
    steps = model.fit_pipeline(p, ["size", "p_retailprice"], ["p_type"], "y", "1", "0", kind="scaled", valuecount_limit=5)
    trained = model.train_one(p, steps, next(iter(model.grid("logistic", {"regParam": [0.01]}).values())), "logistic", ["size", "p_retailprice", "p_type"], ("y", "1", "0"))
    return trained.score(p).select("p_partkey", "score")


@query("""with w as (select date_trunc('day', ts) as start, case when value < 0 or value > 600 then null when value <= 10 then 0 when value <= 50 then 1 when value <= 100 then 2 else 3 end as v, count(*) as n from events group by 1, 2),
b as (select unnest([0, 1, 2, 3]) as v, unnest([40, 30, 20, 10]) as b), x as (select s.start, b.v, greatest(1, coalesce(n, 0)) as n, b / 100 as r0 from (select distinct start from w where v is not null) s cross join b left join (select * from w where v is not null) w on w.start = s.start and w.v = b.v),
r as (select start, n / sum(n) over (partition by start) as r, r0 from x)
select strftime(start, '%Y%m%d') as day, round(sum((r - r0) * ln(r / r0)), 6) as psi from r group by 1""")
def q63_window_psi(spark, d):
    counts = drift.window_counts(table(spark, d, "events"), time="ts", value="value", edges=[0, 10, 50, 100, 600])
    out = drift.window_psi(counts, [(0, 40), (1, 30), (2, 20), (3, 10)])
    return rounded(out.select(F.date_format("start", "yyyyMMdd").alias("day"), "psi"), "psi")
