"""Queries over sources, catalog, specifications, samples, screening and reports, each beside its SQL; they join those of survey."""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minespark.functions import arithmetic, formula, normal, predicates, texts
from minespark.functions.periods import add_months, month_add, month_days, month_list
from minespark.logs import LogStore, run_jobs
from minespark.operators import evaluate, features, panel, prep, profile_table, ranking, report, rollup, sampling, score, stats
from minespark.plans import explore
from minespark.plans import problem_sql as S
from minespark.plans.problems import INFO, SCORE, TARGET
from minespark.plans.survey import EVAL, OM, ORACLE, PAD, SCORED, WOE_SQL, customer_months, labelled_orders, order_woe, padded, query, rounded, scored_orders, table, ym
from minespark.runtime import temporary, written
from minespark.sources import catalog, io
from minespark.spec import CATEGORY, NUMBER, FieldSpec, ModelSpec, field_use, model_specs, read_infos, table_columns, text_to_frame

log = logging.getLogger("minespark")


# --- sources and sinks

@query("select c_custkey, c_acctbal, c_mktsegment from customer where c_acctbal > 0")
def q64_csv_scan(spark, d):
    path = temporary(spark, "csv")
    io.save_data(table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path, fmt="csv")
    schema = "C_CUSTKEY long, C_NAME string, C_ACCTBAL string, C_MKTSEGMENT string"
    return io.read_data(spark, path, fmt="csv", schema=schema, condition="cast(c_acctbal as double) > 0", leave=["c_name"], numbers=["c_acctbal"], bad_numbers="error")


@query("""with o as (select year(o_orderdate) as year, cast(o_totalprice as decimal(18,2)) as x from orders)
select year, count(*) as n, cast(sum(case when year = 1996 then 2 * x else x end) as double) as total from o where year <> 1997 or x > 100000 group by 1""")
def q65_partition_overwrite(spark, d):
    """Orders by year; two years are written again, one doubled, one without its small orders."""
    o = table(spark, d, "orders").select(F.year("o_orderdate").cast("long").alias("year"), F.col("o_totalprice").cast("decimal(18,2)").alias("x"))
    path = temporary(spark, "orders")
    io.save_data(o, path, fmt="parquet", partition_by=["year"])
    again = o.where("year = 1996").select("year", (F.col("x") * 2).cast("decimal(18,2)").alias("x")).unionByName(o.where("year = 1997 and x > 100000"))
    io.overwrite_partitions(again, path, ["year"])
    return io.read_data(spark, path, fmt="parquet").groupBy(F.col("year").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum("x").cast("double").alias("total"))


@query("""with t as (select '199612' as m, * from orders where year(o_orderdate) = 1996 union all select '199712', * from orders where year(o_orderdate) = 1997),
n as (select m, count(*) as n from t group by 1)
select 'orders_' || m as name, n, 3 as k, stddev_samp(n) over () / avg(n) over () > 0.1 as uneven, m < '199712' as older from n""")
def q66_table_family(spark, d):
    """Two yearly tables by SQL statements: searched, described, compared, and dropped again."""
    db = f"family_{uuid.uuid4().hex}"
    spark.sql(f"create database {db} location '{temporary(spark, db)}'")
    try:
        o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("y"))
        for y in (1996, 1997):
            catalog.create_partitioned(spark, f"{db}.orders_{y}12", "o_orderkey bigint, o_custkey bigint, o_totalprice double, part int", ["part"])
            io.run_sql(spark, f"insert into {db}.orders_{y}12 select o_orderkey, o_custkey, o_totalprice, 1 from {{o}} where y = {y}; select 1", o=o)
        names = catalog.tables(spark, "orders_%", like=True, database=db)
        shape = catalog.family_shape(spark, names)
        older = catalog.intermediate_tables(spark, "orders", "199712", database=db)
        rows = [(n.split(".")[1], shape["tables"][n][0], len(catalog.table_fields(spark, n)), shape["uneven"], n in older) for n in names if catalog.partitions(spark, n) == ["part=1"]]
        catalog.drop_tables(spark, names)
        if catalog.tables(spark, "%", like=True, database=db):
            raise ValueError("tables are left")
    finally:
        spark.sql(f"drop database {db} cascade")
    return spark.createDataFrame(rows, "name string, n long, k int, uneven boolean, older boolean")


@query("select c_custkey as id, c_mktsegment as seg, c_acctbal as bal from customer union all select s_suppkey, null, s_acctbal from supplier")
def q67_append_aligned(spark, d):
    db = f"append_{uuid.uuid4().hex}"
    spark.sql(f"create database {db} location '{temporary(spark, db)}'")
    try:
        io.save_data(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal")), f"{db}.parties")
        io.save_data(table(spark, d, "supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_suppkey").alias("id")), f"{db}.parties", if_exists="append")
        return written(spark.table(f"{db}.parties"), "parties")
    finally:
        spark.sql(f"drop database {db} cascade")


WEIGHTS = "segment\tweight\tnote\t\nBUILDING\t1.5\tnan\tx\nMACHINERY\t2\t'it''s'\t\nFURNITURE\tNone\tb"


@query("""with w as (select * from (values ('BUILDING', 1.5, null), ('MACHINERY', 2, '''it''''s'''), ('FURNITURE', null, 'b')) t(segment, weight, note))
select c_custkey, c_mktsegment, cast(weight as double) as weight, note from customer left join w on segment = c_mktsegment""")
def q68_text_table(spark, d):
    w = text_to_frame(spark, WEIGHTS, {"weight": "double"})
    return table(spark, d, "customer").join(F.broadcast(w), F.col("segment") == F.col("c_mktsegment"), "left").select("c_custkey", "c_mktsegment", "weight", "note")


STATIC = "model_name\tshort_name\tlabel\tpositive\tbase_condition\nopen\to\to_orderstatus\tO\to_custkey > 10 and o_orderpriority <> '5-LOW'\nbig\tb\to_totalprice\t1\t\n#old\tx\ty\t1\t"
DYNAMIC = "model_name\tmonth_train\tcondition\tn_recent\nopen\t199605\t['o_totalprice > 100000']\t2\nbig\t199612\t[]\t3"


@query("""select 'open' as name, 'out/o/model_199605' as path, 2 as n_recent, count(*) as n from orders where o_totalprice > 100000 and o_custkey > 10 and o_orderpriority <> '5-LOW' and strftime(o_orderdate, '%Y%m') between '199604' and '199605'
union all select 'big', 'out/b/model_199612', 3, count(*) from orders where strftime(o_orderdate, '%Y%m') between '199610' and '199612'""")
def q69_model_infos(spark, d):
    """Static and dynamic text of two models: their specifications, where their results go, and the rows that each reads."""
    specs = model_specs(read_infos(STATIC), read_infos(DYNAMIC, literal=["condition"], typed=["n_recent"]))
    o = table(spark, d, "orders").withColumn("m", ym("o_orderdate"))
    parts = [
        predicates.where(o.where(F.col("m").isin(month_list(s.month_train, periods=-s.n_recent))), s.condition).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), F.lit(s.path("model")).alias("path"), F.lit(s.n_recent).alias("n_recent"), "n")
        for n, s in specs.items()
    ]
    return panel.union_all(parts)


@query("select c_custkey, c_mktsegment from customer where c_mktsegment || '''s' in ('BUILDING''s', 'MACHINERY''s') and c_acctbal > -100.5")
def q70_literals(spark, d):
    values = ", ".join(map(io.sql_literal, ["BUILDING's", "MACHINERY's"]))
    text = f"select c_custkey, c_mktsegment from {{c}} where concat(c_mktsegment, {io.sql_literal(chr(39) + 's')}) in ({values}) and c_acctbal > {io.sql_literal(-100.5)}"
    return io.run_sql(spark, io.sql_text(text), c=table(spark, d, "customer"))


@query("select 'seg=' || c_mktsegment as folder, 1 as n_files, count(*) as n from customer where c_mktsegment <> 'BUILDING' group by 1")
def q71_files(spark, d):
    """A file for each segment; one is deleted, the others are listed and read."""
    path = temporary(spark, "segments")
    table(spark, d, "customer").withColumn("seg", F.col("c_mktsegment")).repartition(1).write.partitionBy("seg").parquet(path)
    catalog.delete_files(catalog.select_files(f"{path}/seg=BUILDING", r"\.parquet$"), really=True)
    folders = [p.split("/")[-2] for p in catalog.select_files(path, r"^part-.*\.parquet$", newest_of_folder=True)]
    counts = spark.read.schema("c_custkey long, seg string").parquet(path).groupBy(F.concat(F.lit("seg="), "seg").alias("folder")).agg(F.count(F.lit(1)).alias("n"))
    return counts.join(spark.createDataFrame([(f, folders.count(f)) for f in sorted(set(folders))], "folder string, n_files int"), "folder")


@query("""select 'customer' as job, 'INFO' as level, 'customer: ' || count(*) || ' rows' as text, 'succeed' as said from customer
union all select 'orders', 'INFO', 'orders: ' || count(*) || ' rows', 'succeed' from orders union all select 'none', 'ERROR', 'none: no table', 'ValueError: no table'""")
def q72_jobs_and_log(spark, d):
    def count(name):
        if name == "none":
            raise ValueError("no table")
        log.info("%s: %d rows", name, table(spark, d, name).count())

    stores = {n: LogStore(n) for n in ("customer", "orders", "none")}
    said = {}
    for n, store in stores.items():
        with store:
            said |= run_jobs(spark, {n: lambda n=n: count(n)})
    lines = panel.union_all([s.frame(spark) for s in stores.values()]).drop("at")
    return lines.join(spark.createDataFrame(list(said.items()), "job string, said string"), "job")


# --- predicates and lineage

@query("select o_orderkey, o_totalprice, o_orderstatus, o_orderpriority from orders where o_totalprice > 100000 and (o_orderstatus in ('F', 'O') or o_orderpriority like '1-%') and not o_orderpriority = '5-LOW'")
def q73_conditions(spark, d):
    """A condition of several parts, without those that need a day's data; the columns it mentions are those that are read."""
    condition = ["o_totalprice > 100000 and dayvalue_flux > 3", "(o_orderstatus in ('F', 'O') or o_orderpriority like '1-%')", "", "not o_orderpriority = '5-LOW'"]
    kept, dropped = predicates.without_columns(condition, "dayvalue_")
    if dropped != ["dayvalue_flux > 3"]:
        raise ValueError(dropped)
    return predicates.where(table(spark, d, "orders").select("o_orderkey", *predicates.referenced_columns(kept)), kept)


@query(f"with om as ({OM}) select id, month, cast(x as double) as x, n, round(cast(x as double) / n, 6) as per, round(cast(x as double) / n + n, 6) as mix from om")
def q74_lineage(spark, d):
    """Fields for wanted wide columns: what can't be had is left out with all that is made of it, the rest is read and derived."""
    made = {n: formula.parse(n, f) for n, f in {"per": "x / n", "mix": "per + n", "bad": "z + x", "worse": "bad - x"}.items()}
    wanted = formula.without_unavailable(["mix", "worse", "per"], ["z"], made)
    need = formula.base_columns([f"avg__{w}" for w in wanted], made)
    rows = customer_months(spark, d).withColumn("x", F.col("x").cast("double")).select("id", "month", *need)
    return rounded(explore.with_formulas(rows, {n: made[n] for n in formula.closure(wanted, made) if n in made}, period="month", at="199801"), "per", "mix")


@query("select c_custkey, c_mktsegment, c_acctbal, 'unknown' as extra, 'unknown' as seg2 from customer")
def q75_pipeline_columns(spark, d):
    """Only what the steps need is read, what is missing comes as null and is imputed."""
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", F.lit("x").alias("one"))
    fill = prep.fit_impute(c, ["extra", "seg2", "c_mktsegment"], "constant", "unknown")
    steps = [prep.Fitted("drop", ("one",)), fill]
    need = prep.needed_columns(steps, ["c_custkey", "c_mktsegment", "c_acctbal", "one", "extra", "seg2"])
    return prep.apply_all([prep.find_step(steps, "drop"), prep.find_step(steps, "impute", -1)], prep.with_missing(c, need)).select(*need)


@query("select right(cast(o_orderkey as varchar), 1) as digit, count(*) as n from orders where right(cast(o_orderkey as varchar), 1) in ('1', '3', '7') group by 1")
def q76_shards(spark, d):
    o = table(spark, d, "orders")
    return o.where(predicates.shard(F.col("o_orderkey"), [1, 3, 7])).groupBy(F.right(F.col("o_orderkey").cast("string"), F.lit(1)).alias("digit")).agg(F.count(F.lit(1)).alias("n"))


@query("select c_custkey as user_no, c_acctbal as arpu, c_nationkey as area_teamzk, c_name as area from customer")
def q77_exported(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("zk_user_no"), F.col("c_acctbal").alias("arpu_teamzk"), F.col("c_nationkey").alias("area_teamzk"), F.col("c_name").alias("area"))
    return score.exported(c, renames={"zk_user_no": "user_no"})


# --- scalar families

@query(f"""select info_id, {S.key('zk_user_no')} as k, {S.MONTH} as m, {S.trimmed('area_no_teamzk')} as area, {S.flag('is_valid_teamzk')} as valid, left({S.trimmed('open_date_teamzk')}, 4) as opened,
    substr({S.trimmed('customer_no_teamzk')}, 2, 3) as part, coalesce({S.trimmed('sig_offer_spec_name_teamzk')} like '%5G%', false) as is_5g, lower({S.trimmed('sig_offer_spec_id_teamzk')}) as offer from dm_zc_yw_moxing_team_info_m""")
def q78_text_functions(spark, d):
    t = lambda c: normal.trimmed(F.col(c))
    return table(spark, d, INFO).select(
        "info_id", normal.entity_key(F.col("zk_user_no")).alias("k"), normal.month_of(F.col("month_id"), F.col("acct_month")).alias("m"), t("area_no_teamzk").alias("area"), normal.flag(F.col("is_valid_teamzk")).alias("valid"),
        F.left(t("open_date_teamzk"), F.lit(4)).alias("opened"), F.substring(t("customer_no_teamzk"), 2, 3).alias("part"), F.coalesce(t("sig_offer_spec_name_teamzk").like("%5G%"), F.lit(False)).alias("is_5g"), F.lower(t("sig_offer_spec_id_teamzk")).alias("offer"),
    )


@query("""with m as (select strftime(o_orderdate, '%Y%m') as month, count(*) as n from orders group by 1)
select month, strftime(strptime(month || '01', '%Y%m%d') + interval 5 month, '%Y%m') as later, strftime(strptime(month || '01', '%Y%m%d') - interval 14 month, '%Y%m') as earlier, day(last_day(strptime(month || '01', '%Y%m%d'))) as days, n
from m where month between '199511' and '199702'""")
def q79_month_arithmetic(spark, d):
    months = spark.createDataFrame([(m, month_add(m, -14)) for m in month_list("199511", "199702")], "month string, earlier string")
    n = table(spark, d, "orders").groupBy(ym("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(months), "month").select("month", add_months(F.col("month"), 5).alias("later"), "earlier", month_days(F.col("month")).cast("long").alias("days"), "n")


@query("""with c as (select l_returnflag, l_linestatus, count(*) filter (l_discount > 0.05) as n, count(*) as a from lineitem group by 1, 2)
select l_returnflag, l_linestatus, round(-(n / a) * ln(greatest(n / a, 1e-10)), 6) as e, round(abs(n - a / 2), 1) as off from c""")
def q80_guarded_log(spark, d):
    c = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count_if(F.col("l_discount") > 0.05).alias("n"), F.count(F.lit(1)).alias("a"))
    share = F.col("n") / F.col("a")
    return c.select("l_returnflag", "l_linestatus", F.round(-share * arithmetic.guarded_log(share), 6).alias("e"), F.round(F.abs(F.col("n") - F.col("a") / 2), 1).alias("off"))


@query("""with o as (select case when o_totalprice <= 100000 then '(0, 100000]' when o_totalprice <= 200000.5 then '(100000, 200000.5]' else '(200000.5, 10000000]' end as band, o_orderstatus from orders)
select band, case band when '(0, 100000]' then 0.0::double when '(100000, 200000.5]' then 100000.0::double else 200000.5::double end as lo, count(*) as n, printf('%.1f%%', round(100 * count(*) filter (o_orderstatus = 'F') / count(*), 1)) as rate,
    round(round(100 * count(*) filter (o_orderstatus = 'F') / count(*), 1) / 100, 6) as back from o group by 1""")
def q81_interval_and_percent_texts(spark, d):
    o = table(spark, d, "orders").select(texts.interval_of(F.col("o_totalprice"), [0, 100000, 200000.5, 10000000]).alias("band"), "o_orderstatus")
    out = o.groupBy("band").agg(F.count(F.lit(1)).alias("n"), texts.percent_text(F.count_if(F.col("o_orderstatus") == "F") / F.count(F.lit(1))).alias("rate"))
    return out.select("band", texts.lower_bound(F.col("band")).alias("lo"), "n", "rate", F.round(texts.percent_value(F.col("rate")), 6).alias("back"))


# --- aggregations

@query("""with c as (select strftime(o_orderdate, '%Y') as year, count(*) as n, count(*) filter (o_totalprice > 250000) as n_pos from orders group by 1), r as (select *, round(n_pos / n, 3) as rate from c), l as (select *, lag(rate) over (order by year) as before from r)
select year, n, n_pos, rate, case when before is not null then case when before = 0 then rate <> 0 else abs(rate - before) / before > 0.05 end end as moved from l""")
def q32_rate_check(spark, d):
    """Totals, positives and rate of each year, and whether the rate moved by more than 5 % against the year before."""
    o = labelled_orders(spark, d)
    rows, before = [], None
    for year in sorted(r[0] for r in o.select("year").distinct().collect()):  # a few years
        n, p, rate = rollup.case_counts(o.where(F.col("year") == year), F.col("y") == "1")
        rows.append((year, n, p, rate, None if before is None else rollup.rate_moved(before, rate)))
        before = rate
    return spark.createDataFrame(rows, "year string, n long, n_pos long, rate double, moved boolean")


FLAGS = ("flag_lw", "flag_notacct", "flag_badstatus", "flag_ls")


@query(f"""with t as (select {S.MONTH} as month, * from tablename_cre_kdteam_target), c as (select month, count(*) as n, {', '.join(f'count(*) filter ({f} = 1) as {f}' for f in FLAGS)} from t where {S.MONTH} is not null group by 1),
u as (select 'flag_lw' as label, month, n, flag_lw as p from c union all select 'flag_notacct', month, n, flag_notacct from c union all select 'flag_badstatus', month, n, flag_badstatus from c union all select 'flag_ls', month, n, flag_ls from c),
l as (select *, lag(p) over (partition by label order by month) as b from u)
select label, month, n, p as n_pos, case when b is not null then round((greatest(p, b) - least(p, b)) / nullif(least(p, b), 0), 6) end as wave, coalesce(b is not null and (greatest(p, b) - least(p, b)) / nullif(least(p, b), 0) >= 0.2, false) as alarm from l""")
def q82_label_rates(spark, d):
    t = table(spark, d, TARGET).select(normal.month_of(F.col("month_id"), F.col("acct_month")).alias("month"), *FLAGS).where("month is not null")
    return rounded(rollup.label_rates(t, period="month", labels={f: F.coalesce(F.col(f) == 1, F.lit(False)) for f in FLAGS}, limit=0.2), "wave")


@query("select strftime(ts, '%Y%m') as month, cast(strftime(ts, '%d') as integer) as day, count(*) as n from events where strftime(ts, '%Y%m%d') between '20240105' and '20240120' group by 1, 2")
def q83_day_counts(spark, d):
    e = table(spark, d, "events").select(F.date_format("ts", "yyyyMM").alias("month"), F.dayofmonth("ts").alias("day"))
    return catalog.period_counts(e, "month", "20240105", "20240120", day="day")


@query("""select 'l_quantity' as col, count(l_quantity) as n, round(avg(l_quantity), 6) as mean, round(stddev_samp(l_quantity), 6) as std, min(l_quantity) as lo, quantile_cont(l_quantity, 0.25) as q25, quantile_cont(l_quantity, 0.5) as q50, quantile_cont(l_quantity, 0.75) as q75, max(l_quantity) as hi from lineitem
union all select 'l_discount', count(l_discount), round(avg(l_discount), 6), round(stddev_samp(l_discount), 6), min(l_discount), quantile_cont(l_discount, 0.25), quantile_cont(l_discount, 0.5), quantile_cont(l_discount, 0.75), max(l_discount) from lineitem
union all select 'n', count(l_quantity) filter (l_quantity > 25), round(avg(l_quantity) filter (l_quantity > 25), 6), round(stddev_samp(l_quantity) filter (l_quantity > 25), 6), min(l_quantity) filter (l_quantity > 25), quantile_cont(l_quantity, 0.25) filter (l_quantity > 25), quantile_cont(l_quantity, 0.5) filter (l_quantity > 25), quantile_cont(l_quantity, 0.75) filter (l_quantity > 25), max(l_quantity) filter (l_quantity > 25) from lineitem""")
def q84_describe(spark, d):
    rows = table(spark, d, "lineitem").select("l_quantity", "l_discount", F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("n"))
    return rounded(stats.describe(rows, ["l_quantity", "l_discount", "n"]), "mean", "std")


@query(f"""with {WOE_SQL}, g as (select col, v, count(*) as n, count(*) filter (y = 1) as n_pos, count(*) filter (y = 0) as n_neg from lg group by 1, 2)
select col, v, n, round(n / (select count(*) from lo), 6) as share, printf('%.1f%%', round(100 * n / (select count(*) from lo), 1)) as percent, n_pos, n_neg from g""")
def q85_value_table(spark, d):
    return rounded(stats.value_table(labelled_orders(spark, d), ["o_orderstatus", "o_orderpriority", "year"], "y"), "share")


# --- samples and panels

@query("select o_orderkey from (select o_orderkey from orders where year(o_orderdate) = 1997 order by md5(cast(o_orderkey as varchar)) limit 200)")
def q86_test_cap(spark, d):
    rows = table(spark, d, "orders").where(F.year("o_orderdate") == 1997).select("o_orderkey")
    return sampling.quota(rows, {None: 200}, key=sampling.hash_key(F.col("o_orderkey")))


@query("""with o as (select o_orderkey, o_orderpriority as p, o_totalprice > 250000 as y, md5(cast(o_orderkey as varchar)) as k from orders), pos as (select * from o where y order by k limit 100), neg as (select *, count(*) over (partition by p) as np, count(*) over () as total, row_number() over (partition by p order by k) as r from o where not y)
select o_orderkey, 1 as y from pos union all select o_orderkey, 0 from neg where (select count(*) from pos) * 3 >= total or r <= ((select count(*) from pos) * 3 * np + total - 1) // total""")
def q87_down_sample(spark, d):
    rows = labelled_orders(spark, d).select("o_orderkey", "o_orderpriority", "y")
    out = sampling.down_sample(rows, label="y", positive="1", negative="0", positive_limit=100, ratio=3, key=sampling.hash_key(F.col("o_orderkey")), stratified="o_orderpriority")
    return out.select("o_orderkey", F.col("y").cast("int").alias("y"))


@query("""with r as (select count(*) filter (o_totalprice <= 250000) / count(*) filter (o_totalprice > 250000) as real from orders), k as (select i, x from (values (1, 1), (2, 3), (3, 50), (4, 100000)) t(i, x), r where x <= real)
select i, cast(x as varchar) as ratio from k union all select (select count(*) from k) + 1, 'actual' where (select count(*) from k) < 4""")
def q88_ratios(spark, d):
    n, p, _ = rollup.case_counts(labelled_orders(spark, d), F.col("y") == "1")
    return spark.createDataFrame([(i + 1, str(x)) for i, x in enumerate(sampling.usable_ratios([1, 3, 50, 100000], p, n - p))], "i long, ratio string")


BASE = f"""
om as ({OM}), p as (select id, month, n, case when st = 'F' then '1' else '0' end as y from om),
u as (select *, md5(id || '_' || month) as k from p where month in ('199404', '199405')),
ti as (select * from u where month = '199405' order by k limit 20), rest as (select * from u where not exists (select 1 from ti where ti.id = u.id and ti.month = u.month)),
picks as (select id, month as base, 'data_timein' as data_use from ti union all select id, month, 'data_train' from (select * from rest where y = '1' order by k limit 30)
    union all select id, month, 'data_train' from (select * from rest where y = '0' order by k limit 60)),
bt as (select p.id, p.month, p.n, p.y, base as user_acct_month, data_use from picks join p on p.id = picks.id and p.month <= base and p.month >= strftime(strptime(base || '01', '%Y%m%d') - interval 2 month, '%Y%m'))"""


def _labelled_months(spark, d) -> DataFrame:
    return customer_months(spark, d).select("id", "month", "n", F.when(F.col("st") == "F", "1").otherwise("0").alias("y"))


_SPEC = ModelSpec("m", "m", "199405", label="y", col_month="month", col_id="id", n_recent=3, cumulated_months=1, timein_count=20, positive_limit=30, train_ratio=2.0)


@query(f"with {BASE} select * from bt")
def q89_base_table(spark, d):
    return panel.base_table(_labelled_months(spark, d), _SPEC, "train").select("id", "month", "n", "y", "user_acct_month", "data_use")


@query(f"with {BASE} select user_acct_month, data_use, month as period, y as label, count(*) as n, count(distinct id) as n_users from bt group by 1, 2, 3, 4")
def q90_base_counts(spark, d):
    return panel.base_counts(panel.base_table(_labelled_months(spark, d), _SPEC, "train"), _SPEC)


@query(f"""with om as ({OM}), p as (select id, month, n, st as y from om where month between '199603' and '199605'), i as (select id from p where month = '199605')
select i.id, m.month, p.n, p.y from i cross join (select distinct month from p where id in (select id from i)) m left join p on p.id = i.id and p.month = m.month""")
def q91_gate(spark, d):
    rows = customer_months(spark, d).where("month between '199603' and '199605'").select("id", "month", "n", F.col("st").alias("y"))
    return panel.gate(rows, entity="id", period="month", n=3, label="y", at="199605")


@query(f"with {PAD} select user_id, cast(max(x) filter (day = '20240124') as double) as x, round(avg(cast(x as double)), 6) as avg__x, cast(max(n) as bigint) as max__n, count(*) filter (n > 0) as more0cnt__n, cast(sum(n) filter (day = '20240124') + sum(x) filter (day = '20240124') as double) as add__n__x from z group by 1")
def q92_create(spark, d):
    """The wide table of a saved plan: raw columns, a pair and recent features, joined by entity."""
    pair = [features.FeatureDef("add", p) for p in features.field_pairs(["n", "x"])]
    plan = explore.FeaturePlan(("x", "n"), (), ("x",), tuple(pair), (features.FeatureDef("avg", ("x",)), features.FeatureDef("max", ("n",)), features.FeatureDef("more0cnt", ("n",))))
    plan = explore.FeaturePlan.from_json(plan.to_json())
    out = explore.create(padded(spark, d), plan, entity="user_id", period="day", at="20240124")
    explore.check_created(out, plan)
    return rounded(out, "avg__x")


@query("""select user_id, count(*) filter (event_type = 'click') as "valuecnt__event_type~click", count(*) filter (event_type = 'error') as "valuecnt__event_type~error" from events group by 1""")
def q93_known_values(spark, d):
    """Forced counts of values: those that never occur are left out."""
    e = table(spark, d, "events").select("user_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("day"))
    seen = {r[0] for r in e.select("event_type").distinct().limit(1000).collect()}
    usable, skipped = features.known_values(features.recent_defs([], {"event_type": ["click", "nothing", "error"]}), {"event_type": seen})
    if [x.value for x in skipped] != ["nothing"]:
        raise ValueError(skipped)
    return features.recent_features(e, usable, entity="user_id", period="day", at="20240130")


@query(f"select {S.trimmed('model_name')} as model_name, count(distinct ({S.six('acct_month')}, {S.key('user_no')})) as n from table_score_flag_month where {S.key('user_no')} is not null and {S.six('acct_month')} is not null group by 1")
def q94_distinct_records(spark, d):
    s = table(spark, d, SCORE).select(normal.trimmed(F.col("model_name")).alias("model_name"), normal.month_of(F.col("acct_month")).alias("m"), normal.entity_key(F.col("user_no")).alias("k"))
    return s.dropna(subset=["m", "k"]).dropDuplicates().groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))


# --- dictionary and expectations

@query("""select col_name, case when is_number = 1 then 'number' when is_coded = 1 then 'category' else 'none' end as used, is_number = 1 and col_name like 'open%' as no_recent, row_number() over (order by col_name) as place
from exam_rule where col_name <> 'age_teamzk'""")
def q95_dictionary(spark, d):
    """The profiled columns as a dictionary: inputs by kind, columns without features of recent periods, one that isn't available."""
    rules = spark.read.parquet(f"{d}/exam_rule.parquet").dropDuplicates(["col_name"]).orderBy("col_name").limit(10_001).collect()  # a dictionary
    specs = [FieldSpec(r.col_name, kind=NUMBER if r.is_number == 1 else CATEGORY, table=INFO, available=r.col_name != "age_teamzk", into_model=r.is_number == 1 or r.is_coded == 1, recent=not (r.is_number == 1 and r.col_name.startswith("open"))) for r in rules]
    use = field_use(specs)
    names = [n for n in table_columns(specs, INFO) if n != "age_teamzk"]
    rows = [(n, "number" if n in use.numbers else "category" if n in use.categories else "none", n in use.no_recent, i + 1) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "col_name string, used string, no_recent boolean, place long")


@query("select 'o_orderstatus' as col, count(distinct o_orderstatus) <= 1 as constant from orders union all select 'one', true union all select 'nothing', true union all select 'o_custkey', count(distinct o_custkey) <= 1 from orders")
def q96_constant_columns(spark, d):
    o = table(spark, d, "orders").select("o_orderstatus", F.lit(1).alias("one"), F.lit(None).cast("string").alias("nothing"), "o_custkey")
    stats.require(o, stats.finite(["one", "o_custkey"]))
    gone = stats.constant_columns(o, o.columns)
    return spark.createDataFrame([(c, c in gone) for c in o.columns], "col string, constant boolean")


# --- preparation and statistics

@query(f"""with {WOE_SQL} select lo.o_orderkey, round(a.woe, 6) as o_orderstatus, round(b.woe, 6) as o_orderpriority, round(c.woe, 6) as year from lo join w a on a.col = 'o_orderstatus' and a.v = lo.o_orderstatus
join w b on b.col = 'o_orderpriority' and b.v = lo.o_orderpriority join w c on c.col = 'year' and c.v = lo.year""")
def q97_woe_codes(spark, d):
    o = labelled_orders(spark, d).select("o_orderkey", "o_orderstatus", "o_orderpriority", "year", "y")
    step, _ = prep.fit_woe(o, ["o_orderstatus", "o_orderpriority", "year"], "y", "1", "0", gap_limit=-1)
    return rounded(step.apply(o).drop("y"), "o_orderstatus", "o_orderpriority", "year")


@query("""with o as (select o_orderkey, case when o_totalprice <= 100000 then 'a' when o_totalprice <= 240000 then 'b' when o_totalprice <= 260000 then 'c' else 'd' end || '_' || o_orderpriority as v, case when o_totalprice > 250000 then 1 else 0 end as y from orders),
t as (select sum(y) as tp, count(*) - sum(y) as tn from o), c as (select v, sum(y) as p, count(*) - sum(y) as n from o group by 1),
e as (select v, greatest(p, 1) as p1, greatest(n, 1) as n1, greatest(tp - p, 1) as p0, greatest(tn - n, 1) as n0 from c, t), f as (select v, p1 / (p1 + p0) as a1, n1 / (n1 + n0) as b1, p0 / (p1 + p0) as a0, n0 / (n1 + n0) as b0 from e),
iv as (select v, (a1 - b1) * ln(a1 / b1) + (a0 - b0) * ln(a0 / b0) as iv from f), h as (select v, row_number() over (order by v) - 1 as i from iv where iv > 0.02)
select o_orderkey, cast(coalesce(i, (select count(*) from h)) as integer) as v from o left join h using (v)""")
def q98_ordinal_low_iv(spark, d):
    """Codes of a category whose values of low information are one code, the last."""
    band = F.when(F.col("o_totalprice") <= 100000, "a").when(F.col("o_totalprice") <= 240000, "b").when(F.col("o_totalprice") <= 260000, "c").otherwise("d")
    o = labelled_orders(spark, d).select("o_orderkey", F.concat_ws("_", band, "o_orderpriority").alias("v"), "y")
    return prep.fit_onehot(o, ["v"], label="y", iv_limit=0.02, ordinal=True, unknown="error").apply(o).drop("y")


@query("select o_orderkey, cast(o_custkey as integer) as c, o_orderpriority as p from orders")
def q99_text_to_int(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("c"), F.col("o_orderpriority").alias("p"))
    return prep.fit_toint(o, ["c", "p"]).apply(o)


@query("""with q as (select quantile_cont(o_totalprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as q from orders where year(o_orderdate) = 1996),
g as (select 'o_totalprice' as col, year(o_orderdate) as yr, cast(len(list_filter(q, lambda c: o_totalprice > c)) as varchar) as v from orders, q union all select 'o_orderpriority', year(o_orderdate), o_orderpriority from orders union all select 'o_orderstatus', year(o_orderdate), o_orderstatus from orders),
c as (select col, v, greatest(1, count(*) filter (yr = 1996)) as a, greatest(1, count(*) filter (yr = 1997)) as b, count(*) filter (yr = 1996) as had, count(*) filter (yr = 1997) as has from g where yr in (1996, 1997) group by 1, 2),
r as (select *, a / sum(a) over (partition by col) as ra, b / sum(b) over (partition by col) as rb from c)
select col, round(sum((rb - ra) * ln(rb / ra)), 9) as psi, sum((rb - ra) * ln(rb / ra)) >= 0.1 as moved, count(*) filter (had = 0 and has > 0) as new_values from r group by 1""")
def q100_psi_tracker(spark, d):
    o = labelled_orders(spark, d)
    tracker = stats.fit_tracker(o.where("year = '1996'"), ["o_totalprice"], ["o_orderpriority", "o_orderstatus"])
    return rounded(tracker.compare(o.where("year = '1997'")), "psi", digits=9)


@query(f"""with {WOE_SQL}, i as (select col, sum(dif * woe) as iv from w group by 1), p as (select * from (values ('year', 0.25::double), ('other', 0.5::double)) t(col, psi)), f as (select * from (values ('year', 'year of the order'), ('o_orderstatus', 'status')) t(col, comment))
select col, round(iv, 9) as iv, psi, comment from i full join p using (col) left join f using (col)""")
def q101_screening_table(spark, d):
    iv = stats.information_values(order_woe(spark, d)).select("col", "iv")
    psi = spark.createDataFrame([("year", 0.25), ("other", 0.5)], "col string, psi double")
    fields = spark.createDataFrame([("year", "year of the order"), ("o_orderstatus", "status")], "col string, comment string")
    return rounded(report.screening(iv, psi, fields), "iv", digits=9)


ORACLE["q41_corr_greedy"] = """
with recursive x as (select p_retailprice as a, p_retailprice * 2 + p_size as b, p_size as c, p_partkey + p_size * 3 as d from part),
r as (select unnest([{'a': 'a', 'b': 'b', 'r': corr(a, b)}, {'a': 'a', 'b': 'c', 'r': corr(a, c)}, {'a': 'a', 'b': 'd', 'r': corr(a, d)}, {'a': 'b', 'b': 'c', 'r': corr(b, c)}, {'a': 'b', 'b': 'd', 'r': corr(b, d)}, {'a': 'c', 'b': 'd', 'r': corr(c, d)}], recursive := true) from x),
pairs as (select row_number() over (order by abs(r) desc, a, b) as i, a, b from r where abs(r) >= 0.8),
g(i, gone) as (select 0::bigint, []::varchar[] union all select g.i + 1, case when list_contains(gone, a) or list_contains(gone, b) then gone else list_append(gone, b) end from g join pairs on pairs.i = g.i + 1)
select col, coalesce(list_contains((select max_by(gone, i) from g), col), false) as dropped from (select unnest(['a', 'b', 'c', 'd']) as col)
"""


#: Best cuts level by level from prefix sums, down to intervals that the description length test leaves whole.
ORACLE["q44_mdlp_bins"] = """
with recursive v as (select round(o_totalprice + o_orderkey * 7919 % 80000, 6) as x, count(*) filter (o_totalprice > 250000) as p, count(*) filter (o_totalprice <= 250000) as n from orders group by 1),
c as (select x, row_number() over (order by x) as i, lead(x) over (order by x) as nx, cast(sum(p) over (order by x) as double) as cp, cast(sum(n) over (order by x) as double) as cn from v),
e as (select 0 as i, 0.0::double as cp, 0.0::double as cn union all select i, cp, cn from c),
s(a, z, cut, upto) as (
    select 0::bigint, (select max(i) from c), null::double, null::double
    union all
    select unnest([k.a, k.i]), unnest([k.i, k.z]), unnest([k.cut, null]), unnest([k.upto, null]) from (
        select *, (case when p1 > 0 then -p1 / n1 * ln(p1 / n1) else 0 end) + (case when q1 > 0 then -q1 / n1 * ln(q1 / n1) else 0 end) as e1, (case when p2 > 0 then -p2 / n2 * ln(p2 / n2) else 0 end) + (case when q2 > 0 then -q2 / n2 * ln(q2 / n2) else 0 end) as e2,
            (case when p0 > 0 then -p0 / n0 * ln(p0 / n0) else 0 end) + (case when q0 > 0 then -q0 / n0 * ln(q0 / n0) else 0 end) as e0,
            cast(p0 > 0 as integer) + cast(q0 > 0 as integer) as k0, cast(p1 > 0 as integer) + cast(q1 > 0 as integer) as k1, cast(p2 > 0 as integer) + cast(q2 > 0 as integer) as k2
        from (
            select *, row_number() over (partition by a, z order by round(n1 - (p1 * p1 + q1 * q1) / n1 + n2 - (p2 * p2 + q2 * q2) / n2, 9), i) as r from (
                select s.a, s.z, c.i, (c.x + c.nx) / 2 as cut, c.cp + c.cn as upto, c.cp - ea.cp as p1, c.cn - ea.cn as q1, c.cp - ea.cp + c.cn - ea.cn as n1, ez.cp - c.cp as p2, ez.cn - c.cn as q2, ez.cp - c.cp + ez.cn - c.cn as n2,
                    ez.cp - ea.cp as p0, ez.cn - ea.cn as q0, ez.cp - ea.cp + ez.cn - ea.cn as n0
                from s join e ea on ea.i = s.a join e ez on ez.i = s.z join c on c.i > s.a and c.i < s.z where ez.cp - ea.cp + ez.cn - ea.cn >= 30
            )
        ) where r = 1
    ) k where e0 - n1 / n0 * e1 - n2 / n0 * e2 >= (ln(n0 - 1) + ln(pow(3, k0) - 2) - (k0 * e0 - k1 * e1 - k2 * e2)) / n0
),
cuts as (select cut, upto - coalesce(lag(upto) over (order by cut), 0) as held from s where cut is not null),
o as (select o_totalprice > 250000 as y, (select count(*) from cuts where held >= 30 and o_totalprice + o_orderkey * 7919 % 80000 > cut) as x from orders)
select cast(x as integer) as x, count(*) as n, count(*) filter (y) as n_pos from o group by 1
"""

# bins as a list that each step shortens by one, at place m
_RATE = "list_transform(l, lambda x: x.p / (x.p + x.n))"
_MERGED = "list_concat(list_concat(l[:m - 1], [{'lo': l[m].lo, 'hi': l[m + 1].hi, 'p': l[m].p + l[m + 1].p, 'n': l[m].n + l[m + 1].n}]), l[m + 2:])"
#: Small bins, then similar, then turning ones are merged; a line or parabola's R2 by orthogonal polynomials.
ORACLE["q60_bin_cleanup"] = f"""
with recursive b as (select cast(floor(o_totalprice / 20000) as integer) as b, count(*) filter (o_orderstatus = 'F') as p, count(*) filter (o_orderstatus <> 'F') as n from orders group by 1),
d as (select list({{'lo': b::double, 'hi': (b + 1)::double, 'p': p, 'n': n}} order by b) as l, least(500, 0.01 * sum(p + n)) as few, least(0.01, 0.5 * sum(p) / sum(p + n)) as gap from b),
r1(l, k) as (
    select l, 0 from d union all select {_MERGED}, k + 1 from (
        select *, case when i = 1 then 1 when i = len(l) then i - 1 when abs(rate[i - 1] - rate[i]) <= abs(rate[i + 1] - rate[i]) then i - 1 else i end as m
        from (select *, list_position(size, list_min(size)) as i from (select l, k, {_RATE} as rate, list_transform(l, lambda x: x.p + x.n) as size from r1)) where len(l) > 1 and size[i] < (select few from d)
    )
),
r2(l, k) as (
    select (select max_by(l, k) from r1), 0 union all select {_MERGED}, k + 1 from (
        select *, list_position(g, list_min(g)) as m from (select *, list_transform(range(1, len(l)), lambda j: abs(rate[j] - rate[j + 1])) as g from (select l, k, {_RATE} as rate from r2 where len(l) > 1)) where list_min(g) < (select gap from d)
    )
),
r3(l, k) as (
    select (select max_by(l, k) from r2), 0 union all select {_MERGED}, k + 1 from (
        select *, list_position(against, list_max(against)) as m from (
            select *, case when list_max(w) >= 0 then w else list_transform(step, lambda s: -abs(s)) end as against from (
                select *, list_transform(step, lambda s: case when sign(s) <> trend then abs(s) else -1.0 end) as w from (
                    select *, list_transform(range(1, len(l)), lambda j: rate[j + 1] - rate[j]) as step, case when rate[-1] < rate[1] then -1 else 1 end as trend,
                        list_transform(range(len(l)), lambda j: j - (len(l) - 1) / 2.0) as f1, list_transform(range(len(l)), lambda j: pow(j - (len(l) - 1) / 2.0, 2) - (len(l) * len(l) - 1) / 12.0) as f2, list_transform(rate, lambda y: y - list_avg(rate)) as dev
                    from (select l, k, {_RATE} as rate from r3 where len(l) > 3)
                )
            )
        ) where list_dot_product(dev, dev) > 0 and (pow(list_dot_product(f1, rate), 2) / list_dot_product(f1, f1) + pow(list_dot_product(f2, rate), 2) / list_dot_product(f2, f2)) / list_dot_product(dev, dev) < 0.8
    )
)
select x.lo as lo, x.hi as hi, x.p as n_pos, x.n as n_neg from (select unnest((select max_by(l, k) from r3)) as x)
"""


# --- scores and reports

def _scored_sql(name: str, factor: int) -> str:
    return f"select '{name}' as model, (o_orderkey * {factor} % 1000) / 10.0::double as score, o_orderstatus as y from orders"


@query(f"""with sc as ({_scored_sql('m1', 7919)} union all {_scored_sql('m2', 104729)} union all {_scored_sql('m3', 31)}),
q as (select model, quantile_cont(score, [0.99, 0.95, 0.9, 0.8]) as t from sc group by 1), c as (select sc.model, case when score >= t[1] then 1 when score >= t[2] then 2 when score >= t[3] then 3 else 4 end as band, count(*) filter (y = 'F') as p, count(*) filter (y <> 'F') as n from sc join q on q.model = sc.model where score >= t[4] group by 1, 2)
select model, round(sum([0.4, 0.3, 0.2, 0.1][band] * 100 * p / (p + n)), 4) as indicator from c group by 1""")
def q102_indicator(spark, d):
    """The indicator by which models are chosen: weighted precision of the first four population bands."""
    rows = []
    for name, k in (("m1", 7919), ("m2", 104729), ("m3", 31)):
        s = table(spark, d, "orders").select((F.pmod(F.col("o_orderkey") * k, F.lit(1000)) / F.lit(10.0)).alias("score"), F.col("o_orderstatus").alias("y"))
        t = evaluate.evaluation(s, score="score", label="y", positive="F", negative="O", thresholds=evaluate.score_thresholds(s, "score")).orderBy("band").collect()
        rows.append((name, round(evaluate.indicator(t), 4)))
    return spark.createDataFrame(rows, "model string, indicator double")


_GRADES = f"with {SCORED}, th as (select cast(row_number() over (order by t desc) - 1 as integer) as i, cast(t as double) as t from (select unnest([90, 80, 70, 60, 50, 40, 30, 20, 10, 0]) as t))"


@query(f"{_GRADES}, ev as ({EVAL.strip().removeprefix('b as').join(['with b as', ''])}) select o_orderkey, score, y, ev.band as score_cut, ev.precision from sc join th on score >= th.t and (th.i = 0 or score < (select max(t) from th x where x.i = th.i - 1)) join ev on ev.band = th.i")
def q103_band_quality(spark, d):
    s = scored_orders(spark, d)
    t = evaluate.evaluation(s, score="score", label="y", positive="F", negative="O", thresholds=evaluate.GRADES)
    return rounded(score.with_band_quality(s, evaluate.GRADES, t).drop("lift"), "precision")


@query(f"{_GRADES}, b as (select i, (select count(*) from sc where score >= t and y = 'F') as cp, (select count(*) from sc where score >= t and y in ('O', 'P')) as cn from th) select i as band, round(2 * cp / nullif(cp + cn + max(cp) over (), 0), 6) as f1 from b")
def q104_f1(spark, d):
    t = evaluate.evaluation(scored_orders(spark, d), score="score", label="y", positive="F", negative="O", thresholds=evaluate.GRADES)
    return rounded(evaluate.with_f1(t).select("band", "f1"), "f1")


@query(f"""with {WOE_SQL}, {SCORED}, k as (select o_orderkey, x.col, x.v, x.o from (select o_orderkey, unnest([{{'col': 'o_orderstatus', 'v': o_orderstatus, 'o': 0}}, {{'col': 'year', 'v': year, 'o': 1}}]) as x from lo)),
r as (select o_orderkey, k.col, woe, row_number() over (partition by o_orderkey order by woe desc, o) as r from k join w on k.col = w.col and k.v = w.v)
select sc.o_orderkey, sc.score, case when woe > 0.01 then col end as colname_top1 from sc left join (select * from r where r = 1) using (o_orderkey)""")
def q105_scores_with_reasons(spark, d):
    woe: dict[str, dict[str, float]] = {"o_orderstatus": {}, "year": {}}
    for r in order_woe(spark, d).where(F.col("col").isin(list(woe))).collect():  # a row per value of two short columns
        woe[r.col][r.v] = r.woe
    found = score.top_reasons(labelled_orders(spark, d).select("o_orderkey", *woe), woe, n=1, threshold=0.01)
    return scored_orders(spark, d).drop("y").join(found.select("o_orderkey", "colname_top1"), "o_orderkey", "left")


@query("""with b as (select cast(floor(o_totalprice / 50000) as integer) as b, count(*) as n, count(*) filter (o_orderstatus = 'F') as p from orders group by 1)
select '(' || b || ', ' || (b + 1) || ']' as label, n, round(n / sum(n) over (), 6) as share, round(p / n, 6) as rate from b""")
def q106_chart_data(spark, d):
    counts = table(spark, d, "orders").groupBy(F.floor(F.col("o_totalprice") / 50000).cast("int").alias("b")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("p"), F.count_if(F.col("o_orderstatus") != "F").alias("n")).collect()  # bins
    rows = report.chart_rows([report.Bin(float(r.b), float(r.b + 1), r.p, r.n) for r in counts])
    return rounded(spark.createDataFrame(rows, "label string, n long, share double, rate double"), "share", "rate")


@query("""with pr as (select strftime(o_orderdate, '%Y') as year, o_orderpriority as v, count(*) as n from orders where year(o_orderdate) in (1996, 1997, 1998) group by 1, 2), t as (select v, avg(n) as m, stddev_samp(n) as s from pr group by 1)
select v, round(s / m, 6) as sep, row_number() over (order by s / m desc, v) as place from t order by s / m desc, v limit 20""")
def q107_top_dispersion(spark, d):
    """A sorted report: the 20 values whose counts vary most from year to year."""
    n = labelled_orders(spark, d).where("year in ('1996', '1997', '1998')").groupBy("year", F.col("o_orderpriority").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    sep = n.groupBy("v").agg((F.stddev_samp("n") / F.avg("n")).alias("sep"))
    top = sep.orderBy(F.desc("sep"), "v").limit(20)
    return rounded(ranking.global_rank(top, [F.desc("sep"), F.col("v")], "place"), "sep")


@query("select year(o_orderdate) as year, cast(count(*) as double) as n, cast(count(*) filter (o_totalprice is null) as double) as empty from orders group by 1")
def q108_profile_counts(spark, d):
    o = table(spark, d, "orders").select(F.year("o_orderdate").cast("long").alias("year"), "o_totalprice")
    rows = profile_table.profile_rows(o, period="year", numbers=["o_totalprice"], others=[])
    pick = lambda s, n: F.max(F.when(F.col("col_stat") == s, F.col("col_value"))).cast("double").alias(n)
    return rows.groupBy("year").agg(pick("count_全量", "n"), pick("count_空值", "empty"))
