"""The queries of minespark.plans.problems as SQL, for the oracle."""

from __future__ import annotations


def key(c: str) -> str:
    return f"upper({trimmed(c)})"


def trimmed(c: str) -> str:
    return f"nullif(trim({c}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(12288)), '')"


def six(c: str) -> str:
    bare = f"translate({c}, ' -' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(12288), '')"
    return f"case when regexp_full_match({bare}, '[0-9]{{6}}') then {bare} end"


MONTH = f"coalesce({six('month_id')}, {six('acct_month')})"

P1 = f"""
with c as (select {key('zk_user_no')} as k, {MONTH} as m, load_time as t, info_id from dm_zc_yw_moxing_team_info_m),
e as (select target_id, {key('user_no')} as k, {MONTH} as m, event_time as t from tablename_cre_kdteam_target),
x as (
    select e.target_id, c.info_id, row_number() over (partition by e.target_id order by c.m desc, c.t desc, c.info_id) as r
    from e join c on e.k = c.k and c.m <= e.m and c.t <= e.t
)
select target_id, info_id from x where r = 1
"""


def flag(c: str) -> str:
    t = trimmed(c)
    return f"coalesce(cast(try_cast({t} as decimal(38,10)) as varchar), {t})"


STATE = f"""
r as (
    select {key('zk_user_no')} as k, {MONTH} as m, info_id, load_time,
        {trimmed('area_no_teamzk')} as a1, {flag('is_valid_teamzk')} as a2, {trimmed('std_user_status_name_teamzk')} as a3,
        {flag('is_5g_main_offer_teamzk')} as a4, {trimmed('sig_offer_spec_id_teamzk')} as a5, fk_num_teamzk as a6
    from dm_zc_yw_moxing_team_info_m
),
s as (
    select * from (select *, row_number() over (partition by k, m order by load_time desc nulls last, info_id) as rn from r where k is not null and m is not null)
    where rn = 1
),
months as (select m, lag(m) over (order by m) as pm, lead(m) over (order by m) as nm from (select distinct m from r where m is not null)),
t as (select s.*, pm, nm from s join months using (m))
"""

P2 = f"""
with {STATE}
select coalesce(b.m, a.nm) as month_id, coalesce(b.k, a.k) as zk_user_no,
    case when a.k is null then 'added' when b.k is null then 'removed' else 'changed' end as change_kind
from (select * from t where pm is not null) b full join (select * from t where nm is not null) a on a.k = b.k and a.nm = b.m
where a.k is null or b.k is null or a.a1 is distinct from b.a1 or a.a2 is distinct from b.a2 or a.a3 is distinct from b.a3
    or a.a4 is distinct from b.a4 or a.a5 is distinct from b.a5 or a.a6 is distinct from b.a6
"""

P3 = f"""
with {STATE},
o as (select k, m, a3, a4, lag(m) over w as lm, lag(a3) over w as l3, lag(a4) over w as l4, pm from t window w as (partition by k order by m)),
g as (
    select *, sum(case when lm is not distinct from pm and lm is not null and a3 is not distinct from l3 and a4 is not distinct from l4 then 0 else 1 end)
        over (partition by k order by m) as run from o
)
select k as zk_user_no, min(m) as valid_from, case when max(m) = (select max(m) from months) then '999912' else max(m) end as valid_to
from g group by k, run
"""

PROFILED = [
    "month_id", "zk_user_no", "user_no_teamzk", "customer_no_teamzk", "area_no_teamzk", "city_no_teamzk", "open_date_teamzk",
    "open_months_teamzk", "cert_type_teamzk", "age_teamzk", "sex_teamzk", "is_valid_teamzk", "std_user_status_name_teamzk",
    "is_acct_teamzk", "is_5g_main_offer_teamzk", "is_5g_upgrade_offer_teamzk", "sig_offer_spec_id_teamzk", "sig_offer_spec_name_teamzk",
    "sig_offer_create_dt_teamzk", "fk_num_teamzk", "prod_spec_fee_teamzk", "arpu_teamadd", "data_flux_teamadd", "flux_5g_teamadd", "sms_cnt_teamadd",
]

_LOADS = f"""
l as (
    select load_id, {six('acct_month')} as m, branch_no from load_log
    where tablename = 'dm_zc_yw_moxing_team_info_m' and load_kind = 'full'
),
lm as (select m, lag(m) over (order by m) as pm from (select distinct m from l)),
pairs as (select l.load_id, e.load_id as earlier from l join lm using (m) join l e on e.branch_no = l.branch_no and e.m = lm.pm),
u as ({' union all '.join(f"select load_id, '{c}' as col_name, cast({c} as varchar) as v, {f'cast({c} as decimal(38,4))' if c.startswith(('open_months', 'fk_num', 'prod_spec', 'arpu', 'data_flux', 'flux_5g', 'sms_cnt')) else 'cast(null as decimal(38,4))'} as d from dm_zc_yw_moxing_team_info_m" for c in PROFILED)}),
f as (select u.*, r.is_number, r.is_coded, r.pattern from u join l using (load_id) join exam_rule r using (col_name))
"""

P5 = f"""
with {_LOADS},
g as (
    select load_id, col_name, is_number, pattern, count(*) as n, count(*) - count(v) as n_null, count(distinct case when is_number = 1 then cast(d as varchar) else v end) as n_distinct,
        count(*) filter (v is not null and not regexp_matches(v, pattern)) as n_bad, count(*) filter (d = 0) as n_zero, count(*) filter (d < 0) as n_neg,
        min(d) as lo, max(d) as hi, quantile_disc(d, 0.75) as q
    from f group by all
),
t as (
    select load_id, '全量' as col_name, 'count_全量' as col_stat, cast(max(n) as decimal(38,4)) as x from g group by load_id
    union all select load_id, col_name, 'count_空值', n_null from g
    union all select load_id, col_name, 'count_不同值', n_distinct from g
    union all select load_id, col_name, 'count_格式不符', n_bad from g where pattern is not null
    union all select load_id, col_name, 'count_零值', n_zero from g where is_number = 1
    union all select load_id, col_name, 'count_负值', n_neg from g where is_number = 1
    union all select load_id, col_name, '最小值', lo from g where is_number = 1
    union all select load_id, col_name, '最大值', hi from g where is_number = 1
    union all select load_id, col_name, '分位数_75%', q from g where is_number = 1
),
c as (select load_id, col_name, v, count(*) as n from f where is_coded = 1 and v is not null group by all),
s as (select load_id, col_name, v, n / sum(n) over (partition by load_id, col_name) as x from c),
paired as (
    select p.load_id, p.earlier, a.col_name from pairs p join (select distinct load_id, col_name from s) a using (load_id)
    join (select distinct load_id, col_name from s) b on b.load_id = p.earlier and b.col_name = a.col_name
),
e as (
    select load_id, col_name, v, sum(x) as x from (
        select b.load_id, b.col_name, s.v, s.x from paired b join s on s.load_id = b.load_id and s.col_name = b.col_name
        union all select b.load_id, b.col_name, s.v, -s.x from paired b join s on s.load_id = b.earlier and s.col_name = b.col_name
    ) group by all
)
select distinct v.load_id, v.col_name, v.col_stat as finding from tablename_exam_v v join t using (load_id, col_name, col_stat) where v.col_value is distinct from t.x
union all
select a.load_id, a.col_name, 'null_shift' from pairs p join g a using (load_id) join g b on b.load_id = p.earlier and b.col_name = a.col_name
where abs(a.n_null / a.n - b.n_null / b.n) > 0.1537
union all
select a.load_id, a.col_name, 'quantile_shift' from pairs p join g a using (load_id) join g b on b.load_id = p.earlier and b.col_name = a.col_name
where a.is_number = 1 and b.q > 0 and (a.q > 2 * b.q or 2 * a.q < b.q)
union all
select load_id, col_name, 'value_shift' from e group by all having sum(abs(x)) / 2 > 0.2037
"""

P5_KS = f"""
with {_LOADS},
n as (select load_id, col_name, d, count(*) as n from f where is_number = 1 and d is not null group by all),
x as (
    select p.load_id, p.earlier, n.col_name, n.d, n.n as a, 0 as b from pairs p join n using (load_id)
    union all select p.load_id, p.earlier, n.col_name, n.d, 0, n.n from pairs p join n on n.load_id = p.earlier
),
y as (select load_id, earlier, col_name, d, sum(a) as a, sum(b) as b from x group by all),
z as (
    select load_id, earlier, col_name, sum(a) over w as a, sum(b) over w as b, sum(a) over v as ta, sum(b) over v as tb from y
    window w as (partition by load_id, earlier, col_name order by d), v as (partition by load_id, earlier, col_name)
)
select load_id, earlier as earlier_load_id, col_name, round(max(abs(a / ta - b / tb)), 9) as ks from z where ta > 0 and tb > 0 group by all
"""
