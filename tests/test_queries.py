"""Every query of the core with SQL gives the same rows as its SQL on the smallest tables."""

from pathlib import Path

import pytest

from minespark.plans import registry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for p in DATA.iterdir():
        c.execute(f"create view {p.name.split('.')[0]} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return c


def plain(v):
    return float(v) if type(v).__name__ == "Decimal" else round(v, 9) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, str(DATA))
    cursor = duck.execute(registry.oracle_sql()[name])
    columns = [x[0] for x in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted((tuple(map(plain, r)) for r in cursor.fetchall()), key=repr)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert got == want


def test_every_query_is_registered():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_all_models_are_followed_whatever_their_spelling(spark, tmp_path, rows):
    scores = [(1, " 离网识别_甲", "2024-03", " z1 ", "flag_lw"), (2, "离网识别_甲", "202402", "Z2", "flag_lw"), (3, "离网识别_乙", "202403", "Z1", "flag_lw"), (4, "副卡意向 ", "202401", "z2", "flag_fk"), (5, "彩铃偏好", "202403", "Z1", "flag_cl"), (6, "离网识别_甲", "202401", "Z1", "flag_lw")]
    spark.createDataFrame(scores, "score_id long, model_name string, acct_month string, user_no string, col_flag string").write.parquet(f"{tmp_path}/table_score_flag_month.parquet")
    # Z1 twice, the later delivery counts; month_id overrules acct_month
    labels = [(1, 1, "202403", "202403", "Z1", 0, 0), (2, 2, "202403", "2024 03", "z1", 1, 0), (3, 1, "202403", "202402", " Z2", 0, 1), (4, 1, "202401", None, "Z2", 0, 0)]
    t = spark.createDataFrame(labels, "target_id long, day int, acct_month string, month_id string, user_no string, flag_lw int, flag_ls int")
    t.selectExpr("target_id", "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, day) as load_time", "acct_month", "month_id", "user_no", "flag_lw", "0 as flag_notacct", "0 as flag_badstatus", "flag_ls").write.parquet(f"{tmp_path}/tablename_cre_kdteam_target.parquet")
    want = [(1, "离网识别_甲", "202404", 1, "flag_lw", 1), (2, "离网识别_甲", "202404", 2, "flag_lw", None), (3, "离网识别_乙", "202404", 1, "flag_lw", 1), (4, "副卡意向", "202404", 3, "flag_ls", 1), (5, "彩铃偏好", "202404", 1, "flag_cl", None)]
    assert rows(registry.queries()["q57_monitor_all_models"](spark, str(tmp_path))) == want
