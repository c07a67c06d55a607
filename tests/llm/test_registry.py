from pathlib import Path

import pytest

from minespark.llm import registry

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_queries_run_over_whole_tables(spark):
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    q = registry.queries()
    assert q["p6_ids"](spark, str(DATA)).count() == n
    ids = {r.doc_id: len(r.ids) for r in q["p6_ids"](spark, str(DATA)).collect()}
    packed = q["p7_pack"](spark, str(DATA)).groupBy("doc_id").sum("n_tokens").collect()
    assert {r[0]: r[1] for r in packed} == {i: k for i, k in ids.items() if k}
    assert q["p8_found"](spark, str(DATA)).columns == ["doc_id", "n_shared"]


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_give_the_rows_of_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for p in DATA.iterdir():
        c.execute(f"create view {p.name.split('.')[0]} as select * from read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    df = registry.queries()[name](spark, str(DATA))
    cursor = c.execute(registry.oracle_sql()[name])
    columns = [x[0] for x in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(tuple(r[x] for x in columns) for r in df.collect()) == sorted(cursor.fetchall())
