import os

import pytest
from pyspark.sql import functions as F

from minespark import cli
from minespark.operators.rollup import RollRule
from minespark.sources import catalog, io, schemas
from minespark.streaming.drift import window_counts, window_psi


def test_read_data(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, "2", "202401", 1.5), (2, "x", "20240115", 2.5)], "ID int, N string, D string, V double")
    assert rows(io.read_data(spark, df, need=["id", "n", "d"], chars=["id"], numbers=["n"], dates=["d"], condition="v > 1")) == rows(df.select(F.col("ID").cast("string"), F.col("N").try_cast("double"), F.expr("date('2024-01-' || if(ID = 1, '01', '15'))")))
    for bad in ({"need": ["id"], "leave": ["n"]}, {"chars": ["id"], "dates": ["id"]}, {"need": ["none"]}, {"fmt": "xml", "source": "x"}):
        with pytest.raises(ValueError):
            io.read_data(spark, bad.pop("source", df), **bad)
    for fmt in io.FILE_FORMATS:
        io.save_data(df, str(tmp_path / fmt), fmt=fmt)
        assert io.read_data(spark, str(tmp_path / fmt), fmt=fmt, leave=["v"], numbers=["id"]).count() == 2


def test_tables(spark, rows, tmp_path):
    spark.sql(f"create database if not exists minetest location '{tmp_path}/db'")
    df = spark.createDataFrame([(1, "202401"), (2, "202402")], "x int, m string")
    io.save_data(df, "minetest.t_202401", partition_by=["m"])
    try:
        with pytest.raises(Exception, match="exists"):
            io.save_data(df, "minetest.t_202401")
        io.save_data(df.select("m"), "minetest.t_202401", if_exists="append")
        assert spark.table("minetest.t_202401").count() == 4
        with pytest.raises(ValueError):
            io.save_data(df.withColumn("extra", F.lit(1)), "minetest.t_202401", if_exists="append")
        io.overwrite_partitions(df.where("m = '202402'").withColumn("x", F.lit(9)), "minetest.t_202401", ["m"])
        assert rows(spark.table("minetest.t_202401").where("m = '202402'")) == [(9, "202402")] and spark.table("minetest.t_202401").count() == 3
        assert catalog.tables(spark, "t_%", like=True, database="minetest") == ["minetest.t_202401"] and catalog.tables(spark, "t", database="minetest") == []
        assert catalog.table_fields(spark, "minetest.t_202401") == {"x": "int"}
        assert catalog.intermediate_tables(spark, "t", "202402", database="minetest") == ["minetest.t_202401"] and catalog.intermediate_tables(spark, "t", "202401", database="minetest") == []
        assert catalog.family_shape(spark, ["minetest.t_202401"])["uneven"] is False
    finally:
        assert catalog.drop_tables(spark, ["minetest.t_202401", "minetest.none"]) == ["minetest.t_202401"]
        spark.sql("drop database minetest cascade")


def test_sql(spark, rows):
    a = spark.createDataFrame([(1, "x;y")], "k int, v string")
    assert rows(io.run_sql(spark, "select 1; select v from {t} where v = 'x;y'", t=a)) == [("x;y",)]
    assert io.run_sql(spark, " ; ") is None
    assert rows(io.sql_on_frames(spark, "select p.v from aa p join ab q on p.k = q.k", {"aa": a, "ab": a})) == [("x;y",)]
    assert "Physical Plan" in io.plan_text(a)


def test_jdbc(spark, rows, tmp_path):
    """A table written to an embedded database and read back, by name and by query."""
    how = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    try:
        spark.sparkContext._jvm.java.lang.Class.forName(how["driver"])
    except Exception:
        pytest.skip("no embedded database")
    df = spark.createDataFrame([(1, 1.5, "a"), (2, 2.5, None)], "id int, x double, c string")
    io.save_data(df, "t", fmt="jdbc", options=how)
    with pytest.raises(Exception, match="already exists"):
        io.save_data(df, "t", fmt="jdbc", options=how)
    io.save_data(df, "t", fmt="jdbc", options=how, if_exists="append")
    assert rows(io.read_data(spark, "t", fmt="jdbc", options=how, condition="id = 2", leave=["c"], chars=["x"])) == [(2, "2.5")] * 2
    assert io.read_data(spark, '(select "id" from t where "x" > 2) as q', fmt="jdbc", options=how).count() == 2


def test_files(tmp_path):
    (tmp_path / "d").mkdir()
    for i, n in enumerate(("a_1.csv", "a_2.csv", "b.txt")):
        (tmp_path / "d" / n).write_text("x" * (i + 1))
        os.utime(tmp_path / "d" / n, (1000 + i, 1000 + i))
    assert [s for _, s in catalog.file_sizes(tmp_path)] == [1, 2, 3]
    found = catalog.select_files(tmp_path, r"\.csv$", newest_of_folder=True)
    assert [os.path.basename(p) for p in found] == ["a_2.csv"]
    assert catalog.delete_files(found) == found and os.path.exists(found[0])
    catalog.delete_files(found, really=True)
    assert not os.path.exists(found[0])


def test_schemas():
    assert len(schemas.SCHEMAS["mobile_labels"]) == 23 and len(schemas.SCHEMAS["broadband_labels"]) == 12 and len(schemas.SCHEMAS["supplement"]) == 22
    g = schemas.group_schema([RollRule("a", "main"), RollRule("fee", "sum", "decimal(30,4)")])
    assert [f.dataType.simpleString() for f in g] == ["string", "string", "string", "decimal(30,4)", "string"]


def test_cli(tmp_path, capsys):
    assert cli.main(["show-config"]) == 0 and "n_recent" in capsys.readouterr().out
    assert cli.main(["train"]) == 1


def test_cli_trains_then_predicts_by_what_it_saved(spark, tmp_path, capsys, monkeypatch):
    import json
    import random

    from minespark.plans import workflow

    rnd = random.Random(1)
    rows = []
    for i in range(600):
        x = rnd.random()
        rows += [(f"u{i}", m, 100 * x + rnd.random() * 20, rnd.random() * 10, "1" if rnd.random() < 0.05 + 0.6 * x**2 else "0") for m in ("202402", "202403")]
    spark.createDataFrame(rows, "user_no string, acct_month string, x double, z double, label string").write.parquet(str(tmp_path / "panel"))
    job = {
        "panel": str(tmp_path / "panel"), "numbers": ["x", "z", "q"], "formulas": {"q": "x / z"}, "algorithms": {"logistic": {"regParam": [0.01]}},
        "model": {"name": "m", "short_name": "m", "month_train": "202403", "month_predict": "202403", "n_recent": 2, "iv_limit": 0.02, "timein_count": 150, "positive_limit": 300, "ratios": ["actual"], "out_dir": str(tmp_path / "out")},
        "labels": {"at": "202402", "rules": [["flag_up", "b.x > a.x"]]}, "roll_up": {"period": "acct_month", "group": "label", "is_main": "x > 5", "rules": [["x", "max"]]},
    }
    (tmp_path / "job.json").write_text(json.dumps(job))
    run = lambda mode: cli.main([mode, "--spec", str(tmp_path / "job.json")])
    assert run("predict") == 1  # nothing is saved yet
    assert run("sql") == 0 and "-- labels" in (text := capsys.readouterr().out) and "-- roll_up" in text and "-- predict" in text
    monkeypatch.setattr(workflow.models, "best_of", lambda trained, on: workflow.models.Choice(next(iter(trained.values())), {}, ()))
    assert run("train") == 0
    monkeypatch.setattr(workflow, "train_and_test", None)  # predict doesn't train
    assert run("predict") == 0
    scores = spark.read.parquet(str(tmp_path / "out/m/score_202403"))
    assert scores.count() == 600 and {"score", "score_rank", "score_level", "precision", "lift", "score_psi"} <= set(scores.columns)


def test_stream(spark, rows, tmp_path):
    src = str(tmp_path / "in")
    df = spark.createDataFrame([(f"2024-01-0{1 + i % 3} 10:00:00", float(i % 4)) for i in range(60)], "t string, v double").select(F.to_timestamp("t").alias("t"), "v")
    df.write.parquet(src)
    how = {"time": "t", "value": "v", "edges": [0, 1, 3]}
    stream = window_counts(spark.readStream.schema(df.schema).parquet(src), **how)
    q = stream.writeStream.format("memory").queryName("drift").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("drift")) == rows(window_counts(df, **how))
    psi = window_psi(spark.table("drift"), [(0, 50), (1, 50)]).collect()
    assert len(psi) == 3 and all(r.psi >= 0 for r in psi)
