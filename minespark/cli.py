"""Command line: python -m minespark.cli train|predict|all|sql|show-config --env FILE --spec FILE."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace
from pathlib import Path

from pyspark.sql import functions as F

from minespark.config import load_config
from minespark.operators import model as models
from minespark.operators.labels import LabelRule, next_period_labels
from minespark.operators.panel import base_table
from minespark.operators.rollup import RollRule, roll_up
from minespark.runtime import session
from minespark.sources.io import plan_text, read_data, save_data
from minespark.spec import ModelSpec


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="minespark")
    p.add_argument("mode", choices=["train", "predict", "all", "sql", "show-config"])
    p.add_argument("--env", help="settings file")
    p.add_argument("--spec", help="JSON with model, panel, numbers and categories")
    a = p.parse_args(argv)
    try:
        config = load_config(a.env)
        if a.mode == "show-config":
            print(json.dumps(config.shown(), indent=2))
            return 0
        if not a.spec:
            raise ValueError("--spec is needed")
        _run(a.mode, config, json.loads(Path(a.spec).read_text(encoding="utf-8")))
        return 0
    except Exception as e:  # the exit code tells the scheduler
        print(f"failed: {e}", file=sys.stderr)
        return 1


def _run(mode, config, job) -> None:
    from minespark.plans.workflow import TrainResult, predict, train_and_test

    spark = session("minespark", shuffle_partitions=config.shuffle_partitions, shared=config.shared_dir or None)
    spec = ModelSpec(**{"out_dir": config.out_dir, "col_month": config.col_month, "col_id": config.col_id, "n_recent": config.n_recent} | {k: tuple(v) if isinstance(v, list) else v for k, v in job["model"].items()})
    panel = read_data(spark, job["panel"], fmt=job.get("format", config.mode))
    if mode == "sql":
        for name, df in _jobs(panel, spec, job):
            print(f"-- {name}\n{plan_text(df)}")
        return
    if mode in ("train", "all"):
        how = {k: job[k] for k in ("formulas", "scores", "kinds", "retrain_limit") if k in job}
        algorithms = {n: m for a, grid in job["algorithms"].items() for n, m in models.grid(a, grid).items()} if "algorithms" in job else None
        result = train_and_test(panel, spec, numbers=job["numbers"], categories=job.get("categories", {}), algorithms=algorithms, **how)
        if result.choice.best is None:
            raise ValueError(f"no good model: {result.choice.verdicts}")
        result.save(spec.path("model"))
    if mode in ("predict", "all"):
        result = TrainResult.load(spec.path("model"))
        result = replace(result, spec=replace(result.spec, month_predict=spec.month_predict))
        save_data(predict(panel, result, **{k: job[k] for k in ("n_reasons", "comments", "not_causes") if k in job}), spec.path("score", spec.month_predict), fmt="parquet")


def _jobs(panel, spec, job):
    """(name, frame) of what the job's steps would run: the base tables, and the roll-up and the labels that it describes."""
    for step in ("train", "test", "predict"):
        if getattr(spec, f"month_{step}"):
            yield step, base_table(panel, spec, step, narrow=False)
    if "roll_up" in job:
        r = job["roll_up"]
        yield "roll_up", roll_up(panel, period=r["period"], group=r["group"], is_main=F.expr(r["is_main"]), rules=[RollRule(*x) for x in r["rules"]])
    if "labels" in job:
        r = job["labels"]
        yield "labels", next_period_labels(panel, [LabelRule(*x) for x in r["rules"]], entity=spec.col_id, period=spec.col_month, at=r["at"], spare=r.get("spare", 0))


if __name__ == "__main__":
    sys.exit(main())
