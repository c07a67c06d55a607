import math
import random
from pathlib import Path

import pytest

from minespark.llm import cutoff, registry
from minespark.llm.cutoff import keep_cutoffs

DATA = Path("/root/testdata/sf0.01")

R = "g string, m string, s double, n int, permille string"
T = "g string, permille int, n string"


def brute(records, targets):
    want = {}
    for g, p, _ in targets:
        if g is not None and p is not None:
            want[g] = max(p, want.get(g, p))
    by = {}
    for g, m, s, *_ in records:
        if g in want and m is not None and s is not None and not math.isnan(s):
            by.setdefault((g, m), []).append(s)
    out = []
    for (g, m), xs in by.items():
        ok = [(c, sum(x >= c for x in xs)) for c in set(xs) if sum(x >= c for x in xs) * 1000 >= len(xs) * want[g]]
        out.append((g, m, *(max(ok) if ok else (None, None))))
    return sorted(out)


def found(spark, records, targets):
    out = keep_cutoffs(spark.createDataFrame(records, R), spark.createDataFrame(targets, T), group=["g", "m"], score="s", permille="permille", on=["g"])
    return sorted(tuple(r) for r in out.collect())


def test_against_brute_force(spark):
    rnd = random.Random(3)
    score = {"a": lambda: rnd.random(), "b": lambda: rnd.choice([0.1, 0.5]), "c": lambda: round(rnd.random(), 1), "d": lambda: 0.25}
    records = [(g, rnd.choice(["x", "y", None]), rnd.choice([score[g]()] * 20 + [None, float("nan")]), 1, "p") for g in "abcd" for _ in range(500)]
    records += [(None, "x", 0.5, 1, ""), ("e", "x", 0.7, 1, ""), ("none", "x", 0.7, 1, ""), ("over", "x", 0.2, 1, "")]
    targets = [("a", 100, ""), ("b", 500, ""), ("c", 333, ""), ("d", 1, ""), ("e", 0, ""), ("over", 1001, ""), ("empty", 5, ""), (None, 5, ""), ("none", None, "")]
    want = brute(records, targets)
    assert found(spark, records, targets) == want


def test_infinite_scores_and_ties(spark):
    rnd = random.Random(5)
    records = [(g, "x", rnd.choice([round(rnd.random(), 2), rnd.gauss(0, 1), float("inf") if g == "b" else -1.5]), 1, "") for g in "ab" for _ in range(300)]
    targets = [("a", 900, ""), ("b", 30, "")]
    assert found(spark, records, targets) == brute(records, targets)


def test_empty(spark):
    assert found(spark, [], [("a", 100, "")]) == found(spark, [("a", "x", 0.5, 1, "")], []) == []


def test_groups_of_one_hash_are_told_apart(spark, monkeypatch):
    real, calls = cutoff.F.xxhash64, []

    def clashing(seed, *cols):
        calls.append(1)
        return cutoff.F.lit(7).cast("long") if len(calls) == 1 else real(seed, *cols)

    monkeypatch.setattr(cutoff.F, "xxhash64", clashing)
    records = [("a", "x", 0.1 * i, 1, "") for i in range(9)] + [("b", "y", 0.2 * i, 1, "") for i in range(5)]
    targets = [("a", 500, ""), ("b", 400, "")]
    assert found(spark, records, targets) == brute(records, targets) and len(calls) == 2


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_the_query_takes_its_rows_from_rounds(spark, monkeypatch):
    """Every group's cutoff is a pivot: the counts of the last round, about log2 of the largest group (171 records) rounds in all."""
    rounds, narrowed = [], cutoff._narrowed
    monkeypatch.setattr(cutoff, "_narrowed", lambda state, parts: rounds.append(1) or narrowed(state, parts))
    out = registry.p4_found(spark, str(DATA)).collect()
    assert out and all(r.cutoff_micro is not None for r in out)
    assert 5 <= len(rounds) <= 20
