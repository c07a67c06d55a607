import random
from datetime import datetime, timedelta

import pytest

from minespark.operators.snapshots import snapshot_changes, version_history

S = "k string, m string, t timestamp_ntz, id long, a string, b int, i int, h1 string"
HOW = {"key": "k", "period": "m", "known_at": "t", "row_id": "id", "attrs": ["a", "b"]}
MONTHS = ["202311", "202312", "202401", "202403"]


def states(rows):
    best = {}
    for k, m, t, i, a, b, *_ in rows:
        if k is not None and m is not None:
            key = (t is not None, t or datetime.min, -i)
            if (k, m) not in best or key > best[k, m][0]:
                best[k, m] = (key, (a, b))
    return {x: v for x, (_, v) in best.items()}


def brute_changes(rows):
    s = states(rows)
    months = sorted({m for _, m, *_ in rows if m is not None})
    keys = {k for k, _ in s}
    out = []
    for old, new in zip(months, months[1:]):
        for k in keys:
            a, b = s.get((k, old), "absent"), s.get((k, new), "absent")
            if a != b:
                out.append((new, k, "added" if a == "absent" else "removed" if b == "absent" else "changed"))
    return sorted(out)


def brute_versions(rows):
    s = states(rows)
    months = sorted({m for _, m, *_ in rows if m is not None})
    out = []
    for k in {k for k, _ in s}:
        run = None
        for m in months:
            v = s.get((k, m), "absent")
            if run and run[0] == v:
                run[2] = m
                continue
            if run and run[0] != "absent":
                out.append((k, *run[0], run[1], run[2]))
            run = [v, m, m]
        if run[0] != "absent":
            out.append((k, *run[0], run[1], "999912" if run[2] == months[-1] else run[2]))
    return sorted(out, key=repr)


def random_rows(seed, n):
    rnd = random.Random(seed)
    maybe = lambda x, p=0.05: None if rnd.random() < p else x
    out = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.3 else f"k{rnd.randrange(n // 6 + 1):04d}"
        out.append((maybe(k), maybe(rnd.choice(MONTHS)), maybe(datetime(2024, 1, 1) + timedelta(hours=rnd.randrange(20)), 0.1), i, maybe(rnd.choice("xy"), 0.2), maybe(rnd.randrange(2), 0.2), i, "z"))
    return out + rnd.sample(out, n // 10)


@pytest.mark.parametrize(("seed", "n", "chunk"), [(1, 300, 4), (2, 900, 1), (3, 900, 50), (4, 60, 1000)])
def test_changes_against_brute_force(spark, rows, seed, n, chunk):
    data = random_rows(seed, n)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 11 if chunk > 4 else 10000)
    try:
        assert rows(snapshot_changes(spark.createDataFrame(data, S), **HOW, chunk_rows=chunk)) == brute_changes(data)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_against_brute_force(spark, rows, seed):
    data = random_rows(seed, 500)
    assert rows(version_history(spark.createDataFrame(data, S), **HOW)) == brute_versions(data)


def test_unchanged_chunks_are_discarded():
    import numpy as np
    import pyarrow as pa

    from minespark.operators.snapshots import _unmatched

    n = 100
    k = np.repeat([f"{i:03d}" for i in range(n)], 2)
    h = np.repeat(np.arange(n), 2).astype(np.int64)
    h2 = h.copy()
    h2[101] = -1  # one key changes in the second snapshot
    b = pa.RecordBatch.from_pydict({"k": k, "i": np.tile(np.array([0, 1], np.int32), n), "cut": np.repeat(np.arange(n) % 10 == 0, 2), "h1": h, "h2": h2, "a0": k})
    out = pa.Table.from_batches(_unmatched(iter([b.slice(0, 33), b.slice(33)]), 2))
    assert out.num_rows == 20 and set(out.column("k").to_pylist()) == {f"{i:03d}" for i in range(50, 60)}


def test_attributes_that_are_odd_to_compare(spark, rows):
    """NaN equals NaN, -0 is not told from 0, a list is compared as a whole."""
    nan = float("nan")
    data = [("a", "202401", nan, [1, 2]), ("a", "202402", nan, [1, 2]), ("b", "202401", 0.0, None), ("b", "202402", -0.0, None), ("c", "202401", 1.0, [1]), ("c", "202402", None, [1]), ("d", "202401", 1.0, [1]), ("d", "202402", 1.0, [2]), ("e", "202401", 1.0, None), ("f", "202402", None, None)]
    df = spark.createDataFrame([(k, m, None, 1, x, y) for k, m, x, y in data], "k string, m string, t timestamp, id long, x double, y array<int>")
    for chunk in (1, 50):
        got = snapshot_changes(df, key="k", period="m", known_at="t", row_id="id", attrs=["x", "y"], chunk_rows=chunk)
        assert rows(got) == [("202402", "c", "changed"), ("202402", "d", "changed"), ("202402", "e", "removed"), ("202402", "f", "added")]


def test_empty_and_single_snapshot(spark, rows):
    empty = spark.createDataFrame([], S)
    assert rows(snapshot_changes(empty, **HOW)) == rows(version_history(empty, **HOW)) == []
    one = spark.createDataFrame([("a", "202401", None, 1, None, None, 0, "")], S)
    assert rows(snapshot_changes(one, **HOW)) == []
    assert rows(version_history(one, **HOW)) == [("a", None, None, "202401", "999912")]
