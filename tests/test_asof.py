import random
from datetime import datetime, timedelta

import pytest

from minespark.operators.asof import attributes_as_of

E = "k string, id long, t timestamp_ntz, p int, note string"
C = "k string, row long, known timestamp_ntz, p int, note string"
HOW = {"key": "k", "event_id": "id", "event_time": "t", "event_period": "p", "change_id": "row", "known_at": "known", "change_period": "p"}
T0 = datetime(2024, 1, 1)


def brute(events, changes):
    out = []
    for k, i, t, p, _ in events:
        ok = [(cp, known, -row) for ck, row, known, cp, _ in changes if None not in (k, t, p, ck, row, known, cp) and ck == k and cp <= p and known <= t]
        if ok:
            out.append((i, -max(ok)[2]))
    return sorted(out)


def found(spark, events, changes):
    return sorted(tuple(r) for r in attributes_as_of(spark.createDataFrame(events, E), spark.createDataFrame(changes, C), **HOW).collect())


@pytest.mark.parametrize("partitions", [1, 7])
def test_against_brute_force(spark, partitions):
    rnd = random.Random(partitions)
    hot = lambda: "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(6)}"
    maybe = lambda x: None if rnd.random() < 0.05 else x
    time = lambda: T0 + timedelta(hours=rnd.randrange(60))
    events = [(maybe(hot()), i, maybe(time()), maybe(rnd.randrange(5)), "e") for i in range(400)]
    changes = [(maybe(hot()), i, maybe(time()), maybe(rnd.randrange(5)), "c") for i in range(500)]
    changes += rnd.sample(changes, 40)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, events, changes) == brute(events, changes)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_small_batches_carry_state(spark):
    rnd = random.Random(5)
    events = [("a", i, T0 + timedelta(minutes=rnd.randrange(300)), rnd.randrange(90), "") for i in range(300)]
    changes = [("a", i, T0 + timedelta(minutes=rnd.randrange(300)), rnd.randrange(90), "") for i in range(300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        assert found(spark, events, changes) == brute(events, changes)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ties_repeats_and_nulls(spark):
    t = T0
    events = [("a", 1, t, 5, ""), ("a", 1, t, 5, ""), ("a", 2, t - timedelta(seconds=1), 5, ""), (None, 3, t, 5, ""), ("a", 4, None, 5, ""), ("a", 5, t, None, "")]
    changes = [("a", 11, t, 5, ""), ("a", 10, t, 5, ""), ("a", 10, t, 5, ""), ("a", 9, t, 4, ""), ("a", 1, None, 5, ""), (None, 2, t, 5, "")]
    assert found(spark, events, changes) == [(1, 10), (1, 10)]


def test_empty_tables(spark):
    one = [("a", 1, T0, 5, "")]
    assert found(spark, [], []) == found(spark, one, []) == found(spark, [], one) == []
