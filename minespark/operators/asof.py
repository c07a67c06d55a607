"""Attributes as known at event time: a distributed carry-forward join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minespark.runtime import small, written

_SCHEMA = "part string, pid int, k string, id long, p int, a_p int, a_t long, a_id long, first boolean"
_CHANGE, _EVENT = 0, 1


def attributes_as_of(
    events: DataFrame,
    changes: DataFrame,
    *,
    key: str,
    event_id: str,
    event_time: str,
    event_period: str,
    change_id: str,
    known_at: str,
    change_period: str,
) -> DataFrame:
    """For each event the change row of its entity that was valid and already known: (event_id, change_id).

    Usable are changes of the same key whose period is not after the event's and whose `known_at`
    is not after the event's time. Of these: the latest period, within it the latest `known_at`,
    then the smallest `change_id`. Both inputs name the entity by the column `key`; ids are bigint,
    periods whole numbers that order as time does.

    How: events and changes are united and range-sorted by (key, time, changes before events, period, id),
    so that a key with any share of the rows spreads over many tasks. Each task carries the last known
    row per period forward through its range. What a task knows of its last key (at most one row per
    period) is carried into the following tasks by a running maximum over those few rows.

    An event with a null key, time or period, and one without a usable change, gives no row; a change
    with a null in any of its four columns is never usable. Repeated events count each by itself,
    repeated changes give the smallest id. Other columns are not read; empty inputs give no rows.
    """
    kinds = {dict(events.dtypes)[event_time], dict(changes.dtypes)[known_at]}
    as_time = (lambda c: c) if len(kinds) == 1 else (lambda c: c.cast("timestamp"))

    def rows(df: DataFrame, kind: int, t: str, p: str, i: str) -> DataFrame:
        cols = [F.col(key).cast("string").alias("k"), as_time(F.col(t)).alias("t"), F.lit(kind).cast("tinyint").alias("kind")]
        return df.select(*cols, F.col(p).cast("int").alias("p"), F.col(i).cast("long").alias("id")).dropna()

    both = rows(changes, _CHANGE, known_at, change_period, change_id).unionByName(rows(events, _EVENT, event_time, event_period, event_id))
    order = [F.col("k"), F.col("t"), F.col("kind"), F.col("p"), F.col("id").desc()]
    scanned = both.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_carry_forward, _SCHEMA)
    parts = written(scanned, "asof", ["part"])

    local = F.when(F.col("a_id").isNotNull(), F.struct("a_p", "a_t", (-F.col("a_id")).alias("a_n")))
    inner = parts.where("part = 'event' and not first").select("id", local.alias("best"))
    carried = _carried(parts.where("part = 'state'"))
    reach = F.array_max(F.filter("known", lambda x: x["a_p"] <= F.col("p")))
    first = parts.where("part = 'event' and first").join(small(carried), ["pid", "k"], "left").select("id", F.greatest(local, reach).alias("best"))
    return inner.unionByName(first).where("best is not null").select(F.col("id").alias(event_id), (-F.col("best.a_n")).alias(change_id))


def _carried(state: DataFrame) -> DataFrame:
    """(pid, k, known): what the tasks before task pid know of its first key, best row per period.

    `state` has, of each task, its first key (a_id null) and its last key's best row per period:
    at most tasks x periods rows, whatever the keys' sizes.
    """
    seen = state.where("a_id is not null")
    places = state.where("a_id is null").select("pid", "k").unionByName(seen.select("pid", "k")).distinct()
    grid = places.join(seen.select("k", "a_p").distinct(), "k").join(seen.select("pid", "k", "a_p", "a_t", "a_id"), ["pid", "k", "a_p"], "left")
    before = Window.partitionBy("k", "a_p").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    best = F.max(F.when(F.col("a_id").isNotNull(), F.struct("a_t", (-F.col("a_id")).alias("a_n")))).over(before)
    known = grid.withColumn("b", best).where("b is not null").groupBy("pid", "k")
    return known.agg(F.collect_list(F.struct("a_p", F.col("b.a_t").alias("a_t"), F.col("b.a_n").alias("a_n"))).alias("known"))


def _carry_forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's range. The state between batches is the last key's best row per period."""
    pid = TaskContext.get().partitionId()
    first_key: str | None = None
    key: str | None = None
    state: dict[int, tuple[int, int]] = {}
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column("k").combine_chunks() if isinstance(b.column("k"), pa.ChunkedArray) else b.column("k")
        n = b.num_rows
        t = b.column("t").cast(pa.timestamp("us")).cast(pa.int64()).to_numpy() if b.column("t").type.tz is None else b.column("t").cast(pa.int64()).to_numpy()
        kind, p, ids = (b.column(x).to_numpy() for x in ("kind", "p", "id"))
        new = np.ones(n, bool)
        new[1:] = pc.not_equal(k.slice(1), k.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        head = k[0].as_py()
        if first_key is None:
            first_key = head
            yield _rows("state", pid, [head], [0], [0], [None], [None], [None], [True])
        kept = sorted(state.items(), key=lambda x: x[1][0]) if key == head else []
        m = len(kept)
        if m:  # the carried state goes before the batch, as changes of its first key
            t = np.concatenate([np.array([x[1][0] for x in kept], np.int64), t])
            kind = np.concatenate([np.zeros(m, kind.dtype), kind])
            p = np.concatenate([np.array([x[0] for x in kept], p.dtype), p])
            ids = np.concatenate([np.array([x[1][1] for x in kept], np.int64), ids])
            new = np.concatenate([[True], np.zeros(m - 1, bool), [False], new[1:]])
        seg = np.cumsum(new) - 1
        start = np.flatnonzero(new)
        change = kind == _CHANGE
        at = _last_usable(seg, start[seg], change, p)
        ev = np.flatnonzero(~change)
        if len(ev):
            src = at[ev]
            has = src >= 0
            null = ~has
            take = np.where(has, src, 0)
            same = pc.equal(k, first_key).to_numpy(zero_copy_only=False)[ev - m]
            cols = [pa.array(["event"] * len(ev)), pa.array(np.full(len(ev), pid, np.int32)), k.take(pa.array(ev - m)), pa.array(ids[ev]), pa.array(p[ev].astype(np.int32))]
            cols += [pa.array(x[take].astype(d), mask=null) for x, d in ((p, np.int32), (t, np.int64), (ids, np.int64))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(same)], names=_NAMES)
        last = np.flatnonzero(change[start[-1] :]) + start[-1]
        key = k[n - 1].as_py()
        state = {int(p[i]): (int(t[i]), int(ids[i])) for i in last} if len(last) < 64 else _last_of_each(p, t, ids, last)
    if state:
        ps = list(state)
        yield _rows("state", pid, [key] * len(ps), [0] * len(ps), [0] * len(ps), ps, [state[x][0] for x in ps], [state[x][1] for x in ps], [False] * len(ps))


_NAMES = ["part", "pid", "k", "id", "p", "a_p", "a_t", "a_id", "first"]


def _rows(part, pid, k, i, p, a_p, a_t, a_id, first) -> pa.RecordBatch:
    cols = [pa.array([part] * len(k)), pa.array([pid] * len(k), pa.int32()), pa.array(k), pa.array(i, pa.int64()), pa.array(p, pa.int32()), pa.array(a_p, pa.int32()), pa.array(a_t, pa.int64()), pa.array(a_id, pa.int64()), pa.array(first, pa.bool_())]
    return pa.RecordBatch.from_arrays(cols, names=_NAMES)


def _last_of_each(p, t, ids, rows) -> dict[int, tuple[int, int]]:
    periods, back = np.unique(p[rows][::-1], return_index=True)
    return {int(x): (int(t[rows[len(rows) - 1 - j]]), int(ids[rows[len(rows) - 1 - j]])) for x, j in zip(periods, back)}


def _last_usable(seg: np.ndarray, start: np.ndarray, change: np.ndarray, p: np.ndarray) -> np.ndarray:
    """For each row the position of the best change at or before it in its segment, -1 if none.

    Rows are in time order. Most events may use the greatest period known so far; one running
    maximum answers them. The rest are answered period by period, over their segments only.
    """
    n = len(seg)
    i = np.arange(n)
    code = np.unique(p, return_inverse=True)[1] + 1
    wide = int(code.max()) + 1
    top = np.maximum.accumulate(seg * wide + np.where(change, code, 0)) - seg * wide
    at = np.maximum.accumulate(np.where(change & (code == top), i, -1))
    at = np.where(at >= start, at, -1)
    late = ~change & (at >= 0) & (p[at] > p)
    if late.any():
        rows = np.isin(seg, np.unique(seg[late]))
        at[late] = -1
        sub = np.flatnonzero(rows)
        c, pp, s, left = change[sub], p[sub], start[sub], late[sub]
        for period in np.unique(pp[c])[::-1]:
            if not left.any():
                break
            pos = np.maximum.accumulate(np.where(c & (pp == period), sub, -1))
            hit = left & (pp >= period) & (pos >= s)
            at[sub[hit]] = pos[hit]
            left &= ~hit
    return at
