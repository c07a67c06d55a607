"""Score cutoffs that keep a target share per source: distributed quickselect."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minespark.runtime import BROADCAST_ROWS, small, written

log = logging.getLogger("minespark")

#: Values in one local median; a task with more gives several.
_CHUNK = 1 << 20
#: The candidates are rewritten when at most one in so many is left, if so many rows are spared in each later round.
_REWRITE, _SPARED = 4, 1 << 20

#: Infinite scores are scores, so open ends are null.
_INSIDE = "(lo is null or s > lo) and (hi is null or s < hi)"
_PART = "g long, n_gt long, n_eq long, n_lt long, m_gt double, m_lt double"


def keep_cutoffs(records: DataFrame, targets: DataFrame, *, group: Sequence[str], score: str, permille: str, on: Sequence[str] | None = None) -> DataFrame:
    """(*group, cutoff, n_kept): per group the greatest occurring score that keeps the target share.

    n_kept, the records at or above the cutoff, satisfies n_kept * 1000 >= records * permille. `targets`
    gives `permille` by the columns `on` (default: all of `group`); groups without a target or without
    a record give no row; a target above 1000 cannot be met and gives nulls; a null target gives no row.
    Records with a null or NaN score or a null in `group` do not count. Ties share a cutoff. Each row of
    `records` is one record; other columns are not read.

    How: quickselect for all groups at once, to the end: every group goes through rounds until its rank is
    isolated, a group of one record too. Each round, every task gives of each group's remaining
    candidates the counts above, at and below the pivot and the medians of both sides; the counts, summed,
    discard a side, and the weighted median of the other side's medians is the next pivot (at least a
    quarter of the candidates goes each round). Only these few numbers are shuffled, by group, once a round. A group
    of any size spreads over the tasks as its records lie. The candidates are rewritten
    when three quarters are gone (and a million or more), so all rounds together read about twice a large table.
    """
    own = {c: f"_g{i}" for i, c in enumerate(group)}  # no name of the caller's can clash
    on = [own[c] for c in on or group]
    names, group = list(group), list(own.values())
    wanted = targets.where(F.col(permille).isNotNull()).groupBy(*(F.col(c).alias(x) for c, x in own.items() if x in on)).agg(F.max(permille).alias("permille"))
    valid = records.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))).select(*(F.col(c).alias(x) for c, x in own.items()), F.col(score).cast("double").alias("s"))
    cand, state = _numbered(valid.dropna(subset=group).join(small(wanted.select(*on)), on, "left_semi"), wanted, group, on)
    held, settled = None, []
    for at in range(1 << 20):
        settled.append(state.where("done"))
        state = state.where(~F.col("done"))
        n_open, n_left = state.agg(F.count(F.lit(1)), F.coalesce(F.sum("left"), F.lit(0))).first()
        if not n_open:
            log.info("cutoffs: %d rounds", at)
            break
        live = F.broadcast(state) if n_open <= BROADCAST_ROWS else state
        inside = cand.join(live.select("g", "lo", "hi", "pivot"), "g").where(_INSIDE)
        held = held or n_left
        if n_left * _REWRITE <= held and held - n_left >= _SPARED:
            cand, held = written(inside.select("g", "s"), "cutoff-candidates"), n_left
            inside = cand.join(live.select("g", "pivot"), "g")
        state = written(_narrowed(live, inside.select("g", "s", "pivot").mapInArrow(_sides, _PART)), "cutoff-state")
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    return out.select(*(F.col(x).alias(c) for c, x in zip(names, group)), "cutoff", "n_kept")


def _numbered(kept: DataFrame, wanted: DataFrame, group: list[str], on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(candidates, state): the scores under a number of their group, its hash, and each group's state before the first round.

    Two groups of one hash (some 2^-64 a pair) are noticed, and numbered again with another seed.
    """
    seed = 0
    while True:
        named = written(kept.select(*group, F.xxhash64(F.lit(seed), *group).alias("g"), "s"), "cutoff-scores")
        name = F.struct(*group)
        sizes = written(named.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min(name).alias("x"), F.max(name).alias("y")), "cutoff-groups")
        if not sizes.where("x <> y").limit(1).count():
            break
        seed += 1
    need = F.greatest(F.lit(1), F.ceil(F.col("n") * F.col("permille") / 1000)).cast("long")
    none = F.lit(None).cast("double")
    state = sizes.select("g", "n", "x.*").join(small(wanted), on).select(
        *group, "g", F.col("n").alias("left"), need.alias("need"), (need > F.col("n")).alias("done"),
        F.lit(0).cast("long").alias("above"), none.alias("lo"), none.alias("hi"), F.lit(float("-inf")).alias("pivot"),
        none.alias("cutoff"), F.lit(None).cast("long").alias("n_kept"),
    )
    return named.select("g", "s"), written(state, "cutoff-state")


def _narrowed(state: DataFrame, parts: DataFrame) -> DataFrame:
    """The state of the open groups after a round: the side that holds the wanted rank, and the next pivot in it. One shuffle of the parts."""
    whole = Window.partitionBy("g")
    upto = lambda n, m: F.sum(n).over(whole.orderBy(m))
    ranked = parts.select(
        "*", upto("n_gt", "m_gt").alias("u_gt"), upto("n_lt", "m_lt").alias("u_lt"), *(F.sum(x).over(whole).alias(f"a_{x[2:]}") for x in ("n_gt", "n_lt")),
    )
    median = lambda x: F.min(F.when((F.col(f"n_{x}") > 0) & (F.col(f"u_{x}") * 2 >= F.col(f"a_{x}")), F.col(f"m_{x}"))).alias(f"p_{x}")
    round_ = ranked.groupBy("g").agg(*(F.sum(f"n_{x}").alias(x) for x in ("gt", "eq", "lt")), median("gt"), median("lt"))
    s = round_.join(state, "g")  # an open group has candidates, so none is lost
    rank = F.col("need") - F.col("above")
    up, at = F.col("gt") >= rank, (F.col("gt") < rank) & (F.col("gt") + F.col("eq") >= rank)
    down = F.col("gt") + F.col("eq") < rank
    pick = lambda name, *cases: _case(cases, F.col(name)).alias(name)
    return s.select(
        *[c for c in state.columns if c not in ("left", "done", "above", "lo", "hi", "pivot", "cutoff", "n_kept")],
        pick("left", (up, F.col("gt")), (down, F.col("lt"))),
        pick("done", (at, F.lit(True))),
        pick("above", (down, F.col("above") + F.col("gt") + F.col("eq"))),
        pick("lo", (up, F.col("pivot"))),
        pick("hi", (down, F.col("pivot"))),
        pick("pivot", (up, F.col("p_gt")), (down, F.col("p_lt"))),
        pick("cutoff", (at, F.col("pivot"))),
        pick("n_kept", (at, F.col("above") + F.col("gt") + F.col("eq"))),
    ).select(*state.columns)


def _case(cases, other):
    out = None
    for when, then in cases:
        out = F.when(when, then) if out is None else out.when(when, then)
    return out.otherwise(other)


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each group in the task: counts above, at and below its pivot, and the medians of both sides."""
    held, n = [], 0
    for b in batches:
        held.append(tuple(b.column(c).to_numpy() for c in ("g", "s", "pivot")))
        n += b.num_rows
        if n >= _CHUNK:
            yield _medians(held)
            held, n = [], 0
    if n:
        yield _medians(held)


def _medians(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    g, s, pivot = (np.concatenate(x) for x in zip(*held))
    side = (s > pivot).astype(np.int64) - (s < pivot) + 1
    ids, g = np.unique(g, return_inverse=True)
    order = np.lexsort((s, g * 3 + side))
    s, cell = s[order], (g * 3 + side)[order]
    at = np.searchsorted(cell, np.arange(3 * len(ids) + 1))
    count = np.diff(at).reshape(-1, 3)
    middle = s[np.minimum(at[:-1] + np.maximum(np.diff(at) - 1, 0) // 2, len(s) - 1)].reshape(-1, 3)
    cols = [pa.array(ids), *(pa.array(count[:, i]) for i in (2, 1, 0)), *(pa.array(middle[:, i]) for i in (2, 0))]
    return pa.RecordBatch.from_arrays(cols, names=["g", "n_gt", "n_eq", "n_lt", "m_gt", "m_lt"])
