"""Full snapshots: the state per period, what changed between them, and the history of versions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Periods up to which their list is collected: six-digit months, so a million at most.
MAX_PERIODS = 1_000_000
#: The end of a version that is still valid.
OPEN_END = "999912"


def latest_states(df: DataFrame, *, key: str, period: str, known_at: str, row_id: str, attrs: Sequence[str]) -> DataFrame:
    """(k, m, a0, a1, ...): of each key and period the row known latest; the smallest id on ties.

    A null `known_at` is earlier than all others. Rows with a null key or period belong to nothing.
    Pre-aggregated before its one shuffle, so a key with many deliveries costs its periods only.
    """
    row = F.struct(F.col(known_at), (-F.col(row_id)).alias("n"), *(F.col(a).alias(f"a{i}") for i, a in enumerate(attrs)))
    best = df.where(F.col(key).isNotNull() & F.col(period).isNotNull()).groupBy(F.col(key).alias("k"), F.col(period).alias("m")).agg(F.max(row).alias("r"))
    return best.select("k", "m", *(F.col(f"r.a{i}").alias(f"a{i}") for i in range(len(attrs))))


def period_order(df: DataFrame, period: str) -> DataFrame:
    """(m, i, next_m, prev_m) of the periods that occur: a local table, one row per period, for broadcasting."""
    found = sorted(r[0] for r in df.select(period).where(F.col(period).isNotNull()).distinct().limit(MAX_PERIODS + 1).collect())
    if len(found) > MAX_PERIODS:
        raise ValueError(f"more than {MAX_PERIODS} periods")
    rows = [(m, i, found[i + 1] if i + 1 < len(found) else None, found[i - 1] if i else None) for i, m in enumerate(found)]
    return F.broadcast(df.sparkSession.createDataFrame(rows, "m string, i int, next_m string, prev_m string"))


def snapshot_changes(
    df: DataFrame, *, key: str, period: str, known_at: str, row_id: str, attrs: Sequence[str], chunk_rows: int = 4
) -> DataFrame:
    """(period, key, change_kind): records added, removed or changed between consecutive snapshots.

    `attrs` are compared null-safely as they are given (normalise them before). The first period
    yields nothing; consecutive means next among the periods that occur. Repeated rows count once,
    ties of `known_at` go to the smallest `row_id`, null keys or periods belong to nothing, other
    columns are not read, an empty table gives no rows.

    How: the states are range-sorted by key. A key whose hash is 0 modulo `chunk_rows` ends a chunk, so
    the cuts depend on content alone and one insertion moves no other chunk. Each task sums two
    64-bit row hashes over each chunk of each snapshot; a chunk whose digest (count and both sums)
    equals that of the snapshot before is discarded with all its rows. Rows of the remaining
    chunks are joined by key where they lie: both snapshots' rows of a key stand side by side in the sorted range, so the full
    outer join needs no further shuffle.
    """
    months = period_order(df, period)
    a = [f"a{i}" for i in range(len(attrs))]
    values = [x for c in a for x in (F.col(c).isNull(), F.col(c))]
    states = latest_states(df, key=key, period=period, known_at=known_at, row_id=row_id, attrs=attrs).join(months.select("m", "i"), "m")
    hashed = states.select(
        "k", "i", (F.pmod(F.xxhash64("k"), F.lit(chunk_rows)) == 0).alias("cut"),
        F.xxhash64("k", *values).alias("h1"), F.xxhash64(F.lit(71), *values, "k").alias("h2"), *a,
    )
    n_periods = months.count()
    found = hashed.repartitionByRange("k").sortWithinPartitions("k", "i").mapInArrow(lambda it: _classified(it, n_periods), "k string, i int, change_kind string")
    return found.join(months.select("m", "i"), "i").select(F.col("m").alias(period), F.col("k").alias(key), "change_kind")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows in tables that end where a chunk does."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        cuts = np.flatnonzero(b.column("cut").to_numpy(zero_copy_only=False))
        if not len(cuts):
            held.append(b)
            continue
        # rows from the last cutting key on may go on in the next batch
        end = int(cuts[-1])
        last = b.column("k")[end].as_py()
        k = b.column("k")
        while end and k[end - 1].as_py() == last:
            end -= 1
        if end == 0 and held:
            held.append(b)
            continue
        yield pa.Table.from_batches([*held, b.slice(0, end)])
        held = [b.slice(end)]
    if held:
        yield pa.Table.from_batches(held)


def _wanted(t: pa.Table, n_periods: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(new rows, old rows, periods) of a stretch: rows of chunks whose digest differs from that of the snapshot before, and after."""
    n = t.num_rows
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    k = t.column("k")
    new_key = np.ones(n, bool)
    new_key[1:] = pc.not_equal(k.slice(1), k.slice(0, n - 1)).to_numpy()
    chunk = np.cumsum(new_key & t.column("cut").to_numpy())
    i = t.column("i").to_numpy().astype(np.int64)
    cell = chunk * n_periods + i
    cells, inverse = np.unique(cell, return_inverse=True)
    by = np.argsort(inverse, kind="stable")
    starts = np.searchsorted(inverse[by], np.arange(len(cells)))
    count = np.diff(np.append(starts, n))
    sums = [np.add.reduceat(t.column(h).to_numpy().view(np.uint64)[by], starts) for h in ("h1", "h2")]
    # a cell equals the one before it if that is the same chunk's of the period before, with the same digest
    same = np.zeros(len(cells), bool)
    same[1:] = (np.diff(cells) == 1) & (cells[1:] % n_periods > 0) & (count[1:] == count[:-1])
    for s in sums:
        same[1:] &= s[1:] == s[:-1]
    same_next = np.append(same[1:], False)
    place = cells % n_periods
    new, old = ~same & (place > 0), ~same_next & (place < n_periods - 1)
    return np.flatnonzero(new[inverse]), np.flatnonzero(old[inverse]), i


def _unmatched(batches: Iterator[pa.RecordBatch], n_periods: int) -> Iterator[pa.RecordBatch]:
    """The rows that are joined, once for each pair of snapshots whose chunks differ: (k, i of the later snapshot, new, attributes)."""
    for t in _stretches(batches):
        news, olds, i = _wanted(t, n_periods)
        for new, rows in ((True, news), (False, olds)):
            if len(rows):
                part = t.take(pa.array(rows))
                cols = {"k": part.column("k"), "i": pa.array((i[rows] + (not new)).astype(np.int32)), "new": pa.array(np.full(len(rows), new))}
                yield from pa.table(cols | {c: part.column(c) for c in part.column_names[5:]}).to_batches()


def _classified(batches: Iterator[pa.RecordBatch], n_periods: int) -> Iterator[pa.RecordBatch]:
    """(k, i, change_kind) of the keys of unmatched chunks: a key's rows follow each other by period, so a row's partner is its neighbour."""
    for t in _stretches(batches):
        news, olds, i = _wanted(t, n_periods)
        if not len(news) and not len(olds):
            continue
        k = t.column("k").combine_chunks()
        k = k.chunk(0) if isinstance(k, pa.ChunkedArray) else k
        n = len(k)
        follows = np.zeros(n + 1, bool)  # whether a row is its key's in the period after that of the row before
        follows[1:n] = pc.equal(k.slice(1), k.slice(0, n - 1)).to_numpy(zero_copy_only=False) & (i[1:] == i[:-1] + 1)
        both = news[follows[news]]
        changed = both[_differ(t, both, both - 1)]
        added, removed = news[~follows[news]], olds[~follows[olds + 1]]
        rows = np.concatenate([added, changed, removed])
        kinds = np.repeat(["added", "changed", "removed"], [len(added), len(changed), len(removed)])
        at = np.concatenate([i[added], i[changed], i[removed] + 1]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([k.take(pa.array(rows)), pa.array(at), pa.array(kinds, pa.string())], names=["k", "i", "change_kind"])


def _differ(t: pa.Table, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the attributes of rows a and b differ; null equals null, NaN equals NaN. What can't be compared as a value is by its two hashes."""
    out = np.zeros(len(a), bool)
    for name in t.column_names[5:]:
        c = t.column(name)
        if pa.types.is_nested(c.type):
            for h in ("h1", "h2"):
                x = t.column(h).to_numpy()
                out |= x[a] != x[b]
            continue
        x, y = c.take(pa.array(a)), c.take(pa.array(b))
        other = pc.fill_null(pc.not_equal(x, y), False)
        if pa.types.is_floating(c.type):
            other = pc.and_not(other, pc.fill_null(pc.and_(pc.is_nan(x), pc.is_nan(y)), False))
        out |= pc.or_(other, pc.not_equal(x.is_null(), y.is_null())).to_numpy(zero_copy_only=False) if len(a) else out
    return out


def version_history(
    df: DataFrame, *, key: str, period: str, known_at: str, row_id: str, attrs: Sequence[str], open_end: str = OPEN_END
) -> DataFrame:
    """(key, *attrs, valid_from, valid_to): the versions of each key with their first and last period.

    A version is a run, as long as possible, of consecutive periods in which the key is present with the
    same attributes (null is a value); `valid_to` is `open_end` if it reaches the last period of all. Ties,
    nulls, repeated rows and empty tables as in snapshot_changes.

    How: each snapshot is joined to the one before by a null-safe full outer join on key and period,
    which gives inserted, changed and deleted keys; of these change events the next one of the key
    (lead) ends a version. States are aggregated once, their shuffle serves both sides.
    """
    months = period_order(df, period)
    a = [f"a{i}" for i in range(len(attrs))]
    states = latest_states(df, key=key, period=period, known_at=known_at, row_id=row_id, attrs=attrs)
    now = states.select("k", "m", F.struct(*a).alias("now"))
    old = states.join(months, "m").where("next_m is not null").select("k", F.col("next_m").alias("m"), F.struct(*a).alias("old"))
    joined = now.join(old, ["k", "m"], "full_outer")
    event = F.when(F.col("old").isNull(), "inserted").when(F.col("now").isNull(), "deleted").when(~F.col("old").eqNullSafe(F.col("now")), "changed")
    events = joined.select("k", "m", "now", event.alias("event")).where("event is not null")
    following = F.lead("m").over(Window.partitionBy("k").orderBy("m"))
    versions = events.withColumn("end_m", following).where("event <> 'deleted'")
    ended = versions.join(months.select(F.col("m").alias("end_m"), "prev_m"), "end_m", "left")
    return ended.select(
        F.col("k").alias(key), *(F.col(f"now.{x}").alias(n) for x, n in zip(a, attrs)),
        F.col("m").alias("valid_from"), F.coalesce("prev_m", F.lit(open_end)).alias("valid_to"),
    )
