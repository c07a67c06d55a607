"""Exact column profiles of loads from one range sort of all values, and distances between loads."""

from __future__ import annotations

import struct
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, IntegralType

from minespark.runtime import small, written

#: Rows that a task aggregates at a time before it hands on (value, load, count).
_FLUSH_ROWS = 50_000
#: Values (of all columns) in the sample that the range bounds are taken from; they decide on the tasks' sizes only.
_SAMPLE = 200_000
#: Counts in a range, about, and counts of a range that a task gathers before it combines those of equal value and load.
_RANGE_ROWS, _COMBINE_ROWS = 250_000, 1_000_000
#: Columns that one sort takes: their number and 56 bits of a value make a sort key of 63 bits.
_COLUMNS, _BITS = 128, 56
_MASK, _ZERO = (1 << _BITS) - 1, 1 << (_BITS - 1)


@dataclass(frozen=True)
class ColumnRule:
    """How a column is profiled. `number`: ordered statistics; `coded`: value shares are kept; `pattern`: RE2."""

    name: str
    number: bool = False
    coded: bool = False
    pattern: str | None = None


@dataclass(frozen=True)
class Profile:
    """`stats`: one row per (load, column). `coded`: (c, load, s, n). `curves`: (pid, c, run): the counts of number columns
    by value and load, one run in the order of the values for each range and column. `parts`: (pid, c, load, n) of number columns, whose prefix sums over pid are the rank offsets."""

    rules: tuple[ColumnRule, ...]
    stats: DataFrame
    coded: DataFrame
    curves: DataFrame
    parts: DataFrame


@dataclass(frozen=True)
class _Column:
    """A column as it is sorted: text, a number of some decimal scale, or a double (scale None)."""

    number: bool
    scale: int | None
    coded: bool
    pattern: str | None


def profile(df: DataFrame, rules: list[ColumnRule], load: str, quantile: tuple[int, int] = (3, 4)) -> Profile:
    """Profile the columns of `rules` per value of `load` (bigint); rows with a null load are left out.

    stats has load, c (place of the column in rules), n_rows, n_null, n_distinct, n_bad (non-null values
    that don't match the pattern), n_zero, n_neg, lo, hi and q, the smallest value that at least
    the share `quantile` (a fraction) of the non-null values do not exceed; the last five are null for
    columns that aren't numbers, the last three without values. Values count as they are spelled, repeated rows included.
    Numbers are compared exactly, whole numbers and decimals at their own scale, all others as doubles (NaN above all, -0 as 0; text that is no number is an error). lo, hi and q
    are decimals of the columns' greatest scale, or doubles if any number column is. An empty table gives no rows; other columns are not read.

    How: each task unpivots and counts its rows by (column, value, load) in Arrow, so a value or load
    with any share of the rows is small before the shuffle. The counts are range-sorted by column
    and value, in bounds taken from a sample of the rows: a task sorts its counts and hands on one packed run for each range; where
    a range's runs meet, the counts of equal values and loads are added as they come, so that a value in all tasks is one row too. Equal values meet in one
    range, so distinct values add up over ranges. Each range gives its
    counts by column and load; their prefix sums say in which range a rank lies, and only that
    range's run is summed to find the quantile. A sort key is a number: the column, then
    56 bits of the value; what they don't hold of a value goes beside it and is compared only where keys are equal.
    """
    rules = tuple(rules)
    if len(rules) > _COLUMNS:
        a, b = (profile(df, list(x), load, quantile) for x in (rules[:_COLUMNS], rules[_COLUMNS:]))
        moved = lambda x: x.withColumn("c", F.col("c") + _COLUMNS)
        kind = "double" if "double" in (dict(a.stats.dtypes)["q"], dict(b.stats.dtypes)["q"]) else None
        stats = [x.withColumns({y: F.col(y).cast(kind) for y in ("lo", "hi", "q")}) if kind else x for x in (a.stats, moved(b.stats))]
        return Profile(rules, stats[0].unionByName(stats[1]), *(getattr(a, x).unionByName(moved(getattr(b, x))) for x in ("coded", "curves", "parts")))
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = tuple(_Column(r.number, _scale(types[r.name]) if r.number else 0, r.coded, r.pattern) for r in rules)
    shown = "double" if any(c.number and c.scale is None for c in columns) else f"decimal(38,{max([4, *(c.scale for c in columns if c.number)])})"
    cols = [_plain(r, types[r.name]).alias(f"v{i}") for i, r in enumerate(rules)]
    rows = df.where(F.col(load).isNotNull()).select(F.col(load).cast("long").alias("load"), *cols)
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(rows, columns, ranges)
    runs = rows.mapInArrow(lambda it: _count_values(it, columns, bounds), f"r int, {_RUN}")
    ranged = runs.repartitionById(len(bounds) + 1, F.col("r")).sortWithinPartitions("r")
    parts_of = f"kind string, pid int, c int, load long, s string, run struct<{_RUN.replace(' binary', ':binary')}>, n long, n_distinct long, n_null long, n_bad long, n_zero long, n_neg long, lo {shown}, hi {shown}"
    out = written(ranged.mapInArrow(lambda it: _measure(it, columns, shown), parts_of), "profile", ["kind"])
    parts = out.where("kind = 'part'")
    numbers = [i for i, r in enumerate(rules) if r.number]
    sums = ["n", "n_distinct", "n_null", "n_bad", "n_zero", "n_neg"]
    total = parts.groupBy("load", "c").agg(*(F.sum(x).alias(x) for x in sums), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    number_parts = parts.where(F.col("c").isin(numbers)).select("pid", "c", "load", "n")
    curves = out.where("kind = 'curve'").select("pid", "c", "run")
    place = _places(number_parts, *quantile).groupBy("pid", "c").agg(F.collect_list(F.struct("load", "local")).alias("asked"))  # loads at most
    q = written(curves.join(small(place), ["pid", "c"]).mapInArrow(lambda it: _find(it, columns, shown), f"load long, c int, q {shown}"), "profile-quantiles")
    is_number = F.col("c").isin(numbers)
    stats = total.join(small(q), ["load", "c"], "left").select(
        "load", "c", (F.col("n") + F.col("n_null")).alias("n_rows"), "n_null", "n_distinct", "n_bad",
        *(F.when(is_number, F.col(x)).alias(x) for x in ("n_zero", "n_neg", "lo", "hi", "q")),
    )
    return Profile(rules, stats, out.where("kind = 'coded'").select("c", "load", "s", "n"), curves, number_parts)


def _scale(t: DataType) -> int | None:
    return 0 if isinstance(t, IntegralType) else t.scale if isinstance(t, DecimalType) else None


def _plain(r: ColumnRule, t: DataType):
    """The column as one of the types that are sorted."""
    if not r.number:
        return F.col(r.name).cast("string")
    return F.col(r.name).cast("long") if isinstance(t, IntegralType) else F.col(r.name) if isinstance(t, DecimalType) else F.col(r.name).cast("double")


def _bounds(rows: DataFrame, columns: tuple[_Column, ...], ranges: int) -> list[tuple[int, bytes | None]]:
    """Values that part a sample of the different (value, load) evenly into `ranges`, or more if these would exceed _RANGE_ROWS.

    A bounded number of rows is sampled, whatever the table's size; the bounds decide on the tasks' sizes only.
    """
    n = rows.select("load").count()
    if not n or not columns:
        return []
    most = 2 * _SAMPLE // len(columns)
    share = min(1.0, most / 2 / n)
    sampled = (rows.sample(share, seed=1) if share < 1 else rows).limit(most)
    found = [_unpacked(*x) for x in zip(*(c.to_pylist() for c in sampled.mapInArrow(lambda it: _count_values(it, columns, []), f"r int, {_RUN}").select(*_FIELDS).toArrow().columns))]
    if not found:
        return []
    k, v = np.concatenate([x[0] for x in found]), pa.concat_arrays([x[1] for x in found])
    ranges = max(ranges, -(-int(len(k) / min(share, 1.0)) // _RANGE_ROWS))
    by = pc.sort_indices(pa.table({"k": k, "v": v}), sort_keys=[("k", "ascending"), ("v", "ascending")], null_placement="at_start").to_numpy()
    at = np.unique(by[[i * len(k) // ranges for i in range(1, ranges)]]) if ranges > 1 else np.zeros(0, np.int64)
    return sorted(set(zip(k[at].tolist(), v.take(pa.array(at, pa.int64())).to_pylist())), key=_order)


def _order(value: tuple[int, bytes | None]) -> tuple[int, bool, bytes]:
    """Of a key and its rest; null before any rest."""
    return value[0], value[1] is not None, value[1] or b""


def _places(parts: DataFrame, up: int, of: int) -> DataFrame:
    """(pid, c, load, local): in which range, and there at which rank, the share's value lies."""
    w = Window.partitionBy("load", "c")
    before = F.sum("n").over(w.orderBy("pid")) - F.col("n")
    rank = F.floor((F.sum("n").over(w) * up + (of - 1)) / of).cast("long")
    found = parts.where("n > 0").select("pid", "c", "load", before.alias("before"), rank.alias("rank"), "n")
    return found.where("before < rank and rank <= before + n").select("pid", "c", "load", (F.col("rank") - F.col("before")).alias("local"))


def ks_distances(p: Profile, pairs: DataFrame) -> DataFrame:
    """(load, earlier, c, ks): the exact Kolmogorov-Smirnov distance of each number column between two loads.

    `pairs` has load and earlier. The curves of both loads are merged value by value within each range's run,
    on top of the rank offsets of the ranges before; the greatest difference is the distance. Nothing of the curves is shuffled.
    Columns without values in either load give no row.
    """
    def ends(df: DataFrame) -> DataFrame:
        late = df.join(small(pairs.select("load", "earlier")), "load").withColumns({"n1": F.col("n"), "n0": F.lit(0).cast("long")})
        early = df.join(small(pairs.select(F.col("load").alias("later"), F.col("earlier").alias("load"))), "load")
        early = early.withColumnRenamed("load", "earlier").withColumnRenamed("later", "load").withColumns({"n1": F.lit(0).cast("long"), "n0": F.col("n")})
        return late.unionByName(early)

    sums = ends(p.parts).groupBy("load", "earlier", "c", "pid").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    w = Window.partitionBy("load", "earlier", "c")
    offset = sums.select(
        "load", "earlier", "c", "pid", *((F.sum(x).over(w.orderBy("pid")) - F.col(x)).alias(f"before_{x}") for x in ("n1", "n0")),
        *(F.sum(x).over(w).alias(f"all_{x}") for x in ("n1", "n0")),
    ).where("all_n1 > 0 and all_n0 > 0")
    asked = offset.groupBy("pid", "c").agg(F.collect_list(F.struct("load", "earlier", "before_n1", "before_n0", "all_n1", "all_n0")).alias("asked"))  # pairs at most
    gaps = p.curves.join(small(asked), ["pid", "c"]).mapInArrow(_gaps, "load long, earlier long, c int, ks double")
    return gaps.groupBy("load", "earlier", "c").agg(F.max("ks").alias("ks"))


def value_distances(p: Profile, pairs: DataFrame) -> DataFrame:
    """(load, earlier, c, distance): half the summed differences of the value shares of coded columns, where both loads have values."""
    total = p.coded.groupBy("c", "load").agg(F.sum("n").alias("all"))
    share = p.coded.join(total, ["c", "load"]).select("c", "load", "s", (F.col("n") / F.col("all")).alias("x"))
    pair = small(pairs.select("load", "earlier"))
    late = share.join(pair, "load").select("load", "earlier", "c", "s", "x")
    early = share.select("c", F.col("load").alias("earlier"), "s", (-F.col("x")).alias("x")).join(pair, "earlier").select("load", "earlier", "c", "s", "x")
    each = late.withColumn("side", F.lit(1)).unionByName(early.withColumn("side", F.lit(2)))
    diff = each.groupBy("load", "earlier", "c", "s").agg(F.sum("x").alias("x"), F.bit_or("side").alias("side"))
    both = diff.groupBy("load", "earlier", "c").agg((F.sum(F.abs("x")) / 2).alias("distance"), F.bit_or("side").alias("side"))
    return both.where("side = 3").drop("side")


def _count_values(batches: Iterator[pa.RecordBatch], columns: tuple[_Column, ...], bounds: list[tuple[int, bytes | None]]) -> Iterator[pa.RecordBatch]:
    """(range, run): the rows' counts by (column, value, load), aggregated _FLUSH_ROWS rows at a time."""
    if not columns:
        return
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= _FLUSH_ROWS:
            yield from _counted(pa.Table.from_batches(held), columns, bounds)
            held, n = [], 0
    if n:
        yield from _counted(pa.Table.from_batches(held), columns, bounds)


def _counted(t: pa.Table, columns: tuple[_Column, ...], bounds: list[tuple[int, bytes | None]]) -> Iterator[pa.RecordBatch]:
    found = []
    for i, column in enumerate(columns):
        v = t.column(f"v{i}")
        if column.number and column.scale is None:
            x = pc.fill_null(v, 0.0).to_numpy() + 0.0  # -0 as 0
            v = pa.chunked_array([pa.array(_ordered_bits(x), mask=v.is_null().to_numpy())])
        g = pa.table({"v": v, "load": t.column("load")}).group_by(["v", "load"], use_threads=False).aggregate([([], "count_all")])
        k, rest = _key(i, g.column("v").combine_chunks(), column)
        load, n = (g.column(x).to_numpy() for x in ("load", "count_all"))
        r = _range_of(k, rest, bounds)
        order = np.lexsort((load, k, r))
        found.append((r[order], k[order], rest.take(pa.array(order)), load[order], n[order]))
    r, k, load, n = (np.concatenate([x[i] for x in found]) for i in (0, 1, 3, 4))  # in order, as the columns are
    rest = pa.concat_arrays([x[2] for x in found])
    at = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
    runs = [_packed(k[a:z], rest.slice(a, z - a), load[a:z], n[a:z]) for a, z in zip(at, np.append(at[1:], len(r)))]
    yield pa.RecordBatch.from_arrays([pa.array(r[at]), *(pa.array([x[i] for x in runs], pa.binary()) for i in range(len(_FIELDS)))], names=["r", *_FIELDS])


#: A run of counts, packed: differences of the keys, loads, counts, lengths of the rests (-1: null), their bytes.
_FIELDS = ("k", "load", "n", "size", "v")
_RUN = ", ".join(f"{x} binary" for x in _FIELDS)


def _packed(k: np.ndarray, rest: pa.Array, load: np.ndarray, n: np.ndarray) -> tuple[bytes, ...]:
    size = pc.fill_null(pc.binary_length(rest), -1).to_numpy(zero_copy_only=False).astype(np.int32)
    return np.diff(k, prepend=0).tobytes(), load.astype(np.int64).tobytes(), n.astype(np.int64).tobytes(), size.tobytes(), b"".join(x for x in rest.drop_null().to_pylist())


def _unpacked(k: bytes, load: bytes, n: bytes, size: bytes, v: bytes) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(keys, rests, loads, counts)."""
    sizes = np.frombuffer(size, np.int32)
    offsets = np.append(0, np.cumsum(np.maximum(sizes, 0))).astype(np.int32)
    rest = pa.Array.from_buffers(pa.binary(), len(sizes), [pa.py_buffer(np.packbits(sizes >= 0, bitorder="little").tobytes()), pa.py_buffer(offsets), pa.py_buffer(v)])
    return np.cumsum(np.frombuffer(k, np.int64)), rest, np.frombuffer(load, np.int64), np.frombuffer(n, np.int64)


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    """64-bit numbers in the order of the doubles, NaN last."""
    bits = np.where(np.isnan(x), np.nan, x).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _key(i: int, v: pa.Array, column: _Column) -> tuple[np.ndarray, pa.Array]:
    """(sort key, rest): column, then 56 bits of the value's order; the rest is null where these tell the value, and its order decides where they don't.

    Numbers at their scale from 2^55 on, those beyond the bits as 1 or 2^56 - 1 with all of their 128 as rest; doubles by their ordered bits, the
    last byte as rest unless 0; text by its first seven bytes, all of a text that is longer, empty or has NUL as rest; null is 0.
    """
    n = len(v)
    null = v.is_null().to_numpy(zero_copy_only=False)
    if not column.number:
        return _text_key(i, v, null)
    rest: pa.Array | list = [None] * n
    if column.scale is None:
        bits = pc.fill_null(v, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        x = (bits >> 8) + _ZERO
        has = (bits & 255 != 0) & ~null
        offsets = np.append(0, np.cumsum(has)).astype(np.int32)
        last = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer((bits[has] & 255).astype(np.uint8).tobytes())])
        rest = pc.if_else(pa.array(has), last, pa.scalar(None, pa.binary()))
    else:
        if pa.types.is_decimal(v.type):
            words = np.frombuffer(v.cast(pa.decimal128(38, column.scale)).buffers()[1], np.int64).reshape(-1, 2)[v.offset : v.offset + n] if n else np.zeros((0, 2), np.int64)
            low, high = words[:, 0], words[:, 1]
        else:
            low = pc.fill_null(v, 0).to_numpy(zero_copy_only=False).astype(np.int64)
            high = low >> 63
        most = _ZERO - 2
        fits = (high == (low >> 63)) & (low >= -most) & (low <= most)
        x = np.where(fits, low, np.where(high < 0, -_ZERO + 1, _ZERO - 1)) + _ZERO
        for j in np.flatnonzero(~fits & ~null):
            rest[j] = ((int(high[j]) << 64 | int(low[j]) & 0xFFFFFFFFFFFFFFFF) + (1 << 127)).to_bytes(16, "big")
    return np.where(null, 0, x) | np.int64(i << _BITS), rest if isinstance(rest, pa.Array) else pa.array(rest, pa.binary())


def _text_key(i: int, v: pa.Array, null: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    n = len(v)
    full = pc.fill_null(v, "").cast(pa.binary())
    sizes = pc.binary_length(full).to_numpy(zero_copy_only=False).astype(np.int64)
    first = pc.binary_slice(full, 0, 7)
    taken = np.minimum(sizes, 7)
    data = np.frombuffer(first.buffers()[2], np.uint8) if taken.any() else np.zeros(0, np.uint8)
    at = np.cumsum(taken) - taken + (np.frombuffer(first.buffers()[1], np.int32)[first.offset] if n else 0)
    x, nul = np.zeros(n, np.int64), np.zeros(n, bool)
    for b in range(7):
        has = np.flatnonzero(taken > b)
        byte = data[at[has] + b]
        x[has] |= byte.astype(np.int64) << (48 - 8 * b)
        nul[has] |= byte == 0
    told = null | ((sizes > 0) & (sizes <= 7) & ~nul)
    return x | np.int64(i << _BITS), pc.if_else(pa.array(told), pa.scalar(None, pa.binary()), full)


def _range_of(k: np.ndarray, rest: pa.Array, bounds: list[tuple[int, bytes | None]]) -> np.ndarray:
    """How many bounds are not above each value."""
    bk = np.array([b[0] for b in bounds], np.int64)
    r = np.searchsorted(bk, k, side="left").astype(np.int32)
    tie = np.flatnonzero(np.searchsorted(bk, k, side="right") > r)
    if len(tie):
        order = [_order(b) for b in bounds]
        for j, x in zip(tie, rest.take(pa.array(tie)).to_pylist()):
            r[j] = bisect_right(order, _order((int(k[j]), x)))
    return r


def _texts(k: np.ndarray, rest: pa.Array) -> pa.Array:
    """The texts of keys and rests; null where the value is null."""
    n = len(k)
    x = k & _MASK
    bytes_ = ((x[:, None] >> np.arange(48, -1, -8, dtype=np.int64)) & 255).astype(np.uint8)
    used = bytes_ != 0
    offsets = np.zeros(n + 1, np.int32)
    np.cumsum(used.sum(1), out=offsets[1:])
    told = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(bytes_[used].tobytes())])
    out = pc.if_else(pa.array(x == 0), pa.scalar(None, pa.binary()), told)
    return pc.if_else(rest.is_valid(), rest, out).cast(pa.string())


def _number(k: int, rest: bytes | None, column: _Column) -> Decimal | float:
    """The number of a key and its rest."""
    x = (k & _MASK) - _ZERO
    if column.scale is None:
        bits = x << 8 | (rest[0] if rest else 0)
        return struct.unpack("<d", struct.pack("<q", bits ^ (bits >> 63 & 0x7FFFFFFFFFFFFFFF)))[0]
    x = x if rest is None else int.from_bytes(rest, "big") - (1 << 127)
    return Decimal((x < 0, tuple(map(int, str(abs(x)))), -column.scale))


def _shown_type(shown: str) -> pa.DataType:
    return pa.float64() if shown == "double" else pa.decimal128(38, int(shown[11:-1]))


def _numbers(values: list, shown: str) -> pa.Array:
    if shown == "double":
        return pa.array([None if x is None else float(x) for x in values], pa.float64())
    return pa.array(values, _shown_type(shown))


def _rows(b: pa.RecordBatch) -> Iterator[tuple]:
    """(c, asked, keys, rests, loads, counts) of each run."""
    run = b.column("run")
    for c, asked, *packed in zip(b.column("c").to_pylist(), b.column("asked").to_pylist(), *(run.field(run.type.get_field_index(x)).to_pylist() for x in _FIELDS)):
        yield c, asked, *_unpacked(*packed)


def _find(batches: Iterator[pa.RecordBatch], columns: tuple[_Column, ...], shown: str) -> Iterator[pa.RecordBatch]:
    """(load, c, q): of each run the values at the asked ranks of its loads."""
    for b in batches:
        out: list[tuple] = []
        for c, asked, k, rest, load, n in _rows(b):
            by = np.argsort(load, kind="stable")
            ids, first = np.unique(load[by], return_index=True)
            upto = np.cumsum(n[by])
            for x in asked:
                a = first[np.searchsorted(ids, x["load"])]
                j = by[np.searchsorted(upto, (upto[a - 1] if a else 0) + x["local"])]
                out.append((x["load"], c, _number(int(k[j]), rest[int(j)].as_py(), columns[c])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), _numbers([x[2] for x in out], shown)], names=["load", "c", "q"])


def _gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(load, earlier, c, ks): of each run and asked pair the greatest difference of the cumulative shares."""
    for b in batches:
        out: list[tuple] = []
        for c, asked, k, rest, load, n in _rows(b):
            place = np.cumsum(_starts(pa.table({"k": k, "v": rest}), ("k", "v")))  # the same for equal values
            by = np.argsort(load, kind="stable")
            ids, first = np.unique(load[by], return_index=True)
            at = dict(zip(ids.tolist(), np.split(by, first[1:])))
            none = np.zeros(0, np.int64)
            for x in asked:
                sides = [at.get(x["load"], none), at.get(x["earlier"], none)]
                values = np.union1d(place[sides[0]], place[sides[1]])
                if not len(values):
                    continue
                upto = [np.append(0, np.cumsum(n[i]))[np.searchsorted(place[i], values, side="right")] for i in sides]
                gap = np.abs((x["before_n1"] + upto[0]) / x["all_n1"] - (x["before_n0"] + upto[1]) / x["all_n0"])
                out.append((x["load"], x["earlier"], c, float(gap.max())))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.float64()))], names=["load", "earlier", "c", "ks"])


_SUMS = ("n", "n_distinct", "n_null", "n_bad", "n_zero", "n_neg")


def _measure(batches: Iterator[pa.RecordBatch], columns: tuple[_Column, ...], shown: str) -> Iterator[pa.RecordBatch]:
    """Ranges, whose runs follow each other: counts per range, column and load, and the curves and coded values themselves."""
    now, held, rows = None, [], 0
    for b in batches:
        for r, *packed in zip(*(b.column(x).to_pylist() for x in ("r", *_FIELDS))):
            if r != now and held:
                yield from _measured(now, _combined(held), columns, shown)
                held, rows = [], 0
            now = r
            held.append(_unpacked(*packed))
            rows += len(held[-1][0])
            if rows >= _COMBINE_ROWS and len(held) > 1:
                held = [_combined(held)]
                rows = max(len(held[0][0]), _COMBINE_ROWS // 2)  # a range of more values combines each time as many again have come
    if held:
        yield from _measured(now, _combined(held), columns, shown)


def _combined(held: list[tuple]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(keys, rests, loads, counts) of all runs as one, in the order of key and rest; equal values and loads once."""
    t = pa.table({"k": np.concatenate([x[0] for x in held]), "v": pa.concat_arrays([x[1] for x in held]), "load": np.concatenate([x[2] for x in held]), "n": np.concatenate([x[3] for x in held])})
    t = t.group_by(["k", "v", "load"], use_threads=False).aggregate([("n", "sum")])
    k, load, n = (t.column(x).to_numpy() for x in ("k", "load", "n_sum"))
    rest = t.column("v").combine_chunks()
    rest = rest.chunk(0) if isinstance(rest, pa.ChunkedArray) else rest
    order = np.argsort(k, kind="stable")
    s = k[order]
    same = np.append(False, s[1:] == s[:-1])
    same[:-1] |= same[1:]
    tie = np.flatnonzero(same & rest.is_valid().to_numpy(zero_copy_only=False)[order])
    if len(tie):  # keys with rests: these rows by rest too
        tie = np.flatnonzero(np.isin(s, s[tie]))
        part = order[tie]
        order[tie] = part[pc.sort_indices(pa.table({"k": k[part], "v": rest.take(pa.array(part))}), sort_keys=[("k", "ascending"), ("v", "ascending")], null_placement="at_start").to_numpy()]
    return k[order], rest.take(pa.array(order)), load[order], n[order]


def _starts(t: pa.Table, names: tuple[str, ...]) -> np.ndarray:
    """Where a row differs from the one before it; null equals null."""
    n = t.num_rows
    new = np.zeros(n, bool)
    new[0] = True
    for x in names:
        c = t.column(x).combine_chunks() if t.column(x).num_chunks != 1 else t.column(x).chunk(0)
        if c.null_count == n:
            continue
        a, b = c.slice(1), c.slice(0, n - 1)
        differs = pc.fill_null(pc.not_equal(a, b), False)
        if c.null_count:
            differs = pc.or_(differs, pc.not_equal(a.is_null(), b.is_null()))
        new[1:] |= differs.to_numpy(zero_copy_only=False)
    return new


def _measured(r: int, run: tuple, columns: tuple[_Column, ...], shown: str) -> Iterator[pa.RecordBatch]:
    k, rest, load, n = run
    c, x, told = k >> _BITS, k & _MASK, ~rest.is_valid().to_numpy(zero_copy_only=False)
    parts: list[tuple] = []
    edges = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
    for a, z in zip(edges, np.append(edges[1:], len(c))):
        column, ld, w, own, more = columns[c[a]], load[a:z], n[a:z], x[a:z], rest.slice(a, z - a)
        null = (own == 0) & told[a:z]
        full = ~null
        text = None
        if column.pattern is not None or column.coded:
            text = _texts(own, more) if not column.number else pa.array([None if e else _spelled(_number(int(i), v, column)) for e, i, v in zip(null, own, more.to_pylist())], pa.string())
        bad = zero = neg = np.zeros(len(ld), bool)
        if column.pattern is not None:
            bad = full & ~pc.fill_null(pc.match_substring_regex(text, column.pattern), False).to_numpy(zero_copy_only=False)
        if column.number:
            zero, neg = (own == _ZERO) & told[a:z], full & (own < _ZERO)
        ids, inv = np.unique(ld, return_inverse=True)
        each = [np.bincount(inv, np.where(mask, y, 0), len(ids)).astype(np.int64) for mask, y in ((full, w), (full, 1), (null, w), (bad, w), (zero, w), (neg, w))]
        ends: list = [[None] * len(ids)] * 2
        if column.number and full.any():
            where = np.flatnonzero(full)
            first = np.full(len(ids), -1)
            last = first.copy()
            last[inv[where]] = where  # values come in order
            first[inv[where[::-1]]] = where[::-1]
            ends = [[None if j < 0 else _number(int(own[j]), more[int(j)].as_py(), column) for j in side] for side in (first, last)]
        parts += zip([int(c[a])] * len(ids), ids.tolist(), *(y.tolist() for y in each), *ends)
        kept = int(full.sum())
        if column.coded and kept:
            yield from _out("coded", shown, {"pid": pa.array(np.full(kept, r, np.int32)), "c": pa.array(np.full(kept, c[a], np.int32)), "load": pa.array(ld[full]), "n": pa.array(w[full]), "s": text.filter(pa.array(full))}, kept)
        if column.number and kept:
            packed = _packed(k[a:z][full], more.filter(pa.array(full)), ld[full], w[full])
            one = pa.StructArray.from_arrays([pa.array([y], pa.binary()) for y in packed], names=list(_FIELDS))
            yield from _out("curve", shown, {"pid": pa.array([r], pa.int32()), "c": pa.array([int(c[a])], pa.int32()), "run": one}, 1)
    cols = {"pid": pa.array(np.full(len(parts), r, np.int32)), "c": pa.array([y[0] for y in parts], pa.int32()), "load": pa.array([y[1] for y in parts], pa.int64())}
    cols |= {name: pa.array([y[2 + i] for y in parts], pa.int64()) for i, name in enumerate(_SUMS)}
    cols |= {name: _numbers([y[8 + i] for y in parts], shown) for i, name in enumerate(("lo", "hi"))}
    yield from _out("part", shown, cols, len(parts))


def _spelled(x: Decimal | float) -> str:
    return format(x, "f") if isinstance(x, Decimal) else repr(x)


def _out(kind: str, shown: str, cols: dict, n: int) -> Iterator[pa.RecordBatch]:
    number = _shown_type(shown)
    run = pa.struct([(x, pa.binary()) for x in _FIELDS])
    kinds = {"pid": pa.int32(), "c": pa.int32(), "load": pa.int64(), "s": pa.string(), "run": run} | dict.fromkeys(_SUMS, pa.int64()) | {"lo": number, "hi": number}
    yield from pa.table({"kind": pa.array([kind] * n)} | {x: cols[x] if x in cols else pa.nulls(n, typ) for x, typ in kinds.items()}).to_batches()
