"""Long exact spans shared between records: a count-min prefilter, then exact grouping of windows."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minespark.runtime import written

#: Rows of the sketch, and cells in each row for each expected anchor.
DEPTH, CELLS_PER_ANCHOR = 2, 8
#: Cells in a row of one slice of the sketch, which one task holds, and the fewest slices.
_SLICE, _LEAST_SLICES = 1 << 23, 64
#: Code points, and rows, of a block at most: the texts whose anchors are looked up together.
_BLOCK, _BLOCK_ROWS = 1 << 20, 100_000
#: Sketch entries that a task combines before it hands them on.
_COUNT_AT_ONCE = 1 << 22
#: Code points that a task hashes at once, and candidate windows that it groups before handing them on.
_HASH_AT_ONCE, _GROUP_AT_ONCE = 1 << 18, 1 << 21

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_ODD = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


@dataclass(frozen=True)
class _Plan:
    """Lengths of windows and grams, and the sketch: `slices` parts of DEPTH x `width` cells, each of its own anchors."""

    length: int
    gram: int
    slices: int
    width: int
    block: int

    def keys(self, anchor: np.ndarray) -> np.ndarray:
        """slice << 32 | 32 bits of each anchor; mixed again, since least hashes crowd near 0."""
        x = _mix(anchor ^ _SALT3)
        return ((x >> np.uint64(32)) * np.uint64(self.slices) >> np.uint64(32)) << np.uint64(32) | x & np.uint64(0xFFFFFFFF)

    def cells(self, low: np.ndarray, row: int) -> np.ndarray:
        """The cells of a row of a slice, by the lower 32 bits of the keys."""
        h = (low.astype(np.uint64) + np.uint64(1)) * _ODD[row] + _ODD[row + 2]
        return ((h >> np.uint64(32)) * np.uint64(self.width) >> np.uint64(32)).astype(np.int64) + row * self.width


def shared_spans(df: DataFrame, *, doc_id: str, text: str, min_length: int = 100, cells_per_anchor: float = CELLS_PER_ANCHOR, block: int = _BLOCK) -> DataFrame:
    """(doc_id, n_shared): code points of each text in some stretch of `min_length` or more that another record has too.

    Records are told apart by `doc_id` (bigint): repetition inside one text, or of one record's row,
    doesn't count. Each code point counts once; nothing is normalised; only records with n_shared > 0 come out.
    Null ids and null, empty or short texts share nothing; an id with several texts has them laid over each other. Other columns are not read. min_length is 8 or more.

    How: every window of min_length code points is represented by its anchor, the least
    hash of the shorter grams in it: equal windows have equal anchors, and a text has about twenty times
    fewer anchors than windows. The count-min sketch is cut into slices by the anchor's hash; their number follows the
    corpus, so the load of a cell is the same at any size, and no task, and never the driver, holds more than one slice.
    The first pass cuts the rows into blocks as they come, folds equal texts of a block into one, counts the anchors of
    each task's texts in partial sketches (counts beyond 2 are not told apart), and writes these, the texts and each
    block's anchors. Partial sketches and anchors meet by slice: the partial ones are merged, then each block's anchors are estimated.
    An anchor's estimate is never below the number of texts with it, so only windows that occur in one text are dropped and none is lost.
    The second pass takes each block's texts with its surviving anchors and hashes the windows under them; a text that an
    earlier block has too (by a digest of 128 bits) is shared as a whole and has its windows hashed there only, for the ids of all.
    These are grouped by two independent hashes (96 bits), first within the task, where windows found in two records
    are settled and only one row of each hash goes on, then exactly over all tasks.
    Whatever the sketch lets through only costs shuffle: the result depends neither on its size (`cells_per_anchor`) nor on that
    of the blocks (`block` code points).
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & (F.length("text") >= min_length))
    total = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    gram = max(4, min_length * 5 // 8)
    cells = cells_per_anchor * 2 * total / (min_length - gram + 2)
    slices = max(_LEAST_SLICES, math.ceil(cells / _SLICE))
    plan = _Plan(min_length, gram, slices, max(1, math.ceil(cells / slices)), block)
    first = written(rows.mapInArrow(lambda it: _first(it, plan), _FIRST), "spans-first")
    by_slice = first.where("kind in ('look', 'sketch')").select("kind", "block", "slice", "x").repartition("slice").sortWithinPartitions("slice", F.desc("kind"))
    kept = by_slice.mapInArrow(lambda it: _estimate(it, plan), "block long, slice int, x binary")
    texts = first.where("kind = 'text'")
    equal = Window.partitionBy("x")  # digests of texts, at most one of each block
    copies = texts.select("block", "x", "lo", "hi", "size", F.min("block").over(equal).alias("in_block"), F.min("lo").over(equal).alias("least"), F.max("hi").over(equal).alias("most"))
    elsewhere = copies.where("block <> in_block").select("block", F.lit("copy").alias("kind"), "x")
    all_ids = copies.where("block = in_block and (least <> lo or most <> hi)").select("block", F.lit("ends").alias("kind"), F.col("least").alias("lo"), F.col("most").alias("hi"), "x")
    by_block = texts.select("block", "kind", "lo", "hi", "text", "x")
    for part in (kept.select("block", F.lit("keep").alias("kind"), "slice", "x"), elsewhere, all_ids):
        by_block = by_block.unionByName(part, allowMissingColumns=True)
    by_block = by_block.repartition("block").sortWithinPartitions("block", "kind")
    windows = by_block.mapInArrow(lambda it: _candidates(it, plan), "h1 long, h2 int, lo long, hi long, a int, z int")
    group = Window.partitionBy("h1", "h2")
    marked = windows.withColumn("least", F.min("lo").over(group)).withColumn("most", F.max(F.coalesce("hi", "lo")).over(group))
    runs = marked.where("z is not null or (a is not null and least <> most)").select(F.col("lo").alias("doc"), "a", F.coalesce("z", F.col("a") + min_length).alias("z"))
    # a text of two or more records is shared as a whole
    whole = copies.where("lo = hi and least <> most").select("lo", "size").unionByName(first.where("kind = 'same'").select("lo", "size"))
    runs = runs.unionByName(whole.select(F.col("lo").alias("doc"), F.lit(0).alias("a"), F.col("size").alias("z")))
    in_order = Window.partitionBy("doc").orderBy("a", "z")
    before = F.max("z").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("z") - F.greatest(F.col("a"), F.coalesce(before, F.lit(0)))
    out = runs.select("doc", F.greatest(fresh, F.lit(0)).alias("n")).groupBy(F.col("doc").alias("doc_id")).agg(F.sum("n").cast("long").alias("n_shared"))
    return out.where("n_shared > 0").withColumnRenamed("doc_id", doc_id)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x *= _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    x ^= x >> np.uint64(32)
    return x


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and its inverse modulo 2^64, i below n."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        x = np.full(n, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


class _Hashes:
    """Hashes of all windows of a stretch of code points, by prefix sums of c[i] * base^-i modulo 2^64."""

    def __init__(self, points: np.ndarray, base: int, salt: int):
        self.up, down = _powers(base, max(2 * _HASH_AT_ONCE, 1 << len(points).bit_length()))
        c = _mix(points.astype(np.uint64) + np.uint64(salt))
        self.sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(c * down[: len(c)], out=self.sums[1:])

    def all(self, length: int) -> np.ndarray:
        h = self.sums[length:] - self.sums[:-length]
        h *= self.up[: len(h)]
        return _mix(h)

    def at(self, start: np.ndarray, length: int) -> np.ndarray:
        return _mix((self.sums[start + length] - self.sums[start]) * self.up[start])


_BASE1, _SALT1, _BASE2, _SALT2, _SALT3 = 0x5851F42D4C957F2D, 0x1234567, 0x2545F4914F6CDD1D, 0x7654321, np.uint64(0x3C6EF372FE94F82B)


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours."""
    have, out = 1, h
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _stretches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(points, place, text number, lo, hi) of several texts at once, long texts in overlapping parts.

    place is each code point's place in its text; no window may cross where the text number changes.
    """
    held: list[tuple[np.ndarray, int, int, int, int]] = []
    n = no = 0

    def out():
        sizes = [len(x[0]) for x in held]
        ends = np.cumsum(sizes)
        at = np.repeat(np.array([x[1] for x in held]) - (ends - sizes), sizes) + np.arange(ends[-1])
        return (np.concatenate([x[0] for x in held]), at, *(np.repeat(np.array([x[i] for x in held], np.int64), sizes) for i in (2, 3, 4)))

    for b in batches:
        for lo, hi, text in zip(b.column("lo").to_pylist(), b.column("hi").to_pylist(), b.column("text").to_pylist()):
            no += 1
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            for start in range(0, max(1, len(points) - length + 1), _HASH_AT_ONCE):
                part = points[start : start + _HASH_AT_ONCE + length - 1]
                if n + len(part) > _HASH_AT_ONCE + length and held:
                    yield out()
                    held, n = [], 0
                held.append((part, start, no, lo, hi))
                n += len(part)
    if held:
        yield out()


def _anchored(points: np.ndarray, no: np.ndarray, length: int, gram: int) -> tuple[_Hashes, np.ndarray, np.ndarray]:
    """The first hashes, each window's anchor, and the windows that lie in one text."""
    hashes = _Hashes(points, _BASE1, _SALT1)
    anchor = _least(hashes.all(gram), length - gram + 1)
    inside = np.flatnonzero(no[: len(anchor)] == no[length - 1 :])
    return hashes, anchor, inside


#: kind: text (a text of a block, with its digest, length, least and greatest id), same (an id whose text another id of the block has, and its length),
#: look (a block's anchors in a slice), sketch (a task's cells in a slice).
_FIRST = "kind string, block long, slice int, lo long, hi long, size int, text string, x binary"


def _rows(kind: str, n: int, **cols: pa.Array) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "slice": pa.int32(), "lo": pa.int64(), "hi": pa.int64(), "size": pa.int32(), "text": pa.string(), "x": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([kind] * n), *(cols.get(c, pa.nulls(n, t)) for c, t in kinds.items())], names=["kind", *kinds])


def _first(batches: Iterator[pa.RecordBatch], plan: _Plan) -> Iterator[pa.RecordBatch]:
    """The rows as blocks of different texts, with their anchors and the task's partial sketches (see _FIRST)."""
    block = TaskContext.get().partitionId() << 32
    texts: dict[str, list[int]] = {}
    points = rows = held = 0
    counted: list[tuple[np.ndarray, np.ndarray]] = []

    def out():
        nonlocal held
        ids = list(texts.values())
        lo, hi = [min(x) for x in ids], [max(x) for x in ids]
        sizes, digests = [len(t) for t in texts], [hashlib.blake2b(t.encode(), digest_size=16).digest() for t in texts]
        cols = {"lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64()), "size": pa.array(sizes, pa.int32()), "text": pa.array(list(texts), pa.string()), "x": pa.array(digests, pa.binary())}
        batch = _rows("text", len(ids), block=pa.array([block] * len(ids), pa.int64()), **cols)
        yield batch
        same = [(i, n) for n, x, a, z in zip(sizes, ids, lo, hi) if a != z for i in set(x)]
        if same:
            yield _rows("same", len(same), lo=pa.array([x[0] for x in same], pa.int64()), size=pa.array([x[1] for x in same], pa.int32()))
        keys, texts_with = _block_anchors(batch, plan)
        if len(keys):
            at, slices, edges = _slices(keys)
            low = pa.py_buffer((keys & np.uint64(0xFFFFFFFF)).astype(np.uint32))
            x = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((edges * 4).astype(np.int32)), low])
            yield _rows("look", len(at), block=pa.array([block] * len(at), pa.int64()), slice=pa.array(slices), x=x)
            counted.append((keys, texts_with))
            held += len(keys)

    for b in batches:
        for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            if text not in texts:
                texts[text] = []
                points += len(text)
            texts[text].append(i)
            rows += 1
            if points >= plan.block or rows >= _BLOCK_ROWS:
                yield from out()
                texts, points, rows, block = {}, 0, 0, block + 1
                if held * DEPTH >= _COUNT_AT_ONCE:
                    yield _partial(counted, plan)
                    counted, held = [], 0
    if texts:
        yield from out()
    if held:
        yield _partial(counted, plan)


def _slices(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted keys: where a slice begins, the slices, and the edges between them."""
    s = (keys >> np.uint64(32)).astype(np.int32)
    at = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    return at, s[at], np.append(at, len(keys))


def _block_anchors(texts: pa.RecordBatch, plan: _Plan) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a block's anchors, sorted, and in how many texts each is."""
    found = [np.zeros(0, np.uint64)]
    for points, _, no, _, _ in _stretches(iter([texts]), plan.length):
        if len(points) < plan.length:
            continue
        _, anchor, inside = _anchored(points, no, plan.length, plan.gram)
        a, d = anchor[inside], no[inside]
        for by_text in (False, True):  # neighbours mostly have the same anchor, so there is less to sort then
            if by_text:
                order = np.lexsort((a, d))
                a, d = a[order], d[order]
            first = np.ones(len(a), bool)
            first[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
            a, d = a[first], d[first]
        found.append(plan.keys(a))
    return np.unique(np.concatenate(found), return_counts=True)


def _partial(counted: list[tuple[np.ndarray, np.ndarray]], plan: _Plan) -> pa.RecordBatch:
    """A task's sketch, by slices: its cells in order, each with whether it counts two or more."""
    keys, n = (np.concatenate(x) for x in zip(*counted))
    low = keys & np.uint64(0xFFFFFFFF)
    first = (keys >> np.uint64(32)).astype(np.int64) * (DEPTH * plan.width)
    cell = np.concatenate([first + plan.cells(low, row) for row in range(DEPTH)])
    order = np.argsort(cell, kind="stable")
    cell, n = cell[order], np.tile(n, DEPTH)[order]
    at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    twice = np.add.reduceat(n, at) >= 2
    cell = cell[at]
    of, local = np.divmod(cell, DEPTH * plan.width)
    begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    x = []
    for a, z in zip(begin, np.append(begin[1:], len(of))):
        x.append(zlib.compress(np.diff(local[a:z] * 2 + twice[a:z], prepend=0).astype(np.uint32).tobytes(), 1))
    return _rows("sketch", len(x), slice=pa.array(of[begin].astype(np.int32)), x=pa.array(x, pa.binary()))


def _estimate(batches: Iterator[pa.RecordBatch], plan: _Plan) -> Iterator[pa.RecordBatch]:
    """(block, slice, lower bits) of the anchors that the merged sketch counts twice. Rows come by slice, partial sketches first."""
    now, counts = None, None
    for b in batches:
        out: list[tuple[int, int, bytes]] = []
        for kind, block, s, x in zip(*(b.column(c).to_pylist() for c in ("kind", "block", "slice", "x"))):
            if s != now:
                now, counts = s, np.zeros(DEPTH * plan.width, np.uint8)
            if kind == "sketch":
                cell = np.cumsum(np.frombuffer(zlib.decompress(x), np.uint32), dtype=np.int64)
                counts[cell >> 1] = np.minimum(2, counts[cell >> 1] + 1 + (cell & 1))
                continue
            low = np.frombuffer(x, np.uint32)
            hit = np.ones(len(low), bool)
            for row in range(DEPTH):
                hit &= counts[plan.cells(low, row)] == 2
            if hit.any():
                out.append((block, s, low[hit].tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], names=["block", "slice", "x"])


def _with_kept(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """(keys of surviving anchors in order, texts) of each block that has such. A block's keys, the digests of texts to leave out, and the least and greatest
    ids of texts that other blocks have too, come before its texts."""
    now, keys, kept, copies, ends = None, [], None, set(), {}
    for b in batches:
        block, kinds = b.column("block").to_numpy(), b.column("kind").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (kinds[1:] != kinds[:-1])))
        for a, z in zip(edges, np.append(edges[1:], len(block))):
            if block[a] != now:
                now, keys, kept, copies, ends = block[a], [], None, set(), {}
            part = b.slice(a, z - a)
            x = part.column("x").to_pylist()
            if kinds[a] == "keep":
                keys += [np.frombuffer(low, np.uint32).astype(np.uint64) | np.uint64(s) << np.uint64(32) for s, low in zip(part.column("slice").to_pylist(), x)]
            elif kinds[a] == "copy":
                copies.update(x)
            elif kinds[a] == "ends":
                ends.update(zip(x, zip(part.column("lo").to_pylist(), part.column("hi").to_pylist())))
            elif keys:
                kept = np.sort(np.concatenate(keys)) if kept is None else kept
                rows = [(text, *ends.get(d, own)) for text, d, *own in zip(*(part.column(c).to_pylist() for c in ("text", "x", "lo", "hi"))) if d not in copies]
                yield kept, pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))], names=["text", "lo", "hi"])


_WINDOW = ["h1", "h2", "lo", "hi", "a", "z"]


def _candidates(batches: Iterator[pa.RecordBatch], plan: _Plan) -> Iterator[pa.RecordBatch]:
    """Windows under surviving anchors: the text's id and place. a null: only a hash, with its least and greatest id; z not null: a run known to be shared, to z."""
    length = plan.length
    held: list[tuple[np.ndarray, ...]] = []
    n = 0
    for kept, texts in _with_kept(batches):
        for points, place, no, lo, hi in _stretches(iter([texts]), length):
            if len(points) < length:
                continue
            hashes, anchor, inside = _anchored(points, no, length, plan.gram)
            if not len(inside):
                continue
            a = anchor[inside]
            head = np.append(True, a[1:] != a[:-1])
            key = plan.keys(a[head])
            hit = kept[np.minimum(np.searchsorted(kept, key), len(kept) - 1)] == key
            inside = inside[hit[np.cumsum(head) - 1]]
            if not len(inside):
                continue
            h1 = hashes.at(inside, length).view(np.int64)
            h2 = (_Hashes(points, _BASE2, _SALT2).at(inside, length) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            held.append((h1, h2, lo[inside], hi[inside], place[inside]))
            n += len(h1)
            if n >= _GROUP_AT_ONCE:
                yield from _settled(held, length)
                held, n = [], 0
    if n:
        yield from _settled(held, length)


def _settled(held: list[tuple[np.ndarray, ...]], length: int) -> Iterator[pa.RecordBatch]:
    """The windows grouped within the task: what is shared already goes as runs, with one row of its hash."""
    h1, h2, lo, hi, at = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((h2, h1))
    s1, s2 = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])
    start = np.flatnonzero(new)
    least, most = np.minimum.reduceat(lo[order], start), np.maximum.reduceat(hi[order], start)
    known = least != most
    group = np.cumsum(new) - 1
    shared = np.zeros(len(order), bool)
    shared[order] = known[group]
    k = int(known.sum())
    if k:
        none = pa.nulls(k, pa.int32())
        yield _windows(s1[start][known], s2[start][known], least[known], most[known], none, none)
        # runs of neighbouring windows; rows of one text come in order of place
        d, p = lo[shared], at[shared]
        by = np.lexsort((p, d))
        d, p = d[by], p[by]
        edge = np.ones(len(d), bool)
        edge[1:] = (d[1:] != d[:-1]) | (p[1:] > p[:-1] + length)
        first = np.flatnonzero(edge)
        last = np.append(first[1:], len(d)) - 1
        spread = _mix(d[first].astype(np.uint64) * np.uint64(3) + p[first].astype(np.uint64)).view(np.int64)
        yield _windows(spread, np.zeros(len(first), np.int32), d[first], pa.nulls(len(first), pa.int64()), p[first], p[last] + length)
    rest = ~shared
    n = int(rest.sum())
    yield _windows(h1[rest], h2[rest], lo[rest], pa.nulls(n, pa.int64()), at[rest], pa.nulls(n, pa.int32()))


def _windows(*cols) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x.astype(t.to_pandas_dtype())) for x, t in zip(cols, kinds)], names=_WINDOW)
