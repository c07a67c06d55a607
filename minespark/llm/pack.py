"""Filling fixed-capacity containers: bounded-space best-fit with a bitset of free space."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minespark.llm import tokenizer
from minespark.llm.encode import LONG_TEXT, UNIT, _rows, long_ids
from minespark.runtime import small, written

#: Bins that a task keeps open at once.
OPEN_BINS = 128
#: Open bins left by all tasks up to which one task consolidates them; more are first consolidated in groups.
ONE_TASK = 100_000


class BestFit:
    """Online best-fit over at most `most` open bins of one capacity.

    The open bins are stacked by their free space; bit f of `bits` is set while a bin with free space f is open, so
    the tightest fit of a size is the lowest set bit from it on. If none fits and `most` bins are
    open, the fullest closes. A bin without free space closes at once. `closed` gets the bins that close; who reads it empties it.
    """

    def __init__(self, capacity: int, most: int, first: int = 0, step: int = 1):
        self.capacity, self.most = capacity, most
        self.bits, self.open = 0, 0
        self.closed: list[int] = []
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.next, self.step = first, step

    def put(self, size: int) -> int:
        """The bin that takes an item of 0 < size <= capacity."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            one = self._pop(free)
        else:
            if self.open >= self.most:
                self.closed.append(self._pop((self.bits & -self.bits).bit_length() - 1))
            free, one = self.capacity, self.next
            self.next += self.step
        left = free - size
        if left:
            self.by_free[left].append(one)
            self.bits |= 1 << left
            self.open += 1
        else:
            self.closed.append(one)
        return one

    def _pop(self, free: int) -> int:
        stack = self.by_free[free]
        one = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return one

    def left(self) -> list[tuple[int, int]]:
        """(bin, free space) of the bins still open."""
        return [(one, free) for free, stack in enumerate(self.by_free) for one in stack]


_ITEMS = "kind string, pid int, bin long, doc_id {key}, piece_no int, piece_start long, n_tokens int"


def token_counts(df: DataFrame, *, doc_id: str, text: str, name: str = "byte_bpe_50k", folder: str = tokenizer.FOLDER, long_text: int = LONG_TEXT, unit: int = UNIT) -> DataFrame:
    """(doc_id, size): tokens of each row's text, 0 for null and empty ones. Long texts are cut and spread as encode_corpus does."""
    rows, is_long, key = _rows(df, doc_id, text, long_text)
    short = rows.where(~is_long).mapInArrow(lambda it: _count(it, name, folder), f"doc_id {key}, size long")
    return short.unionByName(long_ids(rows.where(is_long), name, folder, unit).select("doc_id", F.size("ids").cast("long").alias("size")))


def _count(batches: Iterator[pa.RecordBatch], name: str, folder: str) -> Iterator[pa.RecordBatch]:
    bpe = tokenizer.load(name, folder)
    for b in batches:
        sizes = pa.array([len(bpe.encode(t)) if t else 0 for t in b.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), sizes], names=["doc_id", "size"])


def pack(items: DataFrame, *, item_id: str, size: str, capacity: int, open_bins: int = OPEN_BINS) -> DataFrame:
    """(container_id, item_id, piece_no, piece_start, n_tokens): every item in a container, whole unless it exceeds the capacity.

    A larger item is split into pieces of the capacity and a rest (piece_no from 0, piece_start its first unit); the pieces of one
    item may lie in different containers. Items with a null, zero or negative size are left out; repeated items and
    null ids are packed each by itself. Other columns are not read. An empty table gives no rows.

    How: each task packs its items as they come, by best-fit over `open_bins` open bins (BestFit), without a
    shuffle. Items of a bin that closes have their container at once. What a task leaves open, at most `open_bins` bins, is packed again as items with those of
    the other tasks, so no more than `open_bins` containers stay open in the end; only the items of these bins are looked up. Bins that
    the second packing puts together share the container id of the first of them.
    """
    rows = items.select(F.col(item_id).alias("doc_id"), F.col(size).cast("long").alias("size")).where("size > 0")
    schema = _ITEMS.format(key=dict(rows.dtypes)["doc_id"])
    placed = written(rows.mapInArrow(lambda it: _place(it, capacity, open_bins), schema), "pack")
    rest = placed.where("kind = 'open'").select("pid", "bin", F.col("n_tokens").alias("fill"))
    moved = _consolidated(rest, capacity, open_bins)
    own = (F.shiftleft(F.col("pid").cast("long"), 40) + F.col("bin")).alias("container")
    item = [F.col("doc_id").alias(item_id), "piece_no", "piece_start", "n_tokens"]
    final = placed.where("kind = 'item'").select(own.alias("container_id"), *item)
    moving = placed.where("kind = 'moving'").join(small(moved), ["pid", "bin"])
    return final.unionByName(moving.select(F.col("container").alias("container_id"), *item))


def _place(batches: Iterator[pa.RecordBatch], capacity: int, open_bins: int) -> Iterator[pa.RecordBatch]:
    """item: an item of a closed bin; moving: an item of a bin left open; open: such a bin, with its fill."""
    pid = TaskContext.get().partitionId()
    bins = BestFit(capacity, open_bins)
    inside: dict[int, list[tuple]] = {}  # of each open bin its items
    key = None
    for b in batches:
        key = b.schema.field("doc_id").type
        out: list[tuple] = []
        for one, size in zip(b.column("doc_id").to_pylist(), b.column("size").to_pylist()):
            for k, at in enumerate(range(0, size, capacity)):
                part = min(capacity, size - at)
                bin_no = bins.put(part)
                inside.setdefault(bin_no, []).append((bin_no, one, k, at, part))
                for c in bins.closed:
                    out += inside.pop(c)
                bins.closed.clear()
        if out:
            yield _batch("item", pid, key, out)
    if inside:
        yield _batch("moving", pid, key, [x for items in inside.values() for x in items])
        yield _batch("open", pid, key, [(one, None, 0, 0, capacity - free) for one, free in bins.left()])


def _batch(kind: str, pid: int, key: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (bin, id, piece, start, tokens)."""
    k = len(rows)
    kinds = (pa.int64(), key, pa.int32(), pa.int64(), pa.int32())
    cols = [pa.array([kind] * k), pa.array([pid] * k, pa.int32()), *(pa.array(x, t) for x, t in zip(zip(*rows), kinds))]
    return pa.RecordBatch.from_arrays(cols, names=["kind", "pid", "bin", "doc_id", "piece_no", "piece_start", "n_tokens"])


def _consolidated(rest: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """(pid, bin, container) of the open bins: at most tasks x open_bins rows, packed by groups of ONE_TASK, largest first."""
    groups = max(1, -(-rest.count() // ONE_TASK))
    schema = "pid int, bin long, container long"
    spread = rest.repartition(groups, "pid") if groups > 1 else rest.coalesce(1)
    return written(spread.sortWithinPartitions(F.desc("fill"), "pid", "bin").mapInArrow(lambda it: _merge(it, capacity, open_bins), schema), "pack-open")


def _merge(batches: Iterator[pa.RecordBatch], capacity: int, open_bins: int) -> Iterator[pa.RecordBatch]:
    bins = BestFit(capacity, open_bins)
    ids: dict[int, int] = {}
    for b in batches:
        own = [(p << 40) + n for p, n in zip(b.column("pid").to_pylist(), b.column("bin").to_pylist())]
        to = [ids.setdefault(bins.put(f), o) for f, o in zip(b.column("fill").to_pylist(), own)]
        yield pa.RecordBatch.from_arrays([b.column("pid"), b.column("bin"), pa.array(to, pa.int64())], names=["pid", "bin", "container"])
