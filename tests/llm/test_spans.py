import math
import random

import pytest

from minespark.llm import spans
from minespark.llm.spans import shared_spans


def brute(rows, length):
    where = {}
    for i, t in rows:
        for a in range(len(t or "") - length + 1) if i is not None else ():
            where.setdefault(t[a : a + length], set()).add(i)
    out = {}
    for i, t in rows:
        covered = set()
        for a in range(len(t or "") - length + 1) if i is not None else ():
            if len(where[t[a : a + length]]) > 1:
                covered |= set(range(a, a + length))
        if covered:
            out[i] = len(covered)
    return sorted(out.items())


def found(spark, rows, length, **how):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, h1 string, lo int")
    return sorted(tuple(r) for r in shared_spans(df, doc_id="doc_id", text="text", min_length=length, **how).collect())


def corpus(seed, n):
    rnd = random.Random(seed)
    word = lambda k: "".join(rnd.choice("abcdé中😀 ") for _ in range(k))
    passages = [word(rnd.randrange(15, 60)) for _ in range(8)]
    rows = [(i, "".join(rnd.choice([word(rnd.randrange(30)), rnd.choice(passages), "ab" * rnd.randrange(12)]) for _ in range(rnd.randrange(6)))) for i in range(n)]
    hot = word(80)
    rows += [(1000 + i, hot) for i in range(n // 2)] + [(2000 + i, hot[5:60] + word(9)) for i in range(10)]
    return [*rows, rows[0], (3000, None), (3001, ""), (3002, "short"), (None, hot), (3003, "aaaa" * 40), (3004, "b" + "a" * 30), (3005, "z" * 50)]


@pytest.mark.parametrize(("seed", "length"), [(1, 20), (2, 33)])
def test_against_brute_force(spark, seed, length):
    rows = corpus(seed, 80)
    assert found(spark, rows, length) == brute(rows, length)


def test_saturated_sketch_changes_nothing(spark):
    rows = corpus(3, 60)
    assert found(spark, rows, 20, cells_per_anchor=0.001) == brute(rows, 20)


@pytest.mark.parametrize("block", [1, 150])
def test_blocks_change_nothing(spark, block):
    """Copies in one block and in several, anchors counted by several tasks."""
    rows = corpus(5, 60)
    assert found(spark, rows, 20, block=block) == brute(rows, 20)


@pytest.mark.parametrize("block", [1, 40, 10_000])
def test_ids_with_several_texts(spark, block):
    """A text of id 1 shares a stretch with another text that ids 1 and 9 have in different blocks; without 9 it would be repetition inside a record."""
    rnd = random.Random(7)
    common = "".join(rnd.choice("abcdef") for _ in range(30))
    t, u = "x" * 3 + common + "yy", "z" * 50 + common[:25]  # u's stretch lies behind t's end
    for few, n in (([(1, t), (1, u), (9, t)], 60), ([(9, t), (1, u), (1, t)], 60), ([(1, t), (1, u)], None)):
        assert dict(found(spark, few, 20, block=block)).get(1) == n
    rows = [(1, "x" * 3 + common + "yy"), (1, "zz" + common[:25]), (9, "x" * 3 + common + "yy"), (2, "w" + common[3:24]), (3, "only here " * 4), (3, "there " + "only here " * 3), (4, "here"), (4, "no")]
    rows += [(rnd.randrange(5, 12), "".join(rnd.choice([common[5:28], "qrst" * 6, word])) + str(i % 3)) for i, word in enumerate("".join(rnd.choice("ghij") for _ in range(24)) for _ in range(30))]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        where, covered = {}, {}
        for i, t in rows:
            for a in range(len(t) - 19):
                where.setdefault(t[a : a + 20], set()).add(i)
        # texts of an id are laid over each other
        for i, t in rows:
            for a in range(len(t) - 19):
                if len(where[t[a : a + 20]]) > 1:
                    covered.setdefault(i, set()).update(range(a, a + 20))
        assert found(spark, rows, 20, block=block) == sorted((i, len(c)) for i, c in covered.items())


def test_few_single_windows_pass(monkeypatch):
    """The share of anchors of one text that the merged sketch counts twice, over slices, blocks and tasks; none of two texts is lost."""
    import numpy as np
    import pyarrow as pa

    rnd = random.Random(6)
    own = ["".join(rnd.choice("abcdefgh ") for _ in range(3000)) for _ in range(40)]
    common = "".join(rnd.choice("xyz") for _ in range(120))
    texts = [t + common * (i % 10 == 0) for i, t in enumerate(own)]
    total = sum(map(len, texts))
    plan = spans._Plan(100, 62, 7, math.ceil(spans.CELLS_PER_ANCHOR * 2 * total / 40 / 7), 20_000)
    monkeypatch.setattr(spans, "TaskContext", Tasks)
    rows = []
    for task in range(4):
        Tasks.now = task
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(10)), "text": texts[task * 10 : task * 10 + 10]})
        rows += [r for b in spans._first(iter([batch]), plan) for r in b.to_pylist()]
    by_slice = sorted((r for r in rows if r["kind"] in ("look", "sketch")), key=lambda r: (r["slice"], -ord(r["kind"][0])))
    table = pa.Table.from_pylist(by_slice, pa.schema([("kind", pa.string()), ("block", pa.int64()), ("slice", pa.int32()), ("x", pa.binary())]))
    kept = {(s, int(x)) for b in spans._estimate(iter(table.to_batches(max_chunksize=3)), plan) for s, blob in zip(b.column("slice").to_pylist(), b.column("x").to_pylist()) for x in np.frombuffer(blob, np.uint32)}
    seen = [(r["slice"], int(x)) for r in by_slice if r["kind"] == "look" for x in np.frombuffer(r["x"], np.uint32)]
    twice = {k for k in seen if seen.count(k) > 1}
    assert twice and twice <= kept
    assert len(kept - twice) < 0.05 * len(set(seen) - twice)


class Tasks:
    now = 0

    @staticmethod
    def get():
        return Tasks

    @staticmethod
    def partitionId():
        return Tasks.now


def test_empty(spark):
    assert found(spark, [], 20) == found(spark, [(1, None), (2, "x")], 20) == []


def test_long_texts_are_hashed_in_parts(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(spans, "_HASH_AT_ONCE", 50)
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abc") for _ in range(n)) for n in (300, 20, 61, 5, 149, 150)]
    batch = pa.RecordBatch.from_pydict({"lo": list(range(6)), "hi": list(range(6)), "text": texts})
    seen = {}
    for points, place, no, lo, _ in spans._stretches(iter([batch]), 20):
        if len(points) < 20:
            continue
        for i in np.flatnonzero(no[: len(points) - 19] == no[19:]):
            key = (int(lo[i]), int(place[i]))
            assert key not in seen
            seen[key] = "".join(map(chr, points[i : i + 20]))
    assert seen == {(k, a): t[a : a + 20] for k, t in enumerate(texts) for a in range(len(t) - 19)}


def test_hashes_depend_on_content_only():
    import numpy as np

    t = np.frombuffer("xxhello worldyyyhello worldz".encode("utf-32-le"), np.uint32)
    h = spans._Hashes(t, spans._BASE1, spans._SALT1)
    assert h.all(11)[2] == h.all(11)[16] and len(np.unique(h.all(11))) == len(t) - 10 - 1
    assert (h.at(np.arange(5), 11) == h.all(11)[:5]).all()
