import random

from minespark.llm import pack as pack_module
from minespark.llm import tokenizer
from minespark.llm.pack import BestFit, pack, token_counts
from minespark.runtime import small


def test_best_fit_takes_the_tightest_bin_and_closes_the_fullest():
    b = BestFit(10, 2)
    assert [b.put(x) for x in (6, 7, 3)] == [0, 1, 1]  # bin 1 is full and closes
    assert b.put(4) == 0  # exactly
    assert [b.put(x) for x in (5, 6)] == [2, 3]
    assert b.put(8) == 4  # no room: bin 3, the fullest, closes
    assert b.left() == [(4, 2), (2, 5)]


def check(rows, sizes, capacity):
    by_bin, by_item = {}, {}
    for r in rows:
        by_bin[r.container_id] = by_bin.get(r.container_id, 0) + r.n_tokens
        by_item.setdefault(r.item, []).append((r.piece_no, r.piece_start, r.n_tokens))
    assert max(by_bin.values()) <= capacity
    assert set(by_item) == {i for i, s in sizes.items() if s}
    for i, pieces in by_item.items():
        pieces.sort()
        assert [p[0] for p in pieces] == list(range(len(pieces)))
        assert [p[1] for p in pieces] == [capacity * k for k in range(len(pieces))]
        assert sum(p[2] for p in pieces) == sizes[i]
        assert len(pieces) == -(-sizes[i] // capacity)
    return len(by_bin)


def test_all_items_are_packed_tightly(spark):
    rnd = random.Random(1)
    sizes = {i: rnd.choice([0, 1, rnd.randrange(1, 300), rnd.randrange(1, 2500), 2048]) for i in range(2000)}
    df = spark.createDataFrame([(i, s, "x", 1) for i, s in sizes.items()], "item long, size long, kind string, bin int").repartition(5)
    bins = check(pack(df, item_id="item", size="size", capacity=2048, open_bins=16).collect(), sizes, 2048)
    assert bins <= 1.03 * sum(sizes.values()) / 2048 + 1


def test_one_size_and_odd_rows(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (None, 5), (2, None), (3, 0), (4, -2)], "item long, size long")
    rows = pack(df, item_id="item", size="size", capacity=10).collect()
    assert sorted((r.item or 0, r.n_tokens) for r in rows) == [(0, 5), (1, 5), (1, 5)]
    assert len({r.container_id for r in rows}) == 2
    assert pack(df.limit(0), item_id="item", size="size", capacity=10).collect() == []


def test_many_tasks_look_up_their_open_bins_only(spark, monkeypatch):
    """200 tasks, more open bins than may be broadcast: the items of closed bins take no part in any join."""
    monkeypatch.setattr(pack_module, "small", lambda df: small(df, 50))
    monkeypatch.setattr(pack_module, "ONE_TASK", 100)
    rnd = random.Random(2)
    sizes = {i: rnd.randrange(1, 400) for i in range(20_000)}
    df = spark.createDataFrame(list(sizes.items()), "item long, size long").repartition(200)
    out = pack(df, item_id="item", size="size", capacity=1000, open_bins=4)
    assert check(out.collect(), sizes, 1000) <= 1.1 * sum(sizes.values()) / 1000
    joined, whole = out._jdf.queryExecution().optimizedPlan().toString().split("Union")[-1].split("Filter", 1), out.count()
    assert "Join" in joined[1] and whole == len(sizes)
    first = out._jdf.queryExecution().optimizedPlan().children().apply(0).toString()
    assert "Join" not in first and "(kind#" in first


def test_a_long_text_is_counted_as_it_is_encoded(spark):
    text = "hello world " * 40 + "z" * 300
    df = spark.createDataFrame([(1, text), (1, text), (2, "a b")], "d long, text string")
    got = sorted((r.doc_id, r["size"]) for r in token_counts(df, doc_id="d", text="text", long_text=100, unit=30).collect())
    n = len(tokenizer.load().encode(text))
    assert got == [(1, n), (1, n), (2, 2)]


def test_counts(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "d long, text string")
    assert sorted((r.doc_id, r["size"]) for r in token_counts(df, doc_id="d", text="text").collect()) == [(1, 2), (2, 0), (3, 0)]
