import random
import re
from collections import Counter
from decimal import Decimal

from minespark.operators.profile_sorted import ColumnRule, ks_distances, profile, value_distances

S = "ld long, s string, t string, x decimal(20,4), y int, c int, d string, n long"
RULES = [ColumnRule("s", pattern="^[a-c]$"), ColumnRule("t", coded=True), ColumnRule("x", number=True), ColumnRule("y", number=True)]


def data(seed, n):
    rnd = random.Random(seed)
    maybe = lambda x: None if rnd.random() < 0.15 else x
    load = lambda: 7 if rnd.random() < 0.5 else rnd.choice([1, 2, 3, None])
    out = [(load(), maybe(rnd.choice(["a", "b", " a", "", "长" * 50])), maybe(rnd.choice("pq")), maybe(Decimal(rnd.randrange(-300, 300)) / 100), maybe(rnd.randrange(-2, 3)), 0, "", 1) for _ in range(n)]
    return out + out[: n // 5] + [(9, None, None, None, None, 0, "", 1)]


def test_statistics(spark):
    rows = data(1, 600)
    got = {(r.load, r.c): r for r in profile(spark.createDataFrame(rows, S), RULES, "ld").stats.collect()}
    loads = {r[0] for r in rows} - {None}
    assert set(got) == {(ld, c) for ld in loads for c in range(4)}
    for (ld, c), r in got.items():
        col = [x[1 + c] for x in rows if x[0] == ld]
        v = sorted(x for x in col if x is not None)
        assert (r.n_rows, r.n_null, r.n_distinct) == (len(col), len(col) - len(v), len(set(v)))
        assert r.n_bad == (sum(not re.search("^[a-c]$", x) for x in v) if c == 0 else 0)
        if c >= 2:
            q = v[-(-3 * len(v) // 4) - 1] if v else None
            assert (r.n_zero, r.n_neg, r.lo, r.hi, r.q) == (sum(x == 0 for x in v), sum(x < 0 for x in v), v[0] if v else None, v[-1] if v else None, q)
        else:
            assert r.n_zero is r.lo is r.q is None


def test_distances(spark):
    rows = data(2, 500)
    p = profile(spark.createDataFrame(rows, S), RULES, "ld")
    pairs = spark.createDataFrame([(2, 1), (3, 2), (7, 3), (9, 7)], "load long, earlier long")
    values = lambda ld, c: [x[1 + c] for x in rows if x[0] == ld and x[1 + c] is not None]
    ks = {(r.load, r.c): r.ks for r in ks_distances(p, pairs).collect()}
    assert set(ks) == {(ld, c) for ld in (2, 3, 7) for c in (2, 3)}
    for (ld, c), got in ks.items():
        a, b = values(ld, c), values({2: 1, 3: 2, 7: 3}[ld], c)
        want = max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in a + b)
        assert abs(got - want) < 1e-12
    tv = {r.load: r.distance for r in value_distances(p, pairs).collect()}
    for ld, got in tv.items():
        a, b = (Counter(values(x, 1)) for x in (ld, {2: 1, 3: 2, 7: 3}[ld]))
        assert abs(got - sum(abs(a[v] / a.total() - b[v] / b.total()) for v in "pq") / 2) < 1e-12
    assert set(tv) == {2, 3, 7}


def test_small_batches_and_empty(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        test_statistics(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert profile(spark.createDataFrame([], S), RULES, "ld").stats.collect() == []
    assert profile(spark.createDataFrame(data(1, 9), S), [], "ld").stats.collect() == []
    assert profile(spark.createDataFrame([(None, "a", None, None, None, 0, "", 1)], S), RULES, "ld").stats.collect() == []


def _sorted_as(keys):
    """Whether (key, rest) never falls; null before any rest."""
    order = [(int(k), v is not None, v or b"") for k, v in keys]
    return order == sorted(order) and len(set(order)) == len(order)


def test_sort_keys_order_and_tell_the_values():
    import numpy as np
    import pyarrow as pa

    from minespark.operators import profile_sorted as P

    rnd = random.Random(3)
    numbers = sorted({Decimal(rnd.randrange(-(10**9), 10**9)) / 10000 for _ in range(300)} | {Decimal(x) for x in ("0", "12345678901234567890.1234", "922337203685477.5808", "-0.0001", "-99999999999999999999")})
    texts = sorted({"".join(rnd.choice("ab中é Z\x7f😀\0") for _ in range(rnd.randrange(12))) for _ in range(300)} | {"", "abcdefg", "abcdefgh", "a\0"}, key=str.encode)
    doubles = sorted({rnd.gauss(0, 10.0 ** rnd.randrange(-300, 300)) for _ in range(200)} | {0.0, 0.1, -0.1, 0.5, 5e-324, float("inf"), float("-inf")})
    whole = sorted({rnd.randrange(-(2**63), 2**63) for _ in range(50)} | {0, 1, -1, 2**55 - 2, 2**55 - 1, -(2**55) + 2, -(2**55) + 1, 2**63 - 1, -(2**63)})
    last = 0
    for i, (v, column) in enumerate([
        (pa.array([None, *numbers], pa.decimal128(24, 4)), P._Column(True, 4, False, None)),
        (pa.array(["x", None, *texts]).slice(1), P._Column(False, 0, False, None)),
        (pa.array([None, *P._ordered_bits(np.array([*doubles, float("nan")]))], pa.int64()), P._Column(True, None, False, None)),
        (pa.array([None, *whole], pa.int64()), P._Column(True, 0, False, None)),
    ]):
        k, rest = P._key(i + 100, v, column)
        assert _sorted_as(zip(k, rest.to_pylist())) and k[0] > last
        last = k[-1]
        if not column.number:
            assert P._texts(k, rest).to_pylist() == [None, *texts]
        else:
            back = [P._number(int(a), b, column) for a, b in zip(k[1:], rest.to_pylist()[1:])]
            assert back == [None, *numbers][1:] if i == 0 else back == whole if i == 3 else back[:-1] == doubles and back[-1] != back[-1]
        bounds = [(int(k[j]), rest[j].as_py()) for j in sorted(rnd.sample(range(len(k)), 20))]
        assert P._range_of(k, rest, bounds).tolist() == [sum((b, x is not None, x or b"") <= (int(a), v is not None, v or b"") for b, x in bounds) for a, v in zip(k, rest.to_pylist())]
        assert len(P._key(0, v.slice(0, 0), column)[0]) == 0


def test_numbers_count_at_their_own_scale(spark):
    """A fifth decimal, doubles that differ in the last bit, and a million different numbers."""
    rows = [(1, Decimal("0.12345"), 0.1 + 0.2, 2**62 + i % 2, "1.5") for i in range(4)] + [(1, Decimal("0.12346"), 0.3, -(2**62), "-2"), (1, None, -0.0, 0, None), (1, None, float("nan"), 0, None)]
    df = spark.createDataFrame(rows, "ld long, a decimal(10,5), b double, c long, d string")
    got = {r.c: r for r in profile(df, [ColumnRule(x, number=True) for x in "abcd"], "ld").stats.collect()}
    assert [got[i].n_distinct for i in range(4)] == [2, 4, 4, 2]
    assert (got[1].n_zero, got[1].n_neg, got[1].lo, got[1].q) == (1, 0, 0.0, 0.1 + 0.2) and got[1].hi != got[1].hi
    assert (got[2].lo, got[2].hi, got[2].n_neg, got[3].lo, got[3].q) == (-(2.0**62), 2.0**62, 1, -2.0, 1.5)
    exact = profile(df, [ColumnRule("a", number=True)], "ld").stats.first()
    assert (exact.lo, exact.hi, exact.q) == (Decimal("0.12345"), Decimal("0.12346"), Decimal("0.12345"))
    many = spark.range(1_000_000).selectExpr("1L as ld", "(id * 7919 % 1000000) / 8 as x")
    one = profile(many, [ColumnRule("x", number=True)], "ld").stats.first()
    assert (one.n_rows, one.n_distinct, one.lo, one.hi, one.q) == (1_000_000, 1_000_000, 0.0, 999_999 / 8, 749_999 / 8)


def test_more_columns_than_a_sort_takes(spark):
    df = spark.range(5).selectExpr("1L as ld", *(f"id + {i} as c{i}" for i in range(130)), "cast(id as string) as t")
    got = {r.c: r for r in profile(df, [*(ColumnRule(f"c{i}", number=True) for i in range(130)), ColumnRule("t")], "ld").stats.collect()}
    assert set(got) == set(range(131)) and all((got[i].lo, got[i].hi, got[i].n_distinct) == (i, i + 4, 5) for i in range(130)) and got[130].n_distinct == 5
