"""Fitted preparation steps: what they learn is a small table of columns or values, what they do is a projection."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minespark.operators.ranking import quantiles
from minespark.operators.stats import crosstab, drop_correlated, information_values, melt, woe_iv
from minespark.runtime import small, written

#: Values up to which a column is looked up in the plan; a column of more is joined to its broadcast table (of at most `limit` rows, see the fits).
IN_PLAN = 100
#: Names of merged values (fixed values).
RARE, LOW_IV = "其他_countlow", "其他_ivlow"


@dataclass(frozen=True)
class Fitted:
    """A fitted step: dropped columns and per column a JSON-able rule; `kind` says how apply() uses it."""

    kind: str
    dropped: tuple[str, ...] = ()
    rules: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)

    @staticmethod
    def from_json(text: str) -> Fitted:
        d = json.loads(text)
        return Fitted(d["kind"], tuple(d["dropped"]), d["rules"])

    def apply(self, df: DataFrame) -> DataFrame:
        """The step on other rows: a projection, without a shuffle. Columns it was not fitted on stay as they are."""
        out = df.drop(*self.dropped)
        rules = {c: r for c, r in self.rules.items() if c in out.columns}
        if self.kind in ("woe", "ordinal"):
            many = [c for c, r in rules.items() if len(_table(self.kind, r)) > IN_PLAN]
            known = {c: (_merged(c, rules[c]) if self.kind == "ordinal" else F.col(f"`{c}`"), _table(self.kind, rules[c])) for c in many}
            out, found = looked_up(out, known)
            out = out.withColumns({c: F.coalesce(f, F.lit(0.0 if self.kind == "woe" else -1)).cast("double" if self.kind == "woe" else "int") for c, f in found.items()}).drop(*(f"_w_{i}" for i in range(len(many))))
            rules = {c: r for c, r in rules.items() if c not in many}
        new = {}
        for c, rule in rules.items():
            new |= _APPLY[self.kind](c, rule)
        out = out.withColumns(new)
        return out.drop(*self.rules) if self.kind == "onehot" else out


def _table(kind: str, rule: Mapping) -> dict[str, float]:
    """What a WOE or ordinal rule makes of each value."""
    return rule["woe"] if kind == "woe" else {v: i for i, v in enumerate(rule["values"])}


def looked_up(df: DataFrame, known: Mapping[str, tuple[Column, Mapping[str, float]]]) -> tuple[DataFrame, dict[str, Column]]:
    """(df with helper columns _w_0, _w_1, ..., the number that each column's value has by its table, null without one); null is looked up as "".

    One broadcast hash join for each column, of a table that the caller has bounded.
    """
    spark, found = df.sparkSession, {}
    for i, (c, (value, table)) in enumerate(known.items()):
        side = spark.createDataFrame([(v, float(w)) for v, w in table.items()], f"_k_{i} string, _w_{i} double")
        df = df.join(F.broadcast(side), F.coalesce(value.cast("string"), F.lit("")) == F.col(f"_k_{i}"), "left").drop(f"_k_{i}")
        found[c] = F.col(f"_w_{i}")
    return df, found


def apply_all(steps: Sequence[Fitted], df: DataFrame) -> DataFrame:
    for s in steps:
        df = s.apply(df)
    return df


def find_step(steps: Sequence[Fitted], kind: str, place: int = 0) -> Fitted | None:
    """The first step of a kind, or the one at a place among them (-1: the last); None without one."""
    found = [s for s in steps if s.kind == kind]
    return found[place] if -len(found) <= place < len(found) else None


def needed_columns(steps: Sequence[Fitted], columns: Sequence[str]) -> list[str]:
    """Inputs that no step drops."""
    gone = {c for s in steps for c in s.dropped}
    return [c for c in columns if c not in gone]


def with_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with the columns it lacks as null text."""
    return df.withColumns({c: F.lit(None).cast("string") for c in columns if c not in df.columns})


def _lookup(c: str, mapping: Mapping[str, object], otherwise: Column, kind: str) -> Column:
    if not mapping:
        return otherwise
    table = F.create_map(*(x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))))
    return F.coalesce(F.try_element_at(table, F.coalesce(F.col(c).cast("string"), F.lit(""))), otherwise).cast(kind)


def _bins(c: str, edges: Sequence[float]) -> Column:
    """Right-closed bin number; values outside go to the end bins, null stays null."""
    x = F.col(c).cast("double")
    out = F.when(x <= edges[1] if len(edges) > 2 else F.lit(True), 0)
    for i in range(1, len(edges) - 2):
        out = out.when(x <= edges[i + 1], i)
    return F.when(x.isNull(), F.lit(None).cast("int")).otherwise(out.otherwise(max(0, len(edges) - 2)))


def _merged(c: str, rule: Mapping) -> Column:
    """The text of a one-hot or ordinal column, low values merged; a value that isn't known is an error if the rule says so."""
    x = F.col(c).cast("string")
    if "known" in rule:
        x = F.when(x.isNull() | x.isin(rule["known"]), x).otherwise(F.raise_error(F.concat(F.lit(f"{c}: unknown value "), x)))
    return F.when(x.isin(rule["merged"]), LOW_IV).otherwise(x) if rule.get("merged") else x


_APPLY = {
    "drop": lambda c, r: {},
    "merge": lambda c, r: {c: F.when(F.col(c).cast("string").isin(r["values"]), F.lit(r["to"])).otherwise(F.col(c).cast("string"))},
    "bins": lambda c, r: {c: _bins(c, [float(x) for x in r["edges"]])},
    "unseen": lambda c, r: {c: F.when(F.col(c).cast("string").isin(r["known"]), F.col(c).cast("string")).otherwise(F.lit(r["mode"]))},
    "impute": lambda c, r: {c: F.coalesce(F.col(c), F.lit(r["value"]))},
    "indicator": lambda c, r: {f"missing__{c}": F.col(c).isNull().cast("int")},
    "onehot": lambda c, r: {f"{c}~{v}": F.coalesce((_merged(c, r) == v).cast("int"), F.lit(0)) for v in r["values"]},
    "ordinal": lambda c, r: {c: (F.coalesce(F.array_position(F.array(*map(F.lit, r["values"])), _merged(c, r)).cast("int"), F.lit(0)) - 1)},
    "toint": lambda c, r: {c: F.col(c).try_cast("int")},
    "clamp": lambda c, r: {c: F.greatest(F.lit(r["lo"]), F.least(F.lit(r["hi"]), F.col(c).cast("double")))},
    "scale": lambda c, r: {c: (F.col(c).cast("double") - r["shift"]) / r["by"]},
    "woe": lambda c, r: {c: _lookup(c, r["woe"], F.lit(0.0), "double")},
}


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col, v, n) of all columns in one pass."""
    return melt(df, columns).groupBy("col", "v").agg(F.count(F.lit(1)).alias("n"))


def fit_prefilter(df: DataFrame, numbers: Sequence[str], categories: Sequence[str], *, freq_limit: float = 0.95, unique_limit: int = 5000, valuecount_limit: int = 50) -> list[Fitted]:
    """Drop columns whose top value's share reaches freq_limit (all null counts as 1) and categories with too many values; merge rare categories.

    A category is dropped if it has unique_limit values or more (0.99 x rows if that is less), or if all its values are
    rare (valuecount_limit rows or fewer).
    """
    counts = value_counts(df, [*numbers, *categories]).cache()
    full = F.col("v").isNotNull()
    stats = counts.groupBy("col").agg(F.sum("n").alias("rows"), F.max(F.when(full, F.col("n"))).alias("top"), F.count_if(full).alias("k"), F.max(F.when(full, F.col("n") > valuecount_limit)).alias("some")).collect()
    dropped, mixed = [], []
    for s in stats:
        limit = unique_limit if unique_limit <= s.rows else 0.99 * s.rows
        if s.top is None or s.top / s.rows >= freq_limit:
            dropped.append(s.col)
        elif s.col in categories and (s.k >= limit or not s.some):
            dropped.append(s.col)
        elif s.col in categories:
            mixed.append(s.col)
    rare = counts.where(F.col("col").isin(mixed) & full & (F.col("n") <= valuecount_limit)).groupBy("col").agg(F.sort_array(F.collect_list("v")).alias("v")).collect() if mixed else []  # fewer than unique_limit values each
    counts.unpersist()
    return [Fitted("drop", tuple(sorted(dropped))), Fitted("merge", (), {r.col: {"values": list(r.v), "to": RARE} for r in rare})]


def _split_accepted(total: np.ndarray, left: np.ndarray) -> bool:
    """Whether the information gain of a cut passes the minimum description length test; class counts of an interval and of its left part."""

    def entropy(c: np.ndarray) -> float:
        p = c[c > 0] / c.sum()
        return float(-(p * np.log(p)).sum())

    right = total - left
    n = total.sum()
    e, e1, e2 = entropy(total), entropy(left), entropy(right)
    k, k1, k2 = (int((x > 0).sum()) for x in (total, left, right))
    gain = e - left.sum() / n * e1 - right.sum() / n * e2
    return gain >= (math.log(n - 1) + math.log(3**k - 2) - (k * e - k1 * e1 - k2 * e2)) / n


def _cut_gini(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Gini impurities (times rows) after cuts with these class counts on both sides, to nine digits."""
    nl, nr = left.sum(1), right.sum(1)
    return np.round(nl - (left**2).sum(1) / np.maximum(nl, 1) + nr - (right**2).sum(1) / np.maximum(nr, 1), 9)


def _mdlp_cuts(values: np.ndarray, pos: np.ndarray, neg: np.ndarray, min_split: int = 30) -> list[tuple[int, float, int]]:
    """(depth, cut, rows at or below it) of all cuts of a histogram, see mdlp_edges."""
    counts = np.column_stack([pos, neg]).astype(float)
    rows = np.cumsum(counts.sum(1))
    cuts = []
    todo = [(0, 0, len(values))]
    while todo:
        depth, a, z = todo.pop()
        part = counts[a:z]
        total = part.sum(0)
        if z - a < 2 or total.sum() < min_split:
            continue
        left = np.cumsum(part, 0)[:-1]
        at = int(np.argmin(_cut_gini(left, total - left)))
        if _split_accepted(total, left[at]):
            cuts.append((depth, float((values[a + at] + values[a + at + 1]) / 2), int(rows[a + at])))
            todo += [(depth + 1, a, a + at + 1), (depth + 1, a + at + 1, z)]
    return cuts


def _first_cuts(cuts: Sequence[tuple[int, float, int]], bin_limit: int | None) -> list[tuple[float, int]]:
    """(cut, rows at or below it) by value; with bin_limit those found first, level by level from the left."""
    return sorted(c[1:] for c in sorted(cuts)[: max(1, bin_limit - 1) if bin_limit else None])


def mdlp_edges(values: np.ndarray, pos: np.ndarray, neg: np.ndarray, min_split: int = 30, bin_limit: int | None = None) -> list[float]:
    """Edges (-inf, ..., inf) of supervised bins of a histogram: sorted values with class counts.

    An interval is cut where the Gini impurity falls most (halfway between neighbouring values, the lowest on ties) if it
    has min_split rows and the information gain passes the minimum description length test: gain >=
    (ln(n-1) + ln(3^k - 2) - (k E - k1 E1 - k2 E2)) / n, entropies by natural logarithm, k the classes present.
    """
    return [-math.inf, *(c for c, _ in _first_cuts(_mdlp_cuts(values, pos, neg, min_split), bin_limit)), math.inf]


@dataclass(frozen=True)
class _Interval:
    """Values of a column that no cut has parted: those up to `hi` (all if None) and above the interval before; class counts and values below and inside."""

    depth: int
    hi: float | None
    below: tuple[int, int, int]
    inside: tuple[int, int, int]


def _cumulated(counts: DataFrame) -> DataFrame:
    """(col, x, p, n, nx, cp, cn, ck) of a table (col, x, p, n): the column's next value, and its class counts and values up to x.

    One range sort; each task's sums (a row per task and column) give the offsets of those after it.
    """
    t = written(counts.repartitionByRange("col", "x").sortWithinPartitions("col", "x").withColumn("pid", F.spark_partition_id()), "mdlp-sorted")
    parts = t.groupBy("col", "pid").agg(F.sum("p").alias("sp"), F.sum("n").alias("sn"), F.count(F.lit(1)).alias("sk"), F.min("x").alias("first"))
    w = Window.partitionBy("col").orderBy("pid")
    offset = parts.select("col", "pid", *((F.sum(f"s{c}").over(w) - F.col(f"s{c}")).alias(f"b{c}") for c in "pnk"), F.lead("first").over(w).alias("following"))
    run = Window.partitionBy("col", "pid").orderBy("x")
    upto = t.withColumns({"cp": F.sum("p").over(run), "cn": F.sum("n").over(run), "ck": F.row_number().over(run), "nx": F.lead("x").over(run)}).join(small(offset), ["col", "pid"])
    return written(upto.select("col", "x", "p", "n", F.coalesce("nx", "following").alias("nx"), *((F.col(f"c{c}") + F.col(f"b{c}")).alias(f"c{c}") for c in "pnk")), "mdlp-cumulated")


def _parted(values: DataFrame, totals: Mapping[str, tuple[int, int, int]], histogram: int, min_split: int) -> tuple[dict[str, list[tuple[int, float, int]]], dict[str, list[_Interval]]]:
    """(cuts, intervals) by column: all cuts of intervals with more than `histogram` values, and what they leave.

    Level by level, each task finds the best cut of every open interval among its rows of `values` (_cumulated), which hold
    their own prefix sums; the least of the tasks' (a row per interval) is the interval's.
    """
    cuts: dict[str, list[tuple[int, float, int]]] = {c: [] for c in totals}
    parts = {c: [_Interval(0, None, (0, 0, 0), t)] for c, t in totals.items()}
    todo = {(c, 0) for c, (p, n, _) in totals.items() if p + n >= min_split}
    while todo:
        ends = {c: np.array([i.hi for i in parts[c][:-1]], dtype=float) for c, _ in todo}
        below = {c: np.array([i.below[:2] for i in parts[c]], dtype=float) for c in ends}
        inside = {c: np.array([i.inside[:2] for i in parts[c]], dtype=float) for c in ends}
        is_open = {c: np.array([(c, k) in todo for k in range(len(parts[c]))]) for c in ends}

        def best(batches):
            for batch in batches:
                for c, p in batch.groupby("col"):
                    at = np.searchsorted(ends[c], p["x"].to_numpy(), side="left")
                    p, at = p[is_open[c][at]], at[is_open[c][at]]
                    left = p[["cp", "cn"]].to_numpy(dtype=float) - below[c][at]
                    right = inside[c][at] - left
                    p = p.assign(seg=at, g=_cut_gini(left, right))[right.sum(1) > 0]  # an interval's last value is no cut
                    yield p.sort_values(["seg", "g", "x"]).drop_duplicates("seg")[["col", "seg", "g", "x", "nx", "cp", "cn", "ck"]]

        found = values.where(F.col("col").isin(list(ends))).select("col", "x", "nx", "cp", "cn", "ck").mapInPandas(best, "col string, seg int, g double, x double, nx double, cp long, cn long, ck long")
        hits = {(r.col, r.seg): r.m for r in found.groupBy("col", "seg").agg(F.min(F.struct("g", "x", "nx", "cp", "cn", "ck")).alias("m")).collect()}  # a row per open interval
        todo = set()
        for c in ends:
            after: list[_Interval] = []
            for k, i in enumerate(parts[c]):
                m = hits.get((c, k))
                left = m and tuple(a - b for a, b in zip((m.cp, m.cn, m.ck), i.below))
                if not m or not _split_accepted(np.array(i.inside[:2], dtype=float), np.array(left[:2], dtype=float)):
                    after.append(i if not is_open[c][k] else _Interval(i.depth, i.hi, i.below, (*i.inside[:2], 0)))  # settled: no values left to look at
                    continue
                cuts[c].append((i.depth, (m.x + m.nx) / 2, m.cp + m.cn))
                for child in (_Interval(i.depth + 1, m.x, i.below, left), _Interval(i.depth + 1, i.hi, (m.cp, m.cn, m.ck), tuple(a - b for a, b in zip(i.inside, left)))):
                    if child.inside[2] > histogram and sum(child.inside[:2]) >= min_split:
                        todo.add((c, len(after)))
                    after.append(child)
            parts[c] = after
    return cuts, parts


def fit_mdlp(df: DataFrame, columns: Sequence[str], label: str, positive: str, negative: str, *, precision: int = 6, min_binsize: int = 30, bin_limit: int | None = None, drop_unsplit: bool = False, histogram: int = 1000) -> Fitted:
    """Supervised bins of number columns. Values are rounded to `precision`; bins under min_binsize rows lose their right edge.

    Class counts of all columns are aggregated at once, and every value is a possible cut. Intervals with more than `histogram`
    different values are cut by all tasks together (_parted), smaller ones in one task each; the edges don't depend on it.
    """
    min_split = 30
    rows = df.where(F.col(label).cast("string").isin(positive, negative))
    long = F.explode(F.array(*(F.struct(F.lit(c).alias("col"), F.round(F.col(c).cast("double"), precision).alias("x")) for c in columns)))
    y = F.col(label).cast("string")
    melted = rows.select(long.alias("_p"), y.alias("y")).select("_p.col", "_p.x", "y").where("x is not null and not isnan(x)")
    counts = written(melted.groupBy("col", "x").agg(F.count_if(F.col("y") == positive).alias("p"), F.count_if(F.col("y") == negative).alias("n")), "mdlp-values")
    totals = {r.col: (r.p, r.n, r.k) for r in counts.groupBy("col").agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()}
    wide = {c: t for c, t in totals.items() if t[2] > histogram}
    cuts, parts = _parted(_cumulated(counts.where(F.col("col").isin(list(wide)))), wide, histogram, min_split) if wide else ({}, {})
    cuts |= {c: [] for c in totals if c not in wide}
    parts |= {c: [_Interval(0, None, (0, 0, 0), t)] for c, t in totals.items() if c not in wide}
    ends = {c: np.array([i.hi for i in parts[c][:-1]], dtype=float) for c in parts}
    small_ones = {c: np.array([1 < i.inside[2] <= histogram and sum(i.inside[:2]) >= min_split for i in parts[c]]) for c in parts}

    def place(batches):
        """Rows of the intervals that one task is to cut, with the interval's number."""
        for batch in batches:
            for c, p in batch.groupby("col"):
                at = np.searchsorted(ends[c], p["x"].to_numpy(), side="left")
                yield p.assign(seg=at)[small_ones[c][at]]

    def fit(key: tuple, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("x")
        i = parts[key[0]][key[1]]
        own = _mdlp_cuts(p["x"].to_numpy(), p["p"].to_numpy(), p["n"].to_numpy(), min_split)
        return pd.DataFrame([(key[0], i.depth + d, e, i.below[0] + i.below[1] + n) for d, e, n in own], columns=["col", "depth", "cut", "upto"])

    placed = counts.mapInPandas(place, "col string, x double, p long, n long, seg int")
    for r in placed.groupBy("col", "seg").applyInPandas(fit, "col string, depth int, cut double, upto long").collect() if any(x.any() for x in small_ones.values()) else []:
        cuts[r.col].append((r.depth, r.cut, r.upto))
    found = {}
    for c, (p, n, _) in totals.items():
        own = _first_cuts(cuts[c], bin_limit)
        held = np.diff([0, *(u for _, u in own), p + n])
        found[c] = [-math.inf, *(e for (e, _), h in zip(own, held) if h >= min_binsize), math.inf]
    unsplit = [c for c in columns if len(found.get(c, [0, 0])) <= 2]
    return Fitted("bins", tuple(unsplit) if drop_unsplit else (), {c: {"edges": [repr(x) for x in e]} for c, e in found.items() if not (drop_unsplit and c in unsplit)})


def fit_unseen(df: DataFrame, columns: Sequence[str], limit: int = 5000) -> Fitted:
    """Values not seen in fitting, and nulls, become the most frequent value (the smallest on ties). Columns with more than `limit` values are an error."""
    counts = value_counts(df, columns).where("v is not null").cache()
    try:
        _few_values(counts, limit)
        known = counts.groupBy("col").agg(F.sort_array(F.collect_list("v")).alias("known"), F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias("mode")).collect()  # at most `limit` values each
    finally:
        counts.unpersist()
    return Fitted("unseen", (), {r.col: {"known": list(r.known), "mode": r.mode} for r in known})


def fit_impute(df: DataFrame, columns: Sequence[str], strategy: str, fill: object = None) -> Fitted:
    """mean, median, most_frequent (smallest on ties) or constant. A column without values is dropped, unless constant."""
    if strategy == "constant":
        return Fitted("impute", (), {c: {"value": fill} for c in columns})
    if strategy == "mean":
        row = df.agg(*(F.avg(c).alias(c) for c in columns)).first().asDict()
    elif strategy == "median":
        row = dict.fromkeys(columns) | {r.col: r.value for r in quantiles(df, columns, [0.5]).collect()}
    elif strategy == "most_frequent":
        first = value_counts(df, columns).where("v is not null").groupBy("col", "n").agg(F.min("v").alias("v"))
        row = dict.fromkeys(columns) | {r.col: r.v for r in first.groupBy("col").agg(F.max_by("v", "n").alias("v")).collect()}
    else:
        raise ValueError(f"no strategy {strategy}")
    return Fitted("impute", tuple(c for c in columns if row[c] is None), {c: {"value": v} for c, v in row.items() if v is not None})


def fit_toint(df: DataFrame, columns: Sequence[str]) -> Fitted:
    """Text columns all of whose values are whole numbers become integers; one pass over all columns."""
    whole = lambda c: F.bool_and(F.coalesce(F.col(c).cast("string").rlike("^-?[0-9]{1,9}$"), F.lit(True)))
    row = df.agg(*(whole(c).alias(c) for c in columns)).first().asDict() if columns else {}
    return Fitted("toint", (), {c: {} for c, ok in row.items() if ok})


def fit_indicator(columns: Sequence[str]) -> Fitted:
    return Fitted("indicator", (), {c: {} for c in columns})


def value_ivs(df: DataFrame, columns: Sequence[str], label: str, positive: str, negative: str) -> DataFrame:
    """(col, v, iv): the information value of each value's indicator, over all columns in one pass; null is no value."""
    c = crosstab(df, columns, label, positive, negative)
    total = c.groupBy("col").agg(F.sum("n_pos").alias("_p"), F.sum("n_neg").alias("_n"))
    pairs = c.join(total, "col").where("v is not null")
    both = F.explode(F.array(F.struct(F.lit("1").alias("s"), F.col("n_pos").alias("a"), F.col("n_neg").alias("b")), F.struct(F.lit("0").alias("s"), (F.col("_p") - F.col("n_pos")).alias("a"), (F.col("_n") - F.col("n_neg")).alias("b"))))
    long = pairs.select(F.to_json(F.struct("col", "v")).alias("k"), both.alias("_x")).select(F.col("k").alias("col"), F.col("_x.s").alias("v"), F.col("_x.a").alias("n_pos"), F.col("_x.b").alias("n_neg"))
    iv = woe_iv(long).groupBy("col").agg(F.sum("iv_part").alias("iv"))
    return iv.select(F.from_json("col", "col string, v string").alias("_k"), "iv").select("_k.col", "_k.v", "iv")


def _few_values(counts: DataFrame, limit: int) -> None:
    """Columns (col) with more than `limit` rows are an error."""
    too_many = [r.col for r in counts.groupBy("col").count().where(F.col("count") > limit).orderBy("col").collect()]  # a row per column
    if too_many:
        raise ValueError(f"more than {limit} values: {too_many}")


def fit_low_iv(df: DataFrame, columns: Sequence[str], label: str, positive: str, negative: str, *, iv_limit: float, limit: int = 5000) -> Fitted:
    """Values whose indicator's IV is at most iv_limit are merged; columns of only such are dropped. Columns with more than `limit` values are an error."""
    if not columns:
        return Fitted("merge")
    counts = value_ivs(df, columns, label, positive, negative)
    _few_values(counts, limit)
    found = counts.groupBy("col").agg(F.sort_array(F.collect_list(F.when(F.col("iv") <= iv_limit, F.col("v")))).alias("low"), F.count_if(F.col("iv") > iv_limit).alias("high")).collect()
    return Fitted("merge", tuple(sorted(r.col for r in found if not r.high)), {r.col: {"values": list(r.low), "to": LOW_IV} for r in found if r.high and r.low})


def fit_onehot(df: DataFrame, columns: Sequence[str], *, label: str | None = None, positive: str = "1", negative: str = "0", iv_limit: float | None = None, ordinal: bool = False, limit: int = 5000, unknown: str = "ignore") -> Fitted:
    """Indicator columns field~value (or ordinals). Values whose indicator's IV is at most iv_limit are merged first; a column of only such is dropped. Columns with more than `limit` values are an error.

    A value that fitting hasn't seen, or null, has no indicator and ordinal -1; with unknown="error" applying the step to it fails.
    """
    if unknown not in ("ignore", "error"):
        raise ValueError(f"unknown {unknown}")
    counts = value_counts(df, columns).where("v is not null").withColumn("iv", F.lit(math.inf)) if iv_limit is None else value_ivs(df, columns, label, positive, negative)
    _few_values(counts, limit)
    found = counts.groupBy("col").agg(F.sort_array(F.collect_list(F.struct("v", "iv"))).alias("x")).collect()
    rules, dropped = {}, []
    for r in found:
        high = [x.v for x in r.x if iv_limit is None or x.iv > iv_limit]
        low = [x.v for x in r.x if not (iv_limit is None or x.iv > iv_limit)]
        if not high:
            dropped.append(r.col)
            continue
        rules[r.col] = {"values": high + ([LOW_IV] if low else []), "merged": low} | ({"known": sorted([*high, *low])} if unknown == "error" else {})
    dropped += [c for c in columns if c not in {r.col for r in found}]
    return Fitted("ordinal" if ordinal else "onehot", tuple(sorted(dropped)), rules)


def fit_value_converter(df: DataFrame, columns: Sequence[str], *, bin_limit: int, bin_ceiling: int | None = None, floor: int | None = None) -> Fitted:
    """Merge each column's rarest values so that at most bin_limit remain; columns with bin_ceiling values or more are left alone.

    Merged are the max(values - bin_limit + 1, values below `floor` rows) smallest (ties by value) where there are more than
    bin_limit values. Defaults: ceiling min(5000, rows/2), floor min(100, rows/50).
    """
    n = df.count()
    ceiling = min(5000, n // 2) if bin_ceiling is None else bin_ceiling
    low = min(100, n // 50) if floor is None else floor
    counts = value_counts(df, columns).where("v is not null").cache()
    sizes = counts.groupBy("col").agg(F.count(F.lit(1)).alias("k"), F.count_if(F.col("n") < low).alias("few")).where((F.col("k") > bin_limit) & (F.col("k") < ceiling))  # a row per column
    r = F.row_number().over(Window.partitionBy("col").orderBy("n", "v"))  # fewer than the ceiling each
    ranked = counts.join(F.broadcast(sizes), "col").withColumn("r", r)
    merged = ranked.where(F.col("r") <= F.greatest(F.col("k") - bin_limit + 1, F.col("few"))).groupBy("col").agg(F.sort_array(F.collect_list("v")).alias("v")).collect()
    counts.unpersist()
    return Fitted("merge", (), {r.col: {"values": list(r.v), "to": RARE} for r in merged})


def fit_outliers(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> Fitted:
    """Clamp numbers to the quartiles (exact, linear) less or plus k interquartile ranges."""
    q: dict[str, dict[float, float]] = {}
    for r in quantiles(df, columns, [0.25, 0.75]).collect():  # two rows per column
        q.setdefault(r.col, {})[r.share] = r.value
    return Fitted("clamp", (), {c: {"lo": v[0.25] - k * (v[0.75] - v[0.25]), "hi": v[0.75] + k * (v[0.75] - v[0.25])} for c, v in q.items()})


def drop_outliers(df: DataFrame, clamp: Fitted) -> DataFrame:
    """Rows within all of a fitted clamp's bounds; nulls are within."""
    for c, r in clamp.rules.items():
        df = df.where(F.col(c).isNull() | F.col(c).between(r["lo"], r["hi"]))
    return df


def fit_scale(df: DataFrame, columns: Sequence[str], how: str = "standard") -> Fitted:
    """standard: mean and population deviation; minmax: to 0..1. A constant column is only shifted."""
    if how == "standard":
        row = df.agg(*(f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("a", F.avg), ("b", F.stddev_pop)))).first()
        return Fitted("scale", (), {c: {"shift": row[f"a{i}"], "by": row[f"b{i}"] or 1.0} for i, c in enumerate(columns) if row[f"a{i}"] is not None})
    row = df.agg(*(f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("a", F.min), ("b", F.max)))).first()
    return Fitted("scale", (), {c: {"shift": row[f"a{i}"], "by": (row[f"b{i}"] - row[f"a{i}"]) or 1.0} for i, c in enumerate(columns) if row[f"a{i}"] is not None})


def fit_woe(df: DataFrame, columns: Sequence[str], label: str, positive: str, negative: str, *, iv_limit: float = 0.0, r_limit: float = 1.1, turn_limit: int | None = None, gap_limit: int = 50, keep_r: bool = False, limit: int = 5000) -> tuple[Fitted, dict[str, float]]:
    """(step, iv by column): values to their WOE. Dropped are near-constant columns (rows beside the top value <= gap_limit), those with
    turn_limit WOE turns or more, those under iv_limit, and of correlated pairs (on WOE codes) the one of lower IV. A value not seen gets 0.
    Columns with more than `limit` values are an error: bin or filter them first. With keep_r each column's rule also has its IV and its correlations with the columns after it, for reasons().
    """
    counts = crosstab(df, columns, label, positive, negative).cache()
    _few_values(counts, limit)
    gaps = counts.groupBy("col").agg((F.sum(F.col("n_pos") + F.col("n_neg")) - F.max(F.col("n_pos") + F.col("n_neg"))).alias("gap"))
    woe = woe_iv(counts)
    as_number = F.coalesce(F.col("v").try_cast("double"), F.lit(math.inf))
    iv_rows = information_values(woe, F.struct(as_number, "v")).join(gaps, "col").collect()
    iv = {r.col: r.iv for r in iv_rows}
    dropped = [r.col for r in iv_rows if r.gap <= gap_limit or (turn_limit is not None and r.turns >= turn_limit) or r.iv < iv_limit]
    kept = [c for c in columns if c in iv and c not in dropped]
    maps = {r.col: dict(zip(r.v, r.w)) for r in woe.where(F.col("col").isin(kept)).groupBy("col").agg(F.collect_list(F.coalesce("v", F.lit(""))).alias("v"), F.collect_list("woe").alias("w")).collect()} if kept else {}
    counts.unpersist()
    step = Fitted("woe", tuple(dropped), {c: {"woe": m} for c, m in maps.items()})
    pairs = []
    if (keep_r or r_limit <= 1) and len(kept) > 1:
        from minespark.operators.stats import correlations

        coded = step.apply(df.select(*columns))
        pairs = [tuple(r) for r in correlations(coded, kept).where("r is not null and not isnan(r)").collect()]
        gone = drop_correlated(pairs, iv, r_limit)
        step = Fitted("woe", (*dropped, *gone), {c: r for c, r in step.rules.items() if c not in gone})
    if keep_r:
        for c, rule in step.rules.items():
            rule |= {"iv": iv[c], "r": {b: r for a, b, r in pairs if a == c and b in step.rules}}
    return step, iv
