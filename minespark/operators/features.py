"""Features over an entity's recent periods, of the current period, and of pairs of columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minespark.functions.arithmetic import fit_floor, safe_div
from minespark.operators.ranking import quantiles

RECENT = ("avg", "std", "min", "max", "sep", "wave", "grow", "more0cnt", "moreq25cnt", "valuecnt")
PAIR = ("add", "sub", "mult", "div")
#: Aggregates per grouping, so that generated code stays below the JVM's method size.
AGGS_AT_ONCE = 200


@dataclass(frozen=True)
class FeatureDef:
    """A derived column: its method, input columns and, for valuecnt, onehot and moreq25cnt, a value. `floor`: the fitted divisor floor of div and grow."""

    method: str
    inputs: tuple[str, ...]
    value: object = None
    floor: float | None = None

    @property
    def name(self) -> str:
        """method__field, method__a__b, valuecnt__field~value or field~value."""
        if self.method == "onehot":
            return f"{self.inputs[0]}~{self.value}"
        return "__".join((self.method, *self.inputs)) + (f"~{self.value}" if self.method == "valuecnt" else "")


def field_pairs(columns: Iterable[str], n: int = 2) -> list[tuple[str, ...]]:
    return list(combinations(columns, n))


def recent_defs(numbers: Sequence[str], categories: Mapping[str, Sequence] | None = None, methods: Sequence[str] = RECENT) -> list[FeatureDef]:
    """Definitions of all recent features of the columns; `categories` maps a column to its values."""
    out = [FeatureDef(m, (c,)) for m in methods if m != "valuecnt" for c in numbers]
    return out + [FeatureDef("valuecnt", (c,), v) for c, values in (categories or {}).items() for v in values if "valuecnt" in methods]


def fitted(panel: DataFrame, defs: Sequence[FeatureDef], *, period: str, at: str, entity: str | None = None) -> list[FeatureDef]:
    """The definitions with what they learn: moreq25cnt the current period's exact lower quartile, div its divisor's floor, and grow too if `entity` is given."""
    out = []
    now = panel.where(F.col(period) == at)
    q25 = [d for d in defs if d.method == "moreq25cnt" and d.value is None]
    learned = {r.col: r.value for r in quantiles(now, [d.inputs[0] for d in q25], [0.25]).collect()} if q25 else {}
    grow = grow_floors(panel, [d.inputs[0] for d in defs if d.method == "grow" and d.floor is None], entity=entity, period=period, at=at) if entity is not None else {}
    for d in defs:
        if d.method == "moreq25cnt" and d.value is None:
            d = replace(d, value=learned.get(d.inputs[0]))
        elif d.method == "div":
            d = replace(d, floor=fit_floor(now, F.col(d.inputs[1])))
        elif d.method == "grow" and d.inputs[0] in grow:
            d = replace(d, floor=grow[d.inputs[0]])
        out.append(d)
    return out


def grow_floors(panel: DataFrame, columns: Sequence[str], *, entity: str, period: str, at: str) -> dict[str, float]:
    """The divisor floors of grow: of each column's mean over the periods before `at`."""
    if not columns:
        return {}
    means = panel.where(F.col(period) < at).groupBy(entity).agg(*(F.avg(c).alias(c) for c in columns))
    return {c: fit_floor(means, F.col(c)) for c in columns}


def recent_features(panel: DataFrame, defs: Sequence[FeatureDef], *, entity: str, period: str, at: str, floors: Mapping[str, float] | None = None) -> DataFrame:
    """One row per entity: features over its (padded, zero-filled) periods. `at` is the current period.

    std is the sample's; sep = std/avg, 0 if avg is 0; wave = (max-min)/avg, 1 if avg is 0; grow = current / mean of the
    earlier ones by safe division (`floors` by column, else the definition's, else fitted here). One shuffle on the entity; many features are aggregated in
    slices of AGGS_AT_ONCE over the same partitioning.
    """
    floors = {d.inputs[0]: d.floor for d in defs if d.method == "grow" and d.floor is not None} | dict(floors or {})
    floors |= grow_floors(panel, [d.inputs[0] for d in defs if d.method == "grow" and d.inputs[0] not in floors], entity=entity, period=period, at=at)
    aggs = [_recent(d, F.col(period), at, floors).alias(d.name) for d in defs]
    if len(aggs) <= AGGS_AT_ONCE:
        return panel.groupBy(entity).agg(*aggs)
    spread = panel.repartition(entity)
    out = None
    for i in range(0, len(aggs), AGGS_AT_ONCE):
        part = spread.groupBy(entity).agg(*aggs[i : i + AGGS_AT_ONCE])
        out = part if out is None else out.join(part, entity)
    return out


def _recent(d: FeatureDef, period: Column, at: str, floors: Mapping[str, float]) -> Column:
    x = F.col(d.inputs[0])
    avg = F.avg(x)
    simple = {"avg": lambda: avg, "std": lambda: F.stddev_samp(x), "min": lambda: F.min(x), "max": lambda: F.max(x)}
    if d.method in simple:
        return simple[d.method]()
    if d.method == "sep":
        return F.when(avg == 0, 0.0).otherwise(F.stddev_samp(x) / F.nullif(avg, F.lit(0)))
    if d.method == "wave":
        return F.when(avg == 0, 1.0).otherwise((F.max(x) - F.min(x)) / F.nullif(avg, F.lit(0)))
    if d.method == "grow":
        return safe_div(F.max(F.when(period == at, x)), F.avg(F.when(period < at, x)), floors[d.inputs[0]])
    if d.method == "more0cnt":
        return F.count_if(x > 0)
    if d.method == "moreq25cnt":
        return F.count_if(x > F.lit(d.value))
    if d.method == "valuecnt":
        return F.count_if(x == F.lit(d.value))
    raise ValueError(f"no method {d.method}")


def current_features(now: DataFrame, defs: Sequence[FeatureDef]) -> DataFrame:
    """now with one-hot columns (field~value) and pair columns (add__a__b, ...); no shuffle."""
    out = {}
    for d in defs:
        a, b = (F.col(f"`{c}`") for c in (d.inputs * 2)[:2])
        if d.method == "onehot":
            out[d.name] = F.coalesce((a == F.lit(d.value)).cast("int"), F.lit(0))
        elif d.method in PAIR:
            out[d.name] = {"add": a + b, "sub": a - b, "mult": a * b, "div": safe_div(a, b, 1.0 if d.floor is None else d.floor)}[d.method]
        else:
            raise ValueError(f"no method {d.method}")
    return now.withColumns(out)


def known_values(defs: Sequence[FeatureDef], observed: Mapping[str, set]) -> tuple[list[FeatureDef], list[FeatureDef]]:
    """(usable, skipped): valuecnt and onehot features whose value was observed, and those to warn of."""
    ok, gone = [], []
    for d in defs:
        (gone if d.method in ("valuecnt", "onehot") and d.value not in observed.get(d.inputs[0], {d.value}) else ok).append(d)
    return ok, gone
