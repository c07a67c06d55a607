"""The wide feature table: which features a panel deserves (explore), and building them (create)."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minespark.functions.arithmetic import fit_floor
from minespark.functions.formula import DAYS_MONTH, Formula, closure, column
from minespark.operators import prep
from minespark.operators.features import FeatureDef, current_features, field_pairs, fitted, recent_defs, recent_features
from minespark.operators.panel import fill_missing, gate
from minespark.operators.stats import constant_columns, correlation_matrix, drop_correlated, finite, require
from minespark.runtime import written


@dataclass(frozen=True)
class FeaturePlan:
    """What create() builds: raw columns, current and recent features, with what they learned; `iv` of each. `floors`: fitted divisor floors of derived fields."""

    numbers: tuple[str, ...]
    categories: tuple[str, ...]
    raw: tuple[str, ...]
    current: tuple[FeatureDef, ...] = ()
    recent: tuple[FeatureDef, ...] = ()
    floors: dict = field(default_factory=dict)
    iv: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False)

    @staticmethod
    def from_json(text: str) -> FeaturePlan:
        d = json.loads(text)
        defs = lambda xs: tuple(FeatureDef(x["method"], tuple(x["inputs"]), x["value"], x["floor"]) for x in xs)
        return FeaturePlan(tuple(d["numbers"]), tuple(d["categories"]), tuple(d["raw"]), defs(d["current"]), defs(d["recent"]), d["floors"], d["iv"])


def with_formulas(panel: DataFrame, formulas: Mapping[str, Formula], *, period: str, at: str, floors: Mapping[str, float] | None = None) -> DataFrame:
    """The panel with its derived fields, inputs before what they feed."""
    for name in closure(formulas, formulas):
        if name in formulas:
            panel = panel.withColumn(name, column(formulas[name], period=period, newest=F.lit(at), floor=(floors or {}).get(name, 1.0)))
    return panel


def fitted_floors(panel: DataFrame, formulas: Mapping[str, Formula], *, period: str, at: str) -> dict[str, float]:
    """The divisor floor of each derived field that is a division (by days of the month: none), inputs before what they feed."""
    floors: dict[str, float] = {}
    for name in closure(formulas, formulas):
        f = formulas.get(name)
        if f is None:
            continue
        if f.kind == "div" and f.parts[1] != DAYS_MONTH:
            floors[name] = fit_floor(panel, F.col(f.parts[1]))
        panel = panel.withColumn(name, column(f, period=period, newest=F.lit(at), floor=floors.get(name, 1.0)))
    return floors


def prepared(panel: DataFrame, *, entity: str, period: str, at: str, n: int, numbers: Sequence[str], categories: Sequence[str], scores: Sequence[str] = (), label: str | None = None, formulas: Mapping[str, Formula] | None = None, floors: Mapping[str, float] | None = None) -> DataFrame:
    """The panel in the order that counts: scores null to 0, derived fields, quality gate with padding, then nulls to 0 and 'unknown'."""
    rows = panel.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in scores})
    rows = with_formulas(rows, formulas or {}, period=period, at=at, floors=floors)
    rows = gate(rows, entity=entity, period=period, n=n, label=label, at=at, equate="fill")
    return fill_missing(rows, numbers=numbers, categories=categories)


def explore(panel: DataFrame, *, entity: str, period: str, at: str, label: str, positive: str, negative: str, numbers: Sequence[str], categories: Mapping[str, Sequence] | None = None, pairs: bool = False, iv_limit: float = 0.02, r_limit: float = 0.8, unique_limit: int = 5000, valuecount_limit: int = 50, no_current: Sequence[str] = (), no_recent: Sequence[str] = ()) -> FeaturePlan:
    """Features worth building, block by block (raw, pairs, one-hot, one method of recent features after the other).

    Of each block, columns under iv_limit and correlated ones are dropped; then, against what is already chosen, of each pair with
    |r| >= r_limit, in falling order, the one of lower IV (tie: the new one). `panel` is prepared().
    Before that, constant columns and categories with unique_limit values or more are dropped, values of at most valuecount_limit rows and those
    whose indicator's IV is at most iv_limit are merged. Columns of no_current or no_recent give no such features.

    All blocks are built once, as one wide table; bins, WOE and the correlation matrix each take one pass over it. The blocks' order only
    matters for the choice, which is made on the matrix (columns x columns numbers).
    """
    cats = dict(categories or {})
    now = panel.where(F.col(period) == at)
    blocks: list[list[FeatureDef]] = []
    if pairs:
        blocks.append([FeatureDef(m, p) for m in ("add", "sub", "mult", "div") for p in field_pairs([c for c in numbers if c not in no_current])])
    blocks.append([FeatureDef("onehot", (c,), v) for c, vs in cats.items() if c not in no_current for v in vs])
    current = fitted(panel, [d for b in blocks for d in b], period=period, at=at)
    methods = ("avg", "sep", "wave", "grow", "max", "min", "std", "more0cnt", "moreq25cnt", "valuecnt")
    recents = [recent_defs([c for c in numbers if c not in no_recent], {c: v for c, v in cats.items() if c not in no_recent}, [m]) for m in methods]
    recent = fitted(panel, [d for b in recents for d in b], period=period, at=at, entity=entity)
    defs = {d.name: d for d in (*current, *recent)}
    wide = current_features(now, current).select(entity, F.col(label).cast("string").alias("_y"), *numbers, *cats, *(f"`{d.name}`" for d in current))
    if recent:
        wide = wide.join(recent_features(panel, recent, entity=entity, period=period, at=at), entity)
    wide = written(wide.drop(entity), "explore")
    order = [[*numbers, *cats], *([d.name for d in b] for b in (*blocks, *recents))]
    names = [c for b in order for c in b]
    flat = constant_columns(wide, [c for c in names if c not in cats])  # numbers: one aggregation, no counting of their values
    screen = prep.fit_prefilter(wide, [], list(cats), freq_limit=1.0, unique_limit=unique_limit, valuecount_limit=valuecount_limit) if cats else []
    coded = prep.apply_all([prep.Fitted("drop", tuple(flat)), *screen], wide)
    coded = prep.fit_low_iv(coded, [c for c in cats if c in coded.columns], "_y", positive, negative, iv_limit=iv_limit, limit=unique_limit).apply(coded)
    numeric = [c for c in names if c not in cats and c in coded.columns]
    coded = prep.fit_mdlp(coded, numeric, "_y", positive, negative, drop_unsplit=True).apply(coded) if numeric else coded
    left = [c for c in names if c in coded.columns]
    step, iv = prep.fit_woe(coded, left, "_y", positive, negative, iv_limit=iv_limit, limit=max(5000, unique_limit)) if left else (prep.Fitted("woe"), {})
    r = correlation_matrix(step.apply(coded), [c for c in left if c in step.rules])
    chosen: list[str] = []
    for block in order:
        new = [c for c in block if c in step.rules]
        gone = drop_correlated([(a, b, r[a, b]) for i, a in enumerate(new) for b in new[i + 1 :]], iv, r_limit)
        new = [c for c in new if c not in gone]
        gone = drop_correlated([(a, b, r[a, b]) for a in chosen for b in new], iv, r_limit)
        chosen = [c for c in (*chosen, *new) if c not in gone]
    picked = [defs[c] for c in chosen if c in defs]
    own = {d.name for d in current}
    return FeaturePlan(
        tuple(numbers), tuple(cats), tuple(c for c in chosen if c not in defs),
        tuple(d for d in picked if d.name in own), tuple(d for d in picked if d.name not in own), {}, {c: iv[c] for c in chosen},
    )


def create(panel: DataFrame, plan: FeaturePlan, *, entity: str, period: str, at: str, keep: Sequence[str] = ()) -> DataFrame:
    """The planned features of each entity: one grouping over the prepared panel, joined to the current period."""
    now = current_features(panel.where(F.col(period) == at), plan.current).select(entity, *keep, *(f"`{c}`" for c in plan.raw), *(f"`{d.name}`" for d in plan.current))
    if not plan.recent:
        return now
    return now.join(recent_features(panel, plan.recent, entity=entity, period=period, at=at), entity)


def check_created(wide: DataFrame, plan: FeaturePlan) -> None:
    """No null, NaN or infinity may be left in the built numbers."""
    require(wide, finite([d.name for d in (*plan.current, *plan.recent) if "~" not in d.name and "." not in d.name]))
