"""Typed specifications (fields, tables, models) and their tab-separated text form."""

from __future__ import annotations

import ast
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame, SparkSession

NUMBER, CATEGORY, DATE = "数值型", "类别型", "日期型"
#: Texts that mean a missing value in a specification (fixed values).
MISSING = ("", "None", "nan", "np.nan", "NaN")


def kind_of_type(db_type: str) -> str:
    """Semantic class of a database type; an unknown one is an error."""
    t = db_type.lower()
    if re.search(r"numeric|int|double|float|decimal|real", t):
        return NUMBER
    if re.search(r"char|text|string", t):
        return CATEGORY
    if re.search(r"date|timestamp", t):
        return DATE
    raise ValueError(f"no class for type {db_type}")


def typed_literal(text: str) -> object:
    """Quoted text without its quotes, digits as int, digits with a point as float, other text as it is."""
    t = text.strip()
    if len(t) > 1 and t[0] == t[-1] and t[0] in "'\"":
        return t[1:-1]
    if re.fullmatch(r"-?\d+", t):
        return int(t)
    return float(t) if re.fullmatch(r"-?(\d+\.\d*|\.\d+)", t) else t


def read_rows(text: str, sep: str = "\t", line_break: str = "\n", missing: Iterable[str] = MISSING) -> tuple[list[str], list[dict[str, str | None]]]:
    """(columns, rows) of a text table with a header; columns without a name are dropped, short rows are filled with None."""
    lines = [x for x in text.strip(line_break).split(line_break) if x.strip()]
    if not lines:
        return [], []
    head = [x.strip() for x in lines[0].split(sep)]
    gone = set(missing)
    rows = []
    for line in lines[1:]:
        cells = [x.strip() for x in line.split(sep)] + [""] * len(head)
        rows.append({h: None if v in gone else v for h, v in zip(head, cells) if h})
    return [h for h in head if h], rows


def text_to_frame(spark: SparkSession, text: str, types: dict[str, str] | None = None, **how) -> DataFrame:
    """A text table as a DataFrame: strings, cast to `types` (column to Spark type) where given."""
    columns, rows = read_rows(text, **how)
    df = spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], ", ".join(f"`{c}` string" for c in columns) or "empty string")
    return df.select(*(df[c].try_cast(t).alias(c) if (t := (types or {}).get(c)) else df[c] for c in columns))


@dataclass(frozen=True)
class FieldSpec:
    """One field of the data dictionary."""

    name: str
    comment: str = ""
    db_type: str = "text"
    kind: str = CATEGORY
    origin: str = "raw"
    table: str = ""
    available: bool = True
    formula: str | None = None
    must_remain: bool = False
    into_model: bool = True
    is_cause: bool = True
    auto: bool = True
    current: bool = True
    recent: bool = True


@dataclass(frozen=True)
class TableSpec:
    """The role of a table: main, add, day, score or label."""

    role: str
    name: str
    on: Sequence[str] = ()
    prefix: str = ""
    day_column: str | None = None
    day_of_next_month: int | None = None
    pivot: tuple[str, str] | None = None


@dataclass(frozen=True)
class ModelSpec:
    """A model's static and dynamic information with its defaults."""

    name: str
    short_name: str
    month_train: str
    month_test: str | None = None
    month_predict: str | None = None
    label: str = "label"
    positive: str = "1"
    negative: str = "0"
    target_lag: int = 1
    condition: tuple[str, ...] = ()
    col_month: str = "acct_month"
    col_id: str = "user_no"
    positive_limit: int = 10_000
    train_ratio: float = 1.0
    cumulated_months: int = 0
    timein_count: int = 50_000
    timeout_limit: int = 100_000
    ratios: tuple = ("actual",)
    freq_limit: float = 0.95
    unique_limit: int = 5000
    valuecount_limit: int = 50
    iv_limit: float = 0.2
    r_limit: float = 0.8
    n_recent: int = 3
    stratified: str | None = None
    sort_ties: tuple[tuple[str, bool], ...] = ()
    null_label: str = "del"
    outputs: tuple[str, ...] = ()
    out_dir: str = "out"
    extra: dict = field(default_factory=dict, hash=False, compare=False)

    def __post_init__(self) -> None:
        if self.positive == self.negative:
            raise ValueError(f"{self.name}: positive and negative label are equal")
        if self.null_label not in ("del", "positive", "negative"):
            raise ValueError(f"{self.name}: null_label {self.null_label}")
        if self.n_recent < 1 or self.positive_limit < 1:
            raise ValueError(f"{self.name}: limits must be positive")

    def path(self, what: str, period: str | None = None) -> str:
        """Where a result of this model is kept."""
        return f"{self.out_dir}/{self.short_name}/{what}_{period or self.month_train}"

    def with_condition(self, condition: Sequence[str]) -> ModelSpec:
        return replace(self, condition=tuple(condition))


def read_infos(text: str, *, literal: Sequence[str] = (), typed: Sequence[str] = (), key: str = "model_name", keep_marked: bool = False, drop: Sequence[str] = ()) -> dict[str, dict]:
    """Model information by model name. Names that begin with # are left out, or kept without it; `literal` columns are Python literals."""
    columns, rows = read_rows(text)
    out: dict[str, dict] = {}
    for row in rows:
        name = row[key] or ""
        if name.startswith("#"):
            if not keep_marked:
                continue
            name = name.lstrip("#").strip()
        if name in drop:
            continue
        if name in out:
            raise ValueError(f"{name} occurs twice")
        value = {c: ast.literal_eval(v) if c in literal and v is not None else typed_literal(v) if c in typed and v is not None else v for c, v in row.items()}
        out[name] = value | {key: name}
    return out


def model_specs(static: dict[str, dict], dynamic: dict[str, dict]) -> dict[str, ModelSpec]:
    """Dynamic information joined to the static one; a model without static information is an error, unknown keys go to `extra`.

    A `base_condition` (of the population) is added to the model's own condition.
    """
    from minespark.functions.predicates import conjuncts

    known = {f.name for f in fields(ModelSpec)}
    out = {}
    for name, info in dynamic.items():
        if name not in static:
            raise ValueError(f"no static information for {name}")
        merged = {k: v for k, v in (static[name] | info).items() if v is not None and k != "model_name"}
        base = merged.pop("base_condition", None)
        own = {k: tuple(v) if isinstance(v, list) else v for k, v in merged.items() if k in known}
        if base is not None or "condition" in own:
            own["condition"] = tuple(conjuncts([x for x in (own.get("condition"), base) if x is not None]))
        out[name] = ModelSpec(**({"name": name, "short_name": name} | own), extra={k: v for k, v in merged.items() if k not in known})
    return out


def table_columns(specs: Sequence[FieldSpec], table: str) -> list[str]:
    """The fields that a table has by the dictionary, each once, in order."""
    return list(dict.fromkeys(s.name for s in specs if s.table == table and s.origin == "raw"))


@dataclass(frozen=True)
class FieldUse:
    """What a dictionary's fields are used for: model inputs by kind, columns without features of the current or of recent periods, columns that
    are no reasons, columns that stay in any case, and the formulas of derived fields."""

    numbers: tuple[str, ...]
    categories: tuple[str, ...]
    no_current: tuple[str, ...]
    no_recent: tuple[str, ...]
    not_causes: tuple[str, ...]
    must_remain: tuple[str, ...]
    formulas: dict[str, str]


def field_use(specs: Sequence[FieldSpec]) -> FieldUse:
    """The rules of a dictionary: fields that aren't available, and what is derived from them, take no part; a field without `auto` gives no derived
    features at all, one without `current` or `recent` none of that kind, one without `into_model` is no input."""
    from minespark.functions.formula import parse, without_unavailable

    formulas = {s.name: s.formula for s in specs if s.origin == "manual_python" and s.formula}
    parsed = {n: parse(n, f) for n, f in formulas.items()}
    names = set(without_unavailable([s.name for s in specs], [s.name for s in specs if not s.available], parsed))
    there = [s for s in specs if s.name in names]
    pick = lambda test: tuple(s.name for s in there if test(s))
    return FieldUse(
        pick(lambda s: s.kind == NUMBER and s.into_model), pick(lambda s: s.kind == CATEGORY and s.into_model), pick(lambda s: not (s.auto and s.current)),
        pick(lambda s: not (s.auto and s.recent)), pick(lambda s: not s.is_cause), pick(lambda s: s.must_remain), {n: f for n, f in formulas.items() if n in names},
    )


def check_fields(specs: Sequence[FieldSpec], tables: Iterable[str] = ()) -> list[str]:
    """What is wrong with a dictionary: repeated names, unclassified types, missing or superfluous tables, missing formulas."""
    found = []
    names = [s.name for s in specs]
    found += [f"{n} occurs more than once" for n in sorted({n for n in names if names.count(n) > 1})]
    for s in specs:
        if s.kind not in (NUMBER, CATEGORY, DATE):
            found.append(f"{s.name}: kind {s.kind}")
        if s.origin == "raw" and not s.table:
            found.append(f"{s.name}: no table")
        if s.origin in ("manual_python", "manual_sql") and not s.formula:
            found.append(f"{s.name}: no formula")
    tables = set(tables)
    if tables:
        used = {s.table for s in specs if s.table}
        found += [f"table {t} is unknown" for t in sorted(used - tables)] + [f"table {t} has no field" for t in sorted(tables - used)]
    return found
