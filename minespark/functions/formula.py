"""The derivation formulas of a field dictionary as Column expressions, and the lineage between fields."""

from __future__ import annotations

import ast
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from minespark.functions import arithmetic
from minespark.functions.periods import month_days, months_between_rounded, parse_partial_date

_NAME = r"[^\W\d]\w*"
#: Names in formulas that are no fields (fixed values).
DAYS_MONTH, TODAY = "days_month", "current_date"


@dataclass(frozen=True)
class Formula:
    """A parsed formula: its kind, the fields it reads, and its parts."""

    kind: str
    inputs: tuple[str, ...]
    parts: tuple = ()


def parse(name: str, text: str) -> Formula:
    """The formula of field `name`. Kinds by the field's prefix (paste_, greatest_, casewhen_, ago_) or by operator; others are errors.

    Nothing is evaluated: literals are read by ast.literal_eval, conditions by a small grammar.
    """
    text = text.strip()
    if name.startswith("ago_"):
        rule = ast.literal_eval(text)
        if set(rule) != {"notago_tovalue"}:
            raise ValueError(f"{name}: {text}")
        return Formula("ago", (name.removeprefix("ago_"),), (rule["notago_tovalue"],))
    if name.startswith("paste_"):
        fields = tuple(x.strip() for x in text.strip("()").split(",") if x.strip())
        return Formula("paste", fields)
    if name.startswith("greatest_"):
        labels = _pairs(text)
        return Formula("greatest", tuple(labels), tuple(labels.items()))
    if name.startswith("casewhen_"):
        rules = _pairs(text)
        parsed = tuple((None if k == "else" else _condition(k), v) for k, v in rules.items())
        fields = tuple(dict.fromkeys(f for c, _ in parsed if c for arm in c for f, _, _ in arm))
        return Formula("casewhen", fields, parsed)
    for kind, sign in (("div", "/"), ("sum", "+"), ("sub", "-")):
        if re.fullmatch(rf"{_NAME}(\s*{re.escape(sign)}\s*{_NAME})+", text):
            fields = tuple(x.strip() for x in text.split(sign))
            if kind != "sum" and len(fields) != 2:
                break
            return Formula(kind, tuple(f for f in fields if f not in (DAYS_MONTH, TODAY)), fields)
    raise ValueError(f"no formula: {name} = {text}")


def _pairs(text: str) -> dict:
    """{key: value, ...} whose keys may be bare; values are literals or bare words."""
    out = {}
    for part in re.findall(r"((?:'[^']*'|\"[^\"]*\"|[^,'\"])+)", text.strip().strip("{}")):
        if not part.strip():
            continue
        k, _, v = part.rpartition(":")
        out[_bare(k)] = _literal(v.strip())
    return out


def _bare(text: str) -> str:
    text = text.strip()
    return text[1:-1] if len(text) > 1 and text[0] == text[-1] and text[0] in "'\"" and text[0] not in text[1:-1] else text


def _literal(text: str):
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def _condition(text: str) -> tuple:
    """OR arms of AND-ed (field, operator, value) comparisons."""
    arms = []
    for arm in re.split(r"\||\bor\b", text):
        tests = []
        for test in re.split(r"&|\band\b", arm):
            m = re.fullmatch(rf"\s*\(?\s*({_NAME})\s*(==|>=|<=|!=|>|<)\s*(.+?)\s*\)?\s*", test)
            if not m:
                raise ValueError(f"no condition: {test}")
            tests.append((m[1], m[2], _literal(m[3])))
        arms.append(tuple(tests))
    return tuple(arms)


_TESTS = {
    "==": lambda c, v: c == v, "!=": lambda c, v: c != v, ">=": lambda c, v: c >= v,
    "<=": lambda c, v: c <= v, ">": lambda c, v: c > v, "<": lambda c, v: c < v,
}


def column(f: Formula, *, period: str, newest: Column | None = None, floor: float = 1.0) -> Column:
    """The formula as a Column over its fields. `floor` is the fitted divisor floor of a division, `newest` the latest period of 'ago'."""
    field = lambda x: month_days(F.col(period)) if x == DAYS_MONTH else F.col(x)
    if f.kind == "ago":
        return F.when(F.col(period) == newest, F.lit(f.parts[0])).otherwise(F.col(f.inputs[0]))
    if f.kind == "paste":
        return arithmetic.paste(*map(F.col, f.inputs))
    if f.kind == "greatest":
        return arithmetic.greatest_label([(F.col(c), label) for c, label in f.parts])
    if f.kind == "casewhen":
        rules, other = [], None
        for cond, value in f.parts:
            if cond is None:
                other = value
                continue
            arms = None
            for arm in cond:
                one = None
                for name, op, v in arm:
                    t = F.coalesce(_TESTS[op](F.col(name), F.lit(v)), F.lit(op == "!="))
                    one = t if one is None else one & t
                arms = one if arms is None else arms | one
            rules.append((arms, value))
        return arithmetic.last_match(rules, other)
    if f.kind == "sum":
        return arithmetic.sum_of(*map(field, f.parts))
    if f.kind == "div":
        return arithmetic.safe_div(field(f.parts[0]), field(f.parts[1]), floor)
    if TODAY in f.parts:
        dates = [F.current_date() if x == TODAY else parse_partial_date(F.col(x)) for x in f.parts]
        return months_between_rounded(*dates)
    return arithmetic.difference(*map(field, f.parts))


def closure(wanted: Iterable[str], formulas: Mapping[str, Formula]) -> list[str]:
    """The wanted fields and everything they are derived from, inputs before what they feed; a cycle is an error."""
    out: list[str] = []
    path: set[str] = set()

    def visit(name: str) -> None:
        if name in out:
            return
        if name in path:
            raise ValueError(f"{name} is derived from itself")
        path.add(name)
        for x in formulas[name].inputs if name in formulas else ():
            visit(x)
        path.discard(name)
        out.append(name)

    for w in wanted:
        visit(w)
    return out


def base_columns(wanted: Iterable[str], formulas: Mapping[str, Formula]) -> list[str]:
    """Fields to read for the wanted ones. Wide-table names (method__field, method__a__b, field~value) are resolved first."""
    plain = []
    for w in wanted:
        parts = w.split("__")
        plain += [x.split("~")[0] for x in (parts[1:] if len(parts) > 1 else parts)]
    return [x for x in closure(dict.fromkeys(plain), formulas) if x not in formulas]


def without_unavailable(fields: Iterable[str], unavailable: Iterable[str], formulas: Mapping[str, Formula]) -> list[str]:
    """fields less the unavailable ones and everything derived from them."""
    gone = set(unavailable)
    return [f for f in fields if not gone & set(closure([f], formulas))]
