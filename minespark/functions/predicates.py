"""Predicates as lists of conjuncts: building, referenced columns, removal by column prefix."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of predicates that are no columns (fixed values).
WORDS = frozenset("and or not in is null like between case when then else end true false cast as text string int integer bigint numeric decimal double float date timestamp varchar char exists escape distinct from rlike".split())

_TOKEN = re.compile(r"\s*(?:(?P<text>'(?:[^']|'')*')|(?P<number>\d+(?:\.\d+)?)|(?P<name>[^\W\d]\w*(?:\.[^\W\d]\w*)*)|(?P<other>::|<=|>=|<>|!=|\|\||.))", re.S)


def conjuncts(where: None | float | str | Iterable[str]) -> list[str]:
    """The conjuncts of a condition: None, NaN, '' and [] give none, a text its top-level AND parts, a list those of its parts."""
    if where is None or isinstance(where, float) and math.isnan(where):
        return []
    if not isinstance(where, str):
        return [c for part in where for c in conjuncts(part)]
    return [c for c in _split_and(where) if c]


def _split_and(text: str) -> list[str]:
    parts, depth, start, pos, between, cases = [], 0, 0, 0, False, 0
    tokens = list(_tokens(text))
    if any(kind == "name" and word.lower() == "or" and d == 0 for kind, word, _, _, d in tokens):
        return [text.strip()]
    for kind, word, a, z, depth in tokens:
        low = word.lower()
        if kind != "name" or depth:
            continue
        cases += (low == "case") - (low == "end")
        if low == "between":
            between = True
        elif low == "and" and between:
            between = False
        elif low == "and" and not cases:
            parts.append(text[start:a].strip())
            start = z
        pos = z
    parts.append(text[start:].strip())
    out = []
    for p in parts:
        inner = _outer_parentheses(p)
        out += _split_and(inner) if inner is not None and len(_split_and(inner)) > 1 else [p]
    return out


def _tokens(text: str):
    depth = 0
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind is None:
            continue
        word = m.group(kind)
        if word == ")":
            depth -= 1
        yield kind, word, m.start(kind), m.end(kind), depth
        if word == "(":
            depth += 1


def _outer_parentheses(text: str) -> str | None:
    tokens = [t for t in _tokens(text) if t[1].strip()]
    if len(tokens) > 2 and tokens[0][1] == "(" and tokens[-1][1] == ")" and all(t[4] > 0 for t in tokens[1:-1]):
        return text.strip()[1:-1].strip()
    return None


def where_text(where) -> str:
    """'where ...' of a condition in any accepted form, '' without one."""
    parts = conjuncts(where)
    return "where " + " and ".join(f"({p})" if re.search(r"\bor\b", p, re.I) else p for p in parts) if parts else ""


def where(df: DataFrame, condition) -> DataFrame:
    """df filtered by all conjuncts; without any, df itself."""
    for c in conjuncts(condition):
        df = df.where(F.expr(c))
    return df


def referenced_columns(condition) -> list[str]:
    """Columns that a condition mentions, in order, lower case; functions, types, words and literals left out."""
    out: list[str] = []
    for part in conjuncts(condition):
        tokens = [t for t in _tokens(part) if t[1].strip()]
        for i, (kind, word, *_rest) in enumerate(tokens):
            follows = tokens[i + 1][1] if i + 1 < len(tokens) else ""
            before = tokens[i - 1][1].lower() if i else ""
            if kind == "name" and word.lower() not in WORDS and follows != "(" and before not in ("::", "as"):
                name = word.split(".")[-1].lower()
                if name not in out:
                    out.append(name)
    return out


def without_columns(condition, prefix: str) -> tuple[list[str], list[str]]:
    """(kept, dropped) conjuncts: dropped are those that mention a column with the prefix.

    A conjunct with OR is dropped as a whole: without one of its arms it would mean something else.
    """
    kept, dropped = [], []
    for c in conjuncts(condition):
        (dropped if any(x.startswith(prefix.lower()) for x in referenced_columns(c)) else kept).append(c)
    return kept, dropped


def three_valued(null_when: Column | None, one_when: Column) -> Column:
    """Null where null_when holds, else 1 where one_when holds, else 0. An unknown null_when doesn't hold."""
    flag = F.when(one_when, 1).otherwise(0)
    return flag if null_when is None else F.when(null_when, F.lit(None).cast("int")).otherwise(flag)


def shard(c: Column, digits: Iterable[int]) -> Column:
    """Whether an id's last character is among the digits."""
    return F.right(c.cast("string"), F.lit(1)).isin([str(d) for d in digits])
