"""Numbers as report texts, and back: intervals and percents."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bound(x: float) -> str:
    return "inf" if x == math.inf else "-inf" if x == -math.inf else f"{x:.12g}"


def interval_label(lo: float, hi: float) -> str:
    """(lo, hi] as text; bounds with at most 12 digits, infinite ones as inf."""
    return f"({_bound(lo)}, {_bound(hi)}]"


def interval_bounds(label: str) -> tuple[float, float]:
    """The bounds of an interval's text; another text is an error."""
    lo, sep, hi = label.strip().strip("([])").partition(",")
    if not sep:
        raise ValueError(f"no interval: {label}")
    return float(lo), float(hi)


def interval_of(c: Column, edges: Sequence[float]) -> Column:
    """The text of the right-closed interval that a number lies in, values outside in the end ones; null stays null."""
    x = c.cast("double")
    out = None
    for lo, hi in zip(edges[:-2], edges[1:-1]):
        out = F.when(x <= hi, interval_label(lo, hi)) if out is None else out.when(x <= hi, interval_label(lo, hi))
    last = interval_label(edges[-2], edges[-1])
    return F.when(x.isNotNull(), F.lit(last) if out is None else out.otherwise(last))


def lower_bound(c: Column) -> Column:
    """The lower bound of an interval's text, to sort by; null for other texts."""
    return F.regexp_extract(c, r"^[(\[]\s*([^,]+),", 1).try_cast("double")


def percent_text(c: Column, digits: int = 1) -> Column:
    """A share as percent text: 0.123 as 12.3%; null stays null."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f%%", F.round(c.cast("double") * 100, digits)))


def percent_value(c: Column) -> Column:
    """The share that a percent text means; null for other texts."""
    return F.when(F.endswith(c, F.lit("%")), F.rtrim(c, F.lit("%")).try_cast("double") / 100)
