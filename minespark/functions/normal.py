"""Normal forms of keys, months and values, as the tables' conventions define them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that count as blanks around a value: tab, line ends, space, no-break and ideographic space.
BLANKS = " \t\n\r\x0b\x0c 　"


def trimmed(c: Column) -> Column:
    """Without surrounding blanks; an empty string is null."""
    return F.nullif(F.btrim(c.cast("string"), F.lit(BLANKS)), F.lit(""))


def entity_key(c: Column) -> Column:
    """Upper case, without surrounding blanks; null stays null (no entity)."""
    return F.upper(trimmed(c))


def _six_digits(c: Column) -> Column:
    bare = F.translate(c.cast("string"), BLANKS + "-", "")
    return F.when((F.length(bare) == 6) & (F.length(F.translate(bare, "0123456789", "")) == 0), bare)


def month_of(month: Column, fallback: Column | None = None) -> Column:
    """yyyymm of `month` without blanks and hyphens if that leaves six digits, else of `fallback`; else null."""
    return _six_digits(month) if fallback is None else F.coalesce(_six_digits(month), _six_digits(fallback))


def flag(c: Column) -> Column:
    """A flag as text that is equal for equal numbers ('1', ' 1', '1.0'); other text only trimmed; empty is null."""
    t = trimmed(c)
    return F.coalesce(t.try_cast("decimal(38,10)").cast("string"), t)
