"""Safe division and other column arithmetic with defined results for zeros and nulls."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Divisors from rank 1% of the positives on, at most this rank, may floor the others (fixed values).
FLOOR_SHARE, FLOOR_RANK = 0.01, 1000


def fit_floor(df: DataFrame, divisor: Column, share: float = FLOOR_SHARE, most: int = FLOOR_RANK) -> float:
    """The divisor's floor: its (k+1)-th smallest positive value, k = min(most, ceil(share x positives)), within the count.

    Without positives, the mirrored rule gives the (k+1)-th greatest negative; all zero or null gives 1.
    Only the k+1 extreme values are sorted (a bounded top-k), whatever the table's size.
    """
    x = df.select(divisor.cast("double").alias("x")).where("x is not null and not isnan(x)")
    n_pos, n_neg = x.agg(F.count_if(F.col("x") > 0), F.count_if(F.col("x") < 0)).first()
    n = n_pos or n_neg
    if not n:
        return 1.0
    k = min(most, math.ceil(n * share - 1e-9), n - 1)
    side = x.where("x > 0").orderBy("x") if n_pos else x.where("x < 0").orderBy(F.desc("x"))
    return side.limit(k + 1).agg(F.max("x") if n_pos else F.min("x")).first()[0]


def safe_div(a: Column, b: Column, floor: float) -> Column:
    """a / b with nulls as 0 and the divisor not nearer to zero than the fitted floor."""
    a, b = F.coalesce(a.cast("double"), F.lit(0.0)), F.coalesce(b.cast("double"), F.lit(0.0))
    return a / (F.greatest(b, F.lit(floor)) if floor > 0 else F.least(b, F.lit(floor)))


def guarded_log(c: Column, least: float = 1e-10) -> Column:
    """The natural logarithm of a share, not below that of `least`; null stays null."""
    return F.when(c.isNotNull(), F.ln(F.greatest(c.cast("double"), F.lit(least))))


def sum_of(*cols: Column) -> Column:
    """n-ary sum, nulls as 0."""
    out = F.coalesce(cols[0], F.lit(0))
    for c in cols[1:]:
        out = out + F.coalesce(c, F.lit(0))
    return out


def difference(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))


def paste(*cols: Column) -> Column:
    """Text cross of columns by '_'; null becomes 'unknown'."""
    return F.concat_ws("_", *(F.coalesce(c.cast("string"), F.lit("unknown")) for c in cols))


def greatest_label(pairs: list[tuple[Column, str]]) -> Column:
    """Label of the greatest column; null counts as 0, ties go to the first. All in one row, no shuffle."""
    best = F.greatest(*(F.coalesce(c.cast("double"), F.lit(0.0)) for c, _ in pairs)) if len(pairs) > 1 else None
    out = None
    for c, label in pairs[:-1]:
        hit = F.coalesce(c.cast("double"), F.lit(0.0)) == best
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(pairs[-1][1]) if out is not None else F.lit(pairs[0][1])


def last_match(rules: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """Value of the last matching rule, as assigning them one after the other would leave it."""
    out = None
    for when, value in reversed(rules):
        out = F.when(when, value) if out is None else out.when(when, value)
    return out.otherwise(otherwise) if out is not None else F.lit(otherwise)
