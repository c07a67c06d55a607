"""Periods held as text (yyyymm or yyyymmdd): arithmetic, lists, alignment, partial dates, unbroken runs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Latest date that nanosecond timestamps hold; later ones are taken as this month's first day (fixed value).
LAST_DATE, LAST_DATE_AS = "22620411", "22620401"
#: Months between two dates of which one is missing (fixed value).
NO_MONTHS = -99999


def month_add(period: str | int, months: int) -> str | int:
    """`period` (yyyymm or yyyymmdd, text or number) moved by whole months; the type stays, a day is kept as text."""
    text = str(period)
    n = int(text[:4]) * 12 + int(text[4:6]) - 1 + months
    out = f"{n // 12:04d}{n % 12 + 1:02d}{text[6:]}"
    return int(out) if isinstance(period, int) else out


def month_list(start: str | int, end: str | int | None = None, periods: int | None = None) -> list:
    """start to end inclusive, or `periods` months from start on (backward and ascending if negative); exactly one of both."""
    if (end is None) == (periods is None):
        raise ValueError("give either end or periods")
    if end is not None:
        out, m = [], start
        while m <= end:
            out.append(m)
            m = month_add(m, 1)
        return out
    first = start if periods > 0 else month_add(start, periods + 1)
    return [month_add(first, i) for i in range(abs(periods))]


def days_in_month(period: str | int) -> int:
    text = str(month_add(str(period)[:6], 1))
    first = date(int(str(period)[:4]), int(str(period)[4:6]), 1)
    return (date(int(text[:4]), int(text[4:6]), 1) - first).days


def day_of_next_month(period: str | int, day: int) -> str:
    return f"{month_add(str(period)[:6], 1)}{day:02d}"


def add_months(c: Column, months: int) -> Column:
    """Column version of month_add for yyyymm text; null stays null, text that is no month gives null."""
    return F.date_format(F.add_months(period_start(c), months), "yyyyMM")


def period_start(c: Column) -> Column:
    """First day of a yyyymm text; null if it isn't one."""
    return F.try_to_timestamp(F.concat(c.cast("string"), F.lit("01")), F.lit("yyyyMMdd")).cast("date")


def month_days(c: Column) -> Column:
    return F.day(F.last_day(period_start(c)))


def parse_partial_date(c: Column, cap: bool = True) -> Column:
    """Date of yyyymm (day 01), yyyymmdd or longer text; dates after LAST_DATE become LAST_DATE_AS if `cap`; else null."""
    text = c.cast("string")
    full = F.when(F.length(text) == 6, F.concat(text, F.lit("01"))).otherwise(F.substring(text, 1, 8))
    if cap:
        digits = F.length(F.translate(full, "0123456789", "")) == 0
        full = F.when(digits & (full > LAST_DATE), F.lit(LAST_DATE_AS)).otherwise(full)
    return F.try_to_timestamp(full, F.lit("yyyyMMdd")).cast("date")


def months_between_rounded(later: Column, earlier: Column) -> Column:
    """Days between two dates / 30, rounded half to even; NO_MONTHS if either is null."""
    days = F.datediff(later, earlier)
    return F.coalesce(F.bround(days / 30, 0).cast("int"), F.lit(NO_MONTHS))


def align_months(df: DataFrame, *, base: str, period: str, entity: str, newest: str | None = None) -> DataFrame:
    """Move the periods of several base months to the newest one and mark the ids by their base month.

    Adds a_period and a_entity. The newest base month is given, or one aggregated value, joined back as one row.
    Null base or period gives a null a_period.
    """
    newest = df.agg(F.max(base).alias("_newest")) if newest is None else df.sparkSession.createDataFrame([(newest,)], "_newest string")
    shift = F.round(F.months_between(period_start(F.col("_newest")), period_start(F.col(base)))).cast("int")
    moved = F.date_format(F.add_months(period_start(F.col(period)), shift), "yyyyMM")
    return df.join(F.broadcast(newest)).select(*df.columns, moved.alias("a_period"), F.concat_ws("_", F.col(base), F.col(entity).cast("string")).alias("a_entity"))


def first_of_latest_run(periods: Sequence[str | int]) -> str | int:
    """First period of the unbroken run that ends at the last one."""
    found = sorted(set(periods))
    if not found:
        raise ValueError("no periods")
    first = found[-1]
    for p in reversed(found[:-1]):
        if month_add(p, 1) != first:
            break
        first = p
    return first


def latest_runs(df: DataFrame, *, entity: str, day_number: str) -> DataFrame:
    """(entity, run_start, run_end, run_length): each entity's unbroken run that ends at its last period.

    `day_number` counts periods by whole numbers. Repeated periods count once, nulls not.
    """
    days = df.select(entity, day_number).dropna().distinct()
    w = Window.partitionBy(entity).orderBy(day_number)
    runs = days.withColumn("_g", F.col(day_number) - F.row_number().over(w)).groupBy(entity, "_g").agg(F.min(day_number).alias("run_start"), F.max(day_number).alias("run_end"), F.count(F.lit(1)).alias("run_length"))
    last = F.max(F.struct("run_end", "run_start", "run_length")).alias("r")
    return runs.groupBy(entity).agg(last).select(entity, "r.run_start", "r.run_end", "r.run_length")
