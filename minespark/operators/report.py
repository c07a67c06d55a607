"""Reports: screening tables and the clean-up of bin tables (small tables of bins, on the driver)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minespark.functions.texts import interval_label


@dataclass(frozen=True)
class Bin:
    """A right-closed bin (lo, hi] with its class counts."""

    lo: float
    hi: float
    n_pos: int
    n_neg: int

    @property
    def n(self) -> int:
        return self.n_pos + self.n_neg

    @property
    def rate(self) -> float:
        return self.n_pos / self.n if self.n else 0.0


def sorted_bins(bins: Sequence[Bin]) -> list[Bin]:
    return sorted(bins, key=lambda b: (b.lo, b.hi))


def merge(bins: Sequence[Bin], i: int) -> list[Bin]:
    """Bins i and i + 1 as one; they must be adjacent."""
    a, b = bins[i], bins[i + 1]
    if a.hi != b.lo:
        raise ValueError(f"({a.lo}, {a.hi}] and ({b.lo}, {b.hi}] are not adjacent")
    return [*bins[:i], Bin(a.lo, b.hi, a.n_pos + b.n_pos, a.n_neg + b.n_neg), *bins[i + 2 :]]


def merge_small(bins: Sequence[Bin], least: float) -> list[Bin]:
    """Bins under `least` rows go, smallest first, to the neighbour of nearest rate (tie: the lower)."""
    out = sorted_bins(bins)
    while len(out) > 1:
        i = min(range(len(out)), key=lambda j: (out[j].n, j))
        if out[i].n >= least:
            break
        sides = [j for j in (i - 1, i + 1) if 0 <= j < len(out)]
        j = min(sides, key=lambda j: (abs(out[j].rate - out[i].rate), j))
        out = merge(out, min(i, j))
    return out


def merge_similar(bins: Sequence[Bin], least: float) -> list[Bin]:
    """Neighbours whose rates differ by less than `least` are merged, nearest first."""
    out = sorted_bins(bins)
    while len(out) > 1:
        gaps = [abs(a.rate - b.rate) for a, b in zip(out, out[1:])]
        i = int(np.argmin(gaps))
        if gaps[i] >= least:
            break
        out = merge(out, i)
    return out


def fits(bins: Sequence[Bin], limit: float) -> bool:
    """Whether the rates follow a line or a parabola over the bins' places with R2 >= limit."""
    y = np.array([b.rate for b in bins])
    if len(y) <= 3 or y.std() == 0:
        return True
    x = np.arange(len(y))
    r2 = lambda d: 1 - ((y - np.polyval(np.polyfit(x, y, d), x)) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    return max(r2(1), r2(2)) >= limit


def merge_turning(bins: Sequence[Bin], limit: float) -> list[Bin]:
    """Bins at the largest jump against the trend are merged until the rates fit (fits) or three are left."""
    out = sorted_bins(bins)
    while not fits(out, limit):
        steps = np.diff([b.rate for b in out])
        trend = np.sign(out[-1].rate - out[0].rate) or 1.0
        against = np.where(np.sign(steps) != trend, np.abs(steps), -1.0)
        i = int(np.argmax(against if (against >= 0).any() else -np.abs(steps)))
        out = merge(out, i)
    return out


def clean_bins(bins: Sequence[Bin], *, least_rows: float | None = None, least_gap: float | None = None, r2: float = 0.8) -> list[Bin]:
    """Small, similar and turning bins merged in turn. Defaults: min(500, 1% of the rows), min(1%, half the natural rate)."""
    n, p = sum(b.n for b in bins), sum(b.n_pos for b in bins)
    rows = min(500, 0.01 * n) if least_rows is None else least_rows
    gap = min(0.01, 0.5 * p / n if n else 0) if least_gap is None else least_gap
    return merge_turning(merge_similar(merge_small(bins, rows), gap), r2)


def chart_rows(bins: Sequence[Bin]) -> list[tuple[str, int, float, float]]:
    """(label, rows, share of the rows, rate) of each bin in order: what a chart of it shows."""
    total = sum(b.n for b in bins)
    return [(interval_label(b.lo, b.hi), b.n, b.n / total if total else 0.0, b.rate) for b in sorted_bins(bins)]


def report(trained, *, comments: Mapping[str, str], sizes: Mapping[str, DataFrame], iv: DataFrame, psi: DataFrame, fields: DataFrame, most: int = 20) -> dict[str, object]:
    """A model's report: screening table, rows of each data set by label, effect tables with F1, and the `most` greatest importances with their comments."""
    label, positive, negative = trained.label
    y = F.col(label).cast("string")
    counted = {n: df.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == positive).alias("n_pos"), F.count_if(y == negative).alias("n_neg")).first().asDict() for n, df in sizes.items()}
    f1 = lambda r: 2 * r.cum_precision * r.cum_recall / (r.cum_precision + r.cum_recall) if r.cum_precision and r.cum_recall else None
    effects = {n: [r.asDict() | {"f1": f1(r)} for r in t] for n, t in trained.tables.items()}
    return {"screening": screening(iv, psi, fields), "sizes": counted, "effects": effects, "importances": trained.importances(comments, most)}


def screening(iv: DataFrame, psi: DataFrame, fields: DataFrame) -> DataFrame:
    """(col, iv, psi, dictionary): every column that has an IV or a stability, with its dictionary entry (few rows each)."""
    return iv.join(psi, "col", "full_outer").join(fields, "col", "left")
