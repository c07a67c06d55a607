"""Reproducible sampling: an order key from a hash, quotas per class, stratified down-sampling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_key(entity: Column, seed: int = 0) -> Column:
    """A random-looking order key that depends on the id and the seed only."""
    return F.md5(F.concat(entity.cast("string"), F.lit(f"_{seed}" if seed else "")))


def quota(df: DataFrame, limits: Mapping, *, key: Column, by: str | None = None) -> DataFrame:
    """The first rows by `key` up to each class's limit ({None: n} without classes); classes without a limit are left out.

    A top-k per class: each task keeps its own first rows only, no class is sorted as a whole.
    """
    keyed = df.withColumn("_key", key)
    out = None
    for value, n in limits.items():
        part = (keyed if by is None else keyed.where(F.col(by) == value)).orderBy("_key").limit(n)
        out = part if out is None else out.unionByName(part)
    return out.drop("_key")


def down_sample(df: DataFrame, *, label: str, positive: str, negative: str, positive_limit: int, ratio: float | str, key: Column, stratified: str | None = None) -> DataFrame:
    """Positives up to their limit, and ratio x as many negatives ('actual': all), by hash order; fewer than that are all taken.

    With `stratified`, negatives are taken from each of its values in proportion (rounded up).
    """
    y = F.col(label).cast("string")
    pos = quota(df.where(y == positive), {None: positive_limit}, key=key)
    neg = df.where(y == negative)
    if ratio == "actual":
        return pos.unionByName(neg)
    want = int(pos.count() * ratio)
    if stratified is None:
        return pos.unionByName(quota(neg, {None: want}, key=key))
    sizes = {r[0]: r[1] for r in neg.groupBy(stratified).count().collect()}  # one row per stratum
    total = sum(sizes.values())
    if want >= total:
        return pos.unionByName(neg)
    limits = {v: -(-want * n // total) for v, n in sizes.items()}
    rank = F.row_number().over(Window.partitionBy(stratified).orderBy("_key"))
    limit = F.coalesce(*(F.when(F.col(stratified).eqNullSafe(F.lit(v)), F.lit(n)) for v, n in limits.items()))
    picked = neg.withColumn("_key", key).withColumn("_r", rank).where(F.col("_r") <= limit).drop("_key", "_r")
    return pos.unionByName(picked)


def usable_ratios(ratios: Sequence, positives: int, negatives: int) -> list:
    """The ratios not above the real one; 'actual' where one is dropped, and at least that."""
    real = negatives / positives if positives else 0
    kept = [r for r in ratios if r == "actual" or r <= real]
    return kept if len(kept) == len(ratios) and kept else list(dict.fromkeys([*kept, "actual"]))
