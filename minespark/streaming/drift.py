"""An addition: drift of a value's distribution over event-time windows of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minespark.operators.stats import band


def window_counts(stream: DataFrame, *, time: str, value: str, edges: Sequence[float], window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, v, n): counts of value bands per window; state is dropped once events are later than `late`. Works on batches too."""
    rows = stream.withColumn("_t", F.col(time).cast("timestamp"))
    if stream.isStreaming:
        rows = rows.withWatermark("_t", late)
    counts = rows.groupBy(F.window("_t", window).alias("w"), band(F.col(value), edges).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("start"), "v", "n").where("v is not null")


def window_psi(counts: DataFrame, baseline: Sequence[tuple[int, int]]) -> DataFrame:
    """(start, psi) of finished windows against a baseline of (band, count), a small local table."""
    total = sum(max(1, n) for _, n in baseline)
    per = counts.groupBy("start").agg(F.map_from_entries(F.collect_list(F.struct("v", "n"))).alias("m"))  # one entry per band
    n = F.array(*(F.greatest(F.coalesce(F.try_element_at("m", F.lit(v)), F.lit(0)), F.lit(1)) for v, _ in baseline))
    sized = per.select("start", n.alias("n")).withColumn("all", F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))
    out = F.lit(0.0)
    for i, (_, b) in enumerate(baseline):
        r, r0 = F.col("n")[i] / F.col("all"), max(1, b) / total
        out = out + (r - r0) * F.ln(r / r0)
    return sized.select("start", out.alias("psi"))
