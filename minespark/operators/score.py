"""Scores in use: bands, reasons, ranks and levels, and the combination of several models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minespark.operators.ranking import global_rank, level_of_rank
from minespark.runtime import small


def score_band(score: Column, thresholds: Sequence[float]) -> Column:
    """Band by falling thresholds (the last one aside), left-closed; 0 is the best. Null for a null score."""
    out = None
    for i, t in enumerate(thresholds[:-1]):
        out = F.when(score >= t, i) if out is None else out.when(score >= t, i)
    return F.when(score.isNotNull(), out.otherwise(len(thresholds) - 1) if out is not None else F.lit(0))


def with_band_quality(scores: DataFrame, thresholds: Sequence[float], table: DataFrame, *, score: str = "score") -> DataFrame:
    """Scores with score_cut and the training precision and lift of their band (one row per band is broadcast)."""
    banded = scores.withColumn("band", score_band(F.col(score), thresholds))
    return banded.join(F.broadcast(table.select("band", "precision", "lift")), "band", "left").withColumnRenamed("band", "score_cut")


def top_reasons(df: DataFrame, woe: Mapping[str, Mapping[str, float]], *, n: int, threshold: float = 0.0, comments: Mapping[str, str] | None = None, rare: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """df with, for each rank up to n: colname_top, colcomment_top, colvalue_top, colwoe_top (1-based suffix).

    A row's reasons are its columns of greatest WOE; ties go to the first column. Values in `rare` count as -999. Reasons not
    above the threshold are null. Works row by row on an array of structs, without a shuffle; columns of many values are joined to
    their broadcast tables first.
    """
    from minespark.operators.prep import IN_PLAN, looked_up

    many = [c for c, m in woe.items() if len(m) > IN_PLAN]
    df, found = looked_up(df, {c: (F.col(f"`{c}`"), woe[c]) for c in many})
    entries = []
    for i, (c, m) in enumerate(woe.items()):
        v = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
        if c in found:
            known = found[c]
        else:
            known = F.try_element_at(F.create_map(*(x for k, w in m.items() for x in (F.lit(k), F.lit(float(w))))), v) if m else F.lit(None).cast("double")
        w = F.when(v.isin(list((rare or {}).get(c, ()))), -999.0).otherwise(F.coalesce(known, F.lit(-999.0)))
        entries.append(F.struct(w.alias("w"), F.lit(-i).alias("o"), F.lit(c).alias("name"), F.lit((comments or {}).get(c, "")).alias("comment"), v.alias("value")))
    best = F.slice(F.sort_array(F.array(*entries), asc=False), 1, n)
    out = df.withColumn("_r", best)
    cols = {}
    for k in range(1, n + 1):
        r = F.try_element_at("_r", F.lit(k))
        r = F.when(r["w"] > threshold, r)
        cols |= {f"colname_top{k}": r["name"], f"colcomment_top{k}": r["comment"], f"colvalue_top{k}": r["value"], f"colwoe_top{k}": r["w"]}
    return out.withColumns(cols).drop("_r", *(f"_w_{i}" for i in range(len(many))))


def rare_values(df: DataFrame, woe: Mapping[str, Mapping[str, float]], *, threshold: float, at_most: float) -> dict[str, list[str]]:
    """Values (null as "") above the threshold that at most `at_most` rows hold (a share of the rows below 1); all columns in one pass."""
    from minespark.operators.prep import value_counts

    limit = at_most if at_most >= 1 else at_most * df.count()
    high = {c: {v for v, w in m.items() if w > threshold} for c, m in woe.items()}
    rows = value_counts(df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in woe)), list(woe)).where(F.col("n") <= limit)
    want = df.sparkSession.createDataFrame([(c, v) for c, vs in high.items() for v in vs] or [("", "")], "col string, v string")
    found = rows.join(small(want), ["col", "v"]).groupBy("col").agg(F.collect_list("v").alias("v")).collect()
    return {r.col: sorted(r.v) for r in found}


def ranked(scores: DataFrame, *, score: str = "score", ties: Sequence[tuple[str, bool]] = (), levels: int = 100) -> DataFrame:
    """Scores with score_rank (1 is best; ties by (column, ascending)) and score_level (`levels` is best)."""
    order = [F.desc(score), *(F.asc(c) if up else F.desc(c) for c, up in ties)]
    out = global_rank(scores, order, "score_rank")
    n = out.agg(F.max("score_rank").alias("_n"))
    return out.join(F.broadcast(n)).withColumn("score_level", level_of_rank(F.col("score_rank"), F.col("_n"), levels)).drop("_n")


def combined(scores: Sequence[DataFrame], weights: Mapping[str, float | None], *, level: str = "model_level", front: Sequence[str] = (), allowed: DataFrame | None = None, entity: str | None = None) -> DataFrame:
    """Several models' scores as one table with a common level from 0 to 100 (two digits).

    Each weight column is scaled to 0..1 over all rows (a constant one to 0), the level is their weighted sum, scaled again. A null weight is 1.
    Columns that a table lacks are null; nulls count as the least. `allowed` keeps only its entities.
    """
    from minespark.operators.panel import union_all

    rows = union_all(scores)
    cols = list(weights)
    ends = rows.agg(*(f(c).alias(f"_{n}{i}") for i, c in enumerate(cols) for n, f in (("lo", F.min), ("hi", F.max))))
    scaled = [F.coalesce(F.try_divide((F.col(c) - F.col(f"_lo{i}")).cast("double"), (F.col(f"_hi{i}") - F.col(f"_lo{i}")).cast("double")), F.lit(0.0)) * F.lit(1.0 if weights[c] is None else float(weights[c])) for i, c in enumerate(cols)]
    total = scaled[0]
    for s in scaled[1:]:
        total = total + s
    summed = rows.join(F.broadcast(ends)).select(*rows.columns, total.alias("_s"))
    span = summed.agg(F.min("_s").alias("_a"), F.max("_s").alias("_b"))
    out = summed.join(F.broadcast(span)).withColumn(level, F.round(F.coalesce(F.try_divide(F.col("_s") - F.col("_a"), F.col("_b") - F.col("_a")), F.lit(0.0)) * 100, 2)).drop("_s", "_a", "_b")
    if allowed is not None:
        out = out.join(small(allowed.select(entity)), entity, "left_semi")
    return out.select(*front, *(c for c in out.columns if c not in front))


def exported(df: DataFrame, *, suffix: str = "_teamzk", renames: Mapping[str, str] | None = None) -> DataFrame:
    """Columns without the suffix and renamed, for delivery; a name already taken keeps its suffix."""
    names = {c: c.removesuffix(suffix) for c in df.columns if c.endswith(suffix) and c.removesuffix(suffix) not in df.columns}
    return df.withColumnsRenamed(names | dict(renames or {}))


