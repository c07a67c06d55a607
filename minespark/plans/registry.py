"""All queries of the core with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from minespark.plans import problem_sql, problems, survey, survey_jobs  # noqa: F401  (the last adds to survey's queries)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    own = {f.__name__: f for f in (problems.p1_found, problems.p2_found, problems.p3_found, problems.p5_found, problems.p5_ks)}
    return own | survey.QUERIES


def oracle_sql() -> dict[str, str]:
    own = {"p1_found": problem_sql.P1, "p2_found": problem_sql.P2, "p3_found": problem_sql.P3, "p5_found": problem_sql.P5, "p5_ks": problem_sql.P5_KS}
    return own | survey.ORACLE
