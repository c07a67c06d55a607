"""The queries p4 over scores and p6 to p8 over documents, with the SQL of p4."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minespark.functions.normal import entity_key, month_of, trimmed
from minespark.llm.cutoff import keep_cutoffs
from minespark.llm.encode import encode_corpus
from minespark.llm.pack import pack, token_counts
from minespark.llm.spans import shared_spans
from minespark.plans import problem_sql as S

#: Tokens in a container.
CAPACITY = 2048
#: Code points of a shared span.
SPAN = 100


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Cutoff and kept records of each target model and month: (model_name, acct_month, cutoff_micro, n_kept)."""
    rows = spark.read.parquet(f"{d}/table_score_flag_month.parquet").select(
        trimmed(F.col("model_name")).alias("model_name"),
        month_of(F.col("acct_month")).alias("acct_month"),
        entity_key(F.col("user_no")).alias("k"),
        F.struct("load_time", (-F.col("score_id")).alias("n"), "score").alias("r"),
    )
    counted = rows.where("r.score between 0 and 1")  # NaN is greater than all numbers here
    latest = counted.groupBy("model_name", "acct_month", "k").agg(F.max("r").alias("r"))
    records = latest.select("model_name", "acct_month", F.col("r.score").alias("score"))
    targets = spark.read.parquet(f"{d}/score_keep_target.parquet").select(trimmed(F.col("model_name")).alias("model_name"), "keep_permille")
    found = keep_cutoffs(records, targets, group=["model_name", "acct_month"], score="score", permille="keep_permille", on=["model_name"])
    return found.select("model_name", "acct_month", F.round(F.col("cutoff") * 1_000_000).cast("long").alias("cutoff_micro"), "n_kept")


P4 = f"""
with r as (
    select {S.trimmed('model_name')} as model_name, {S.six('acct_month')} as acct_month, {S.key('user_no')} as k, score, load_time, score_id
    from table_score_flag_month where score between 0 and 1 and not isnan(score)
),
x as (
    select model_name, acct_month, score from (
        select *, row_number() over (partition by model_name, acct_month, k order by load_time desc nulls last, score_id) as rn from r
        where model_name is not null and acct_month is not null
    ) where rn = 1
),
n as (select model_name, acct_month, score, count(*) as c from x group by all),
y as (
    select *, sum(c) over (partition by model_name, acct_month order by score desc) as n_kept, sum(c) over (partition by model_name, acct_month) as total from n
),
z as (
    select model_name, acct_month, max(score) as score, min(n_kept) as n_kept
    from y join (select {S.trimmed('model_name')} as model_name, keep_permille from score_keep_target) using (model_name)
    where n_kept * 1000 >= total * keep_permille group by all
)
select model_name, acct_month, cast(round(score * 1000000) as bigint) as cutoff_micro, cast(n_kept as bigint) as n_kept from z
"""


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of each document: (doc_id, ids)."""
    return encode_corpus(_documents(spark, d), doc_id="doc_id", text="text")


def p7_pack(spark: SparkSession, d: str) -> DataFrame:
    """Container of each document's text: (container_id, doc_id, piece_no, piece_start, n_tokens)."""
    sizes = token_counts(_documents(spark, d), doc_id="doc_id", text="text")
    return pack(sizes, item_id="doc_id", size="size", capacity=CAPACITY)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Code points of each text that stand in another record too, in spans of 100 or more: (doc_id, n_shared)."""
    return shared_spans(_documents(spark, d), doc_id="doc_id", text="text", min_length=SPAN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p4_found": p4_found, "p6_ids": p6_ids, "p7_pack": p7_pack, "p8_found": p8_found}


def oracle_sql() -> dict[str, str]:
    return {"p4_found": P4}
