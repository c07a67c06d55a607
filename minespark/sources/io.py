"""Reading and saving tables: selection, types, alignment, partitions, SQL over frames."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minespark.functions.periods import parse_partial_date
from minespark.functions.predicates import where

FILE_FORMATS = ("parquet", "orc", "csv", "json")
#: What happens when a target exists (fixed values).
MODES = {"fail": "error", "replace": "overwrite", "append": "append"}


def read_data(
    spark: SparkSession, source: str | DataFrame, *, fmt: str = "table", condition=None, need: Sequence[str] | None = None, leave: Sequence[str] | None = None,
    chars: Sequence[str] = (), numbers: Sequence[str] = (), dates: Sequence[str] = (), rows: int | None = None, lower: bool = True, schema: str | None = None, options: dict | None = None, bad_numbers: str = "null",
) -> DataFrame:
    """A table, file or query with chosen columns and types; lazy, so filters and columns reach the scan.

    `need` or `leave` (not both) choose columns; a column in two of chars, numbers and dates is an error. chars become
    text, numbers double (text that is no number null; with bad_numbers="error" an error that names column and text when it is read), dates are parsed,
    yyyymm as its first day. fmt: table, sql, jdbc or one of FILE_FORMATS. `rows` limits for previews.
    """
    if need is not None and leave is not None:
        raise ValueError("give need or leave, not both")
    if bad_numbers not in ("null", "error"):
        raise ValueError(f"bad_numbers {bad_numbers}")
    twice = set(chars) & set(numbers) | set(chars) & set(dates) | set(numbers) & set(dates)
    if twice:
        raise ValueError(f"two types for {sorted(twice)}")
    if isinstance(source, DataFrame):
        df = source
    elif fmt == "table":
        df = spark.table(source)
    elif fmt == "sql":
        df = spark.sql(source)
    elif fmt == "jdbc":
        df = spark.read.format("jdbc").options(**(options or {}), dbtable=source).load()
    elif fmt in FILE_FORMATS:
        reader = spark.read.options(**({"header": "true"} if fmt == "csv" else {}) | (options or {}))
        df = (reader.schema(schema) if schema else reader).format(fmt).load(source)
    else:
        raise ValueError(f"no format {fmt}")
    if lower:
        df = df.toDF(*(c.lower() for c in df.columns))
    df = where(df, condition)
    wanted = list(need) if need is not None else [c for c in df.columns if c not in set(leave or ())]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"no columns {missing}")
    out = df.select(*(_typed(c, chars, numbers, dates, bad_numbers) for c in wanted))
    return out if rows is None else out.limit(rows)


def _typed(c, chars, numbers, dates, bad_numbers):
    if c in chars:
        return F.col(c).cast("string").alias(c)
    if c in numbers:
        x = F.col(c).try_cast("double")
        if bad_numbers == "error":
            said = F.concat(F.lit(f"{c} has a value that is no number: "), F.col(c).cast("string"))
            x = F.when(F.col(c).isNotNull() & x.isNull(), F.raise_error(said).cast("double")).otherwise(x)
        return x.alias(c)
    return parse_partial_date(F.col(c)).alias(c) if c in dates else F.col(c)


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame | None:
    """SQL over tables and over the given frames ({name} in the text); several statements by ';', the last one's rows come back."""
    out = None
    for statement in split_statements(text):
        out = spark.sql(statement, **{k: v for k, v in frames.items() if "{" + k + "}" in statement})
    return out


def split_statements(text: str) -> list[str]:
    """Statements between semicolons outside quotes."""
    return [x.strip() for x in re.findall(r"((?:'(?:[^'\\]|''|\\.)*'|[^;'])+)", text) if x.strip()]


def sql_on_frames(spark: SparkSession, query: str, frames: dict[str, DataFrame]) -> DataFrame:
    """A query whose table names are frames; names resolve to them first, the session's views stay as they are."""
    for name in sorted(frames, key=len, reverse=True):
        query = re.sub(rf"(?i)\b(from|join)\s+{re.escape(name)}\b", rf"\1 {{{name}}}", query)
    return spark.sql(query, **{k: v for k, v in frames.items() if "{" + k + "}" in query})


def aligned(df: DataFrame, columns: Sequence[str], types: dict[str, str]) -> DataFrame:
    """df with exactly these columns: missing ones null, an extra one is an error."""
    extra = [c for c in df.columns if c not in columns]
    if extra:
        raise ValueError(f"the target has no columns {extra}")
    return df.select(*(F.col(c).cast(types[c]).alias(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in columns))


def save_data(df: DataFrame, target: str, *, fmt: str = "table", if_exists: str | None = None, partition_by: Sequence[str] = (), options: dict | None = None) -> None:
    """Save as a table, file or JDBC table (`options` has url and the rest). Default if_exists: tables fail, files replace; an appended table's columns are aligned."""
    mode = if_exists or ("fail" if fmt in ("table", "jdbc") else "replace")
    if mode not in MODES:
        raise ValueError(f"if_exists is one of {sorted(MODES)}")
    spark = df.sparkSession
    if fmt == "table":
        if mode == "append" and spark.catalog.tableExists(target):
            there = spark.table(target)
            aligned(df, there.columns, dict(there.dtypes)).write.insertInto(target)
            return
        df.write.mode(MODES[mode]).partitionBy(*partition_by).saveAsTable(target)
        return
    if fmt == "jdbc":
        df.write.format("jdbc").mode(MODES[mode]).options(**(options or {}), dbtable=target).save()
        return
    out = df.write.mode(MODES[mode]).partitionBy(*partition_by).options(**({"header": "true"} if fmt == "csv" else {}) | (options or {}))
    out.format(fmt).save(target)


def overwrite_partitions(df: DataFrame, target: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace only the partitions that df has, in a table or in a folder."""
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        if "/" in target:
            df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(target)
        elif spark.catalog.tableExists(target):
            there = spark.table(target)
            aligned(df, there.columns, dict(there.dtypes)).write.mode("overwrite").insertInto(target)
        else:
            df.write.partitionBy(*partition_by).saveAsTable(target)
    finally:
        spark.conf.set(setting, before)


def plan_text(df: DataFrame) -> str:
    """What would run, without running it."""
    return df._jdf.queryExecution().toString()


def sql_literal(value) -> str:
    """A Python value as an SQL literal: text quoted with its quotes doubled, None as null, numbers and truth values as they are."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value) if isinstance(value, int | float) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


#: Words that begin a line of printed SQL (fixed values).
CLAUSES = ("select", "from", "where", "group by", "having", "order by", "limit", "left join", "full join", "inner join", "join", "union all", "insert", "values")


def sql_text(statement: str) -> str:
    """A statement with its clauses on lines of their own, indented by parentheses; quoted text stays as it is."""
    parts = re.split(r"('(?:[^'\\]|''|\\.)*')", " ".join(statement.split()) if "'" not in statement else statement.strip())
    words = "|".join(c.replace(" ", r"\s+") for c in sorted(CLAUSES, key=len, reverse=True))
    out, depth = [], 0
    for i, part in enumerate(parts):
        if i % 2:
            out.append(part)
            continue
        for token in re.split(rf"(?i)(\b(?:{words})\b|[()])", re.sub(r"\s+", " ", part)):
            low = " ".join(token.lower().split())
            depth += (token == "(") - (token == ")")
            out.append(f"\n{'    ' * depth}{token}" if low in CLAUSES and out else token)
    return re.sub(r" +\n", "\n", "".join(out)).strip()
