"""Checks as data jobs (C1–C6): each is one aggregation pass, never a driver loop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewsift import schemas

REQUIRED_OLD = ["domain_code", "page_title", "count_views"]
REQUIRED_NEW = ["domain", "page_title", "count_views"]


def extract_checks(df: DataFrame) -> DataFrame:
    """Required columns (old or new names), non-empty, integer ``count_views`` — one row.

    Column presence and type come from the schema; the counts come from one pass.
    """
    cols = set(df.columns)
    has_cols = all(c in cols for c in REQUIRED_NEW) or all(c in cols for c in REQUIRED_OLD)
    integer = "count_views" in cols and isinstance(df.schema["count_views"].dataType,
                                                   (T.IntegerType, T.LongType, T.ShortType, T.ByteType))
    dom = "domain" if "domain" in cols else "domain_code"
    agg = df.agg(F.count(F.lit(1)).alias("row_count"),
                 F.count_if(F.col(dom).isNull()).alias("null_domain"),
                 F.count_if(F.col("page_title").isNull()).alias("null_page_title"),
                 F.count_if(F.col("count_views").isNull()).alias("null_count_views"))
    return agg.select("row_count", F.lit(has_cols).alias("has_required_columns"),
                      F.lit(integer).alias("count_views_integer"),
                      "null_domain", "null_page_title", "null_count_views",
                      (F.lit(has_cols and integer) & (F.col("row_count") > 0)).alias("passed"))


def verify_load(raw: DataFrame, source_file: str | None = None) -> DataFrame:
    """Per source file: record_count, load_time, domain_count, total_views.

    With ``source_file`` it is the single-file check; without, all files at once.
    """
    df = raw.where(F.col("source_file") == source_file) if source_file else raw
    return df.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("loaded_at").alias("load_time"),
        F.count_distinct("domain").alias("domain_count"),
        F.sum("count_views").cast("long").alias("total_views"))


def _null_rules(schema: T.StructType) -> list[tuple[str, F.Column]]:
    return [(f"null_{f.name}", F.col(f.name).isNull()) for f in schema.fields if not f.nullable]


def _length_rules(table: str) -> list[tuple[str, F.Column]]:
    return [(f"{c}_too_long", F.length(F.col(c)) > n) for c, n in schemas.MAX_LENGTHS[table].items()]


def constraint_rules(table: str) -> list[tuple[str, F.Column]]:
    """The declared constraints of a table as (rule, violated-predicate) pairs."""
    if table == "raw_pageviews":
        return (_null_rules(schemas.RAW_PAGEVIEWS) + [("negative_count_views", F.col("count_views") < 0)]
                + _length_rules(table))
    if table == "filtered_pageviews":
        return (_null_rules(schemas.FILTERED_PAGEVIEWS) + [("negative_count_views", F.col("count_views") < 0)]
                + _length_rules(table))
    if table == "sentiment_results":
        return (_null_rules(schemas.SENTIMENT_RESULTS)
                + [("invalid_sentiment_label", ~F.col("sentiment_label").isin(schemas.SENTIMENT_LABELS)),
                   ("score_out_of_range", F.abs(F.col("sentiment_score")) > 1)]
                + _length_rules(table))
    raise ValueError(f"unknown table {table!r}")


def constraint_violations(df: DataFrame, table: str) -> DataFrame:
    """One pass of ``count_if`` per rule, unpivoted to (table_name, rule, violations)."""
    rules = constraint_rules(table)
    wide = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules])
    return wide.unpivot([], [name for name, _ in rules], "rule", "violations") \
        .select(F.lit(table).alias("table_name"), "rule", "violations")


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """C4: keys held by more than one row, with their row count (partial aggregation first)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def zero_row_status(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Per ``key`` of the rows before a step: rows before and after it, and ``zero_rows`` where none is left.

    The guard (``prefilter(require_rows=True)``) stops a run; this is the run's status row per date, file or batch.
    """
    n_in = before.groupBy(key).agg(F.count(F.lit(1)).alias("rows_in"))
    n_out = after.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_out"))
    joined = n_in.join(n_out, F.col(key).eqNullSafe(F.col("_key")), "left")
    out = F.coalesce("_out", F.lit(0))
    return joined.select(key, "rows_in", out.alias("rows_out"), F.when(out > 0, "ok").otherwise("zero_rows").alias("status"))
