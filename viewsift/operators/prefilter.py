"""Prefilter (F1–F4) and company classification.

The three stages are one filter: Catalyst collapses them, pushes the date and
view predicates into the Parquet scan (partition pruning on ``processing_date``,
row-group skipping on ``count_views``) and keeps the LIKE/ILIKE rules in codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewsift.functions import rules

# Columns stage A hands on (the original selects exactly these).
STAGE_COLUMNS = ("domain", "page_title", "count_views")


class PrefilterError(RuntimeError):
    """Raised when a prefilter that must produce rows produced none."""


def _project(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    return df if columns is None else df.select(*columns)


def stage_a(raw: DataFrame, as_of, min_views: int = rules.DEFAULT_MIN_VIEWS,
            columns: Sequence[str] | None = STAGE_COLUMNS) -> DataFrame:
    """``processing_date = as_of AND count_views >= min_views``; ``as_of=None`` = all dates."""
    return _project(raw.where(rules.stage_a_condition(as_of, min_views)), columns)


def stage_b(df: DataFrame, title_col: str = "page_title") -> DataFrame:
    """drop titles matching any noise pattern."""
    return df.where(rules.stage_b_condition(title_col))


def stage_c(df: DataFrame, title_col: str = "page_title") -> DataFrame:
    """keep titles containing a tech keyword."""
    return df.where(rules.stage_c_condition(title_col))


def with_company(df: DataFrame, title_col: str = "page_title") -> DataFrame:
    """Add ``company`` with a native CASE expression (no Python UDF)."""
    return df.withColumn("company", rules.company_expr(title_col))


def prefilter(raw: DataFrame, as_of, min_views: int = rules.DEFAULT_MIN_VIEWS,
              columns: Sequence[str] | None = STAGE_COLUMNS, require_rows: bool = False,
              ordered: bool = False) -> DataFrame:
    """A → B → C, then company. ``ordered`` sorts by views (a presentation step).

    ``require_rows`` reproduces the zero-row guard (C5); it costs one small job.
    """
    out = with_company(stage_c(stage_b(stage_a(raw, as_of, min_views, columns))))
    if require_rows and out.isEmpty():
        raise PrefilterError("prefilter returned zero rows")
    if ordered:
        out = out.orderBy(F.col("count_views").desc())
    return out


def company_distribution(df: DataFrame) -> DataFrame:
    """Rows per company, most first (partial aggregation before the shuffle)."""
    return df.groupBy("company").agg(F.count(F.lit(1)).alias("page_count"))
