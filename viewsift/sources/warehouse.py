"""Reading the warehouse tables with their declared schemas (no inference pass).

Tables are Parquet folders partitioned by ``processing_date``; filters on that
column prune partitions, other filters and projections reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewsift import schemas
from viewsift.operators import manifest


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])


def raw_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the visible loads (``operators.manifest``): their folders are read by name, without a join."""
    return manifest.read_table(spark, path, version)


def curated_table(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.FILTERED_PAGEVIEWS)


def sentiment_table(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.SENTIMENT_RESULTS)
