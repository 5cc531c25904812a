"""Table definitions (K5): explicit schemas for the warehouse tables and replies.

The ``BIGSERIAL id`` columns of the original tables are left out: no query reads them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# One parsed dump line, before lineage columns.
DUMP_LINE = T.StructType([
    T.StructField("domain", T.StringType(), False),
    T.StructField("page_title", T.StringType(), False),
    T.StructField("count_views", T.IntegerType(), False),
])

RAW_PAGEVIEWS = T.StructType([
    T.StructField("domain", T.StringType(), False),
    T.StructField("page_title", T.StringType(), False),
    T.StructField("count_views", T.IntegerType(), False),
    T.StructField("source_file", T.StringType(), False),
    T.StructField("loaded_at", T.TimestampNTZType(), False),
    T.StructField("processing_date", T.DateType(), False),
])

FILTERED_PAGEVIEWS = T.StructType([
    T.StructField("domain", T.StringType(), False),
    T.StructField("page_title", T.StringType(), False),
    T.StructField("count_views", T.IntegerType(), False),
    T.StructField("company", T.StringType(), False),
    T.StructField("filtered_at", T.TimestampNTZType(), False),
    T.StructField("processing_date", T.DateType(), False),
    T.StructField("filter_method", T.StringType(), False),
])

SENTIMENT_RESULTS = T.StructType([
    T.StructField("page_title", T.StringType(), False),
    T.StructField("company", T.StringType(), False),
    T.StructField("sentiment_label", T.StringType(), False),
    T.StructField("sentiment_score", T.DecimalType(4, 3), True),
    T.StructField("count_views", T.IntegerType(), False),
    T.StructField("processing_date", T.DateType(), False),
    T.StructField("analyzed_at", T.TimestampNTZType(), False),
])

# Unique keys (tables.sql UNIQUE constraints).
FILTERED_KEY = ["domain", "page_title", "processing_date", "filter_method"]
SENTIMENT_KEY = ["page_title", "processing_date"]

SENTIMENT_LABELS = ["positive", "neutral", "negative"]

# Declared column lengths, checked as data rules.
# VARCHAR lengths of the table definitions.
MAX_LENGTHS = {
    "raw_pageviews": {"domain": 255, "source_file": 500},
    "filtered_pageviews": {"domain": 255, "company": 50, "filter_method": 100},
    "sentiment_results": {"company": 50, "sentiment_label": 20},
}

# Scorer reply: {"json_output": [{domain, page_title, count_views}], "csv_output": str}
REPLY_RECORD = T.StructType([
    T.StructField("domain", T.StringType(), True),
    T.StructField("page_title", T.StringType(), True),
    T.StructField("count_views", T.LongType(), True),
])
REPLY = T.StructType([
    T.StructField("json_output", T.ArrayType(REPLY_RECORD), True),
    T.StructField("csv_output", T.StringType(), True),
])
