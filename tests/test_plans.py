"""Plan tests: native rules (no Python UDF), pushdown and pruning, group limit, window placement."""

import contextlib
import datetime as dt
import io
import tempfile

import pytest

from viewsift.operators import prefilter
from viewsift.plans import analytics as A
from viewsift.sources import testbed as tb

D = dt.date(2024, 1, 30)


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def tables(spark):
    root = tempfile.mkdtemp(prefix="viewsift-plan-")
    tb.raw_pageviews(spark, "/root/testdata/sf0.001", with_event_id=False).write.partitionBy(
        "processing_date").parquet(root + "/raw")
    tb.filtered_pageviews(spark, "/root/testdata/sf0.001").write.partitionBy("processing_date").parquet(
        root + "/filtered")
    return spark.read.parquet(root + "/raw"), spark.read.parquet(root + "/filtered")


def test_prefilter_is_native_and_pushed_down(tables):
    raw, _ = tables
    p = plan(prefilter.prefilter(raw, D))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "PartitionFilters: [isnotnull(processing_date" in p and "2024-01-30" in p
    assert "GreaterThanOrEqual(count_views,1000)" in p
    assert "Not(StringStartsWith(page_title,Wikipedia:))" in p  # LIKE 'x%' without '_' reaches Parquet
    assert "ReadSchema: struct<domain:string,page_title:string,count_views:int>" in p


def test_verdict_is_native(spark, tables):
    raw, _ = tables
    from viewsift.functions import rules
    p = plan(raw.select(rules.verdict_expr().alias("v")))
    assert "Python" not in p and "RLike" in p or "rlike" in p.lower()


def test_top_k_uses_window_group_limit(tables):
    _, f = tables
    assert "WindowGroupLimit" in plan(A.top_pages(f, D, 7, 15))


def test_rank_window_runs_after_aggregation(tables):
    _, f = tables
    p = plan(A.company_rankings(f, D))
    # The unpartitioned window sits above the final hash aggregate (at most one row per company).
    tree = p.split("\n\n")[0]
    assert tree.index("Window") < tree.index("HashAggregate")


def test_winner_has_no_join(tables):
    _, f = tables
    p = plan(A.biggest_company(f, D))
    assert "Join" not in p and "CartesianProduct" not in p


def test_scoring_python_hop_only_in_scorer(spark):
    from viewsift.operators import scoring as S
    b = tb.batched_candidates(spark, "/root/testdata/sf0.001")
    assert "Python" not in plan(S.build_prompts(b))
    assert "Python" not in plan(S.score_batches(S.build_prompts(b)))
    assert "MapInPandas" in plan(S.score_batches(S.build_prompts(b), S.RuleScorer()))


def test_dq_latest_reads_the_newest_dates_only(spark, tables):
    import os
    from viewsift.plans import analytics as A
    from viewsift.sources import warehouse
    raw, _ = tables
    root = os.path.dirname(raw.inputFiles()[0].replace("file:", "").rsplit("/processing_date=", 1)[0])
    stored = spark.read.parquet(root + "/raw") if os.path.isdir(root + "/raw") else raw
    p = plan(A.dq_latest(stored, warehouse.curated_table(spark, root + "/filtered"), 3))
    assert p.count("PartitionFilters: [isnotnull(processing_date") >= 2 and "scalar-subquery" in p.lower() or "Subquery" in p


def test_files_keep_their_order_over_dates_and_hours(spark):
    """Rows read from a table with several dates and hours: every written file is sorted by file, then views."""
    import glob
    import tempfile

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from viewsift.operators import curate
    root = tempfile.mkdtemp(prefix="viewsift-order-")
    tb.raw_pageviews(spark, "/root/testdata/sf0.01", with_event_id=False).withColumn(
        "loaded_at", F.col("loaded_at").cast("timestamp_ntz")).write.parquet(root + "/src")
    curate.raw_load(spark, spark.read.parquet(root + "/src"), root + "/raw", "one")
    files = glob.glob(root + "/raw/load_id=one/processing_date=*/part-*.parquet")
    assert len(files) >= 30
    for f in files:
        t = pq.ParquetFile(f).read(columns=["source_file", "count_views"])
        rows = [(a, -b) for a, b in zip(t["source_file"].to_pylist(), t["count_views"].to_pylist())]
        assert rows == sorted(rows)


def test_warehouse_reader_prunes_and_pushes(spark, tables):
    import os
    from viewsift.sources import warehouse
    from viewsift.plans import analytics as A
    raw, _ = tables
    root = os.path.dirname(raw.inputFiles()[0].replace("file:", "").rsplit("/processing_date=", 1)[0])
    cur = warehouse.curated_table(spark, root + "/filtered")
    p = plan(A.company_rankings(cur, D))
    assert "PartitionFilters: [isnotnull(processing_date" in p
    assert "ReadSchema: struct<count_views:int,company:string>" in p


def test_seeded_sample_is_group_limited(spark):
    from viewsift.sources import pages
    df = spark.range(1000).selectExpr("CAST(id % 3 AS INT) AS g", "CAST(id AS STRING) AS full_url")
    s = pages.seeded_sample(df, "seed", 5, ["g"])
    assert "WindowGroupLimit" in plan(s)
    rows = sorted(map(tuple, s.collect()))
    again = sorted(map(tuple, pages.seeded_sample(df.repartition(7), "seed", 5, ["g"]).collect()))
    assert len(rows) == 15 and rows == again  # repeatable whatever the partitioning


def test_raw_layout_lets_stage_a_skip_row_groups(spark):
    """Sorted raw files: a high threshold reads few row groups (Parquet statistics)."""
    import datetime as dt
    import tempfile

    from pyspark.sql import functions as F

    from viewsift.operators import curate
    path = tempfile.mkdtemp(prefix="viewsift-layout-") + "/raw"
    rows = spark.range(200000).select(
        F.lit("en").alias("domain"), F.concat(F.lit("T"), (F.col("id") % 5000).cast("string")).alias("page_title"),
        (F.col("id") * 7919 % 100000).cast("int").alias("count_views"), F.lit("pageviews-20240130-000000.gz")
        .alias("source_file"), F.lit(dt.datetime(2024, 1, 30)).cast("timestamp_ntz").alias("loaded_at"),
        F.lit(dt.date(2024, 1, 30)).alias("processing_date"))
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    hconf.setInt("parquet.block.size", 256 * 1024)  # small row groups for the test
    try:
        curate.write_raw(rows.repartition(1), path)
    finally:
        hconf.unset("parquet.block.size")
    import pyarrow.parquet as pq
    import glob
    f = glob.glob(path + "/processing_date=*/*.parquet")[0]
    md = pq.ParquetFile(f).metadata
    col = [i for i in range(md.num_columns) if md.schema.column(i).name == "count_views"][0]
    maxes = [md.row_group(g).column(col).statistics.max for g in range(md.num_row_groups)]
    assert len(maxes) > 1 and maxes == sorted(maxes, reverse=True)  # stats prune the low-views tail
    n_skippable = sum(1 for m in maxes if m < 90000)
    assert n_skippable >= len(maxes) // 2


def test_sorted_row_number_windows_only_the_spans_table(spark):
    import re

    from pyspark.sql import functions as F

    from viewsift.operators.ranking import sorted_row_number
    df = spark.range(2000).selectExpr("CAST(id % 3 AS STRING) AS g", "id AS v")
    p = plan(sorted_row_number(df, ["g"], [F.col("v").desc()], "rn"))
    # The rows come from the materialized sorted table; the one window runs over per-(partition, group)
    # counts, ordered by partition, never over the rows of a group.
    windows = re.findall(r"windowspecdefinition\(([^)]*)\)", p)
    assert windows and all("_part" in w for w in windows)
    assert "Scan parquet" in p and "RowFrame" in p
