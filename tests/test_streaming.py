"""Streaming ingest: each file once, late files land in raw; the live totals honour the watermark."""

import tempfile

from pyspark.sql import functions as F

from viewsift.sources import dumps
from viewsift.streaming import ingest


def rows(spark, data):
    return spark.createDataFrame(data, "domain string, page_title string, count_views int, source_file string")


def test_ingest_each_file_once_and_late_files_kept(spark):
    root = tempfile.mkdtemp(prefix="viewsift-stream-")
    landing, table, ckpt = root + "/landing", root + "/raw", root + "/ckpt"
    dumps.write_dump_files(rows(spark, [("en", "iPhone", 2000, "pageviews-20240130-100000.gz")]), landing)
    ingest.ingest_dumps(spark, landing, table, ckpt)
    ingest.ingest_dumps(spark, landing, table, ckpt)  # nothing new
    assert ingest.read_raw_stream_table(spark, table).count() == 1
    dumps.write_dump_files(rows(spark, [("en", "Pixel_8", 3000, "pageviews-20240101-050000.gz")]), landing)
    ingest.ingest_dumps(spark, landing, table, ckpt)  # a late hour still lands
    t = ingest.read_raw_stream_table(spark, table)
    assert t.count() == 2
    assert sorted(str(r.processing_date) for r in t.collect()) == ["2024-01-01", "2024-01-30"]


def test_live_totals_and_watermark(spark):
    root = tempfile.mkdtemp(prefix="viewsift-live-")
    landing, log, ckpt = root + "/landing", root + "/log", root + "/ckpt"
    dumps.write_dump_files(rows(spark, [("en", "iPhone", 2000, "pageviews-20240130-100000.gz"),
                                        ("en", "Windows_11", 1500, "pageviews-20240130-110000.gz")]), landing)
    ingest.daily_company_totals(spark, landing, log, ckpt, watermark="1 day")
    # a much older file arrives after the watermark has moved on: the live view leaves it out
    dumps.write_dump_files(rows(spark, [("en", "iPhone", 5000, "pageviews-20240101-100000.gz")]), landing)
    ingest.daily_company_totals(spark, landing, log, ckpt, watermark="1 day")
    got = {(str(r.processing_date), r.company): (r.page_count, r.total_views)
           for r in ingest.latest_totals(spark, log).collect()}
    assert got == {("2024-01-30", "Apple"): (1, 2000), ("2024-01-30", "Microsoft"): (1, 1500)}


def test_a_second_checkpoint_loses_no_file(spark):
    root = tempfile.mkdtemp(prefix="viewsift-stream2-")
    table = root + "/raw"
    for hour in ("10", "11"):  # another landing folder and checkpoint each, one table; batch numbers start at 0 again
        name = f"pageviews-20240130-{hour}0000.gz"
        lines = [(name, f"en iPhone_{hour} 2000 0"), (name, f"en broken_{hour}")]
        dumps.write_dump_lines(spark.createDataFrame(lines, "source_file string, line string"), f"{root}/landing{hour}")
        ingest.ingest_dumps(spark, f"{root}/landing{hour}", table, f"{root}/ckpt{hour}")
    ingest.ingest_dumps(spark, f"{root}/landing10", table, f"{root}/ckpt-new")  # known files stay out
    got = sorted(r.page_title for r in ingest.read_raw_stream_table(spark, table).collect())
    assert got == ["iPhone_10", "iPhone_11"]
    assert sorted(r.line for r in ingest.read_quarantine(spark, table).collect()) == ["en broken_10", "en broken_11"]


def totals(spark, log):
    return {(r.processing_date.day, r.company): (r.page_count, r.total_views) for r in ingest.latest_totals(spark, log).collect()}


def test_a_second_checkpoint_brings_the_newest_totals(spark):
    """Batch numbers start again in a new checkpoint; the order of writing decides."""
    root = tempfile.mkdtemp(prefix="viewsift-live2-")
    landing, log = root + "/landing", root + "/log"
    for hour in range(6):
        dumps.write_dump_files(rows(spark, [("en", "iPhone", 1000, f"pageviews-20240130-{hour:02d}0000.gz")]), landing)
        if hour < 3:
            ingest.daily_company_totals(spark, landing, log, root + "/ckpt")
    assert totals(spark, log) == {(30, "Apple"): (3, 3000)}
    ingest.daily_company_totals(spark, landing, log, root + "/ckpt2")
    assert totals(spark, log) == {(30, "Apple"): (6, 6000)}


def test_repair_replaces_the_touched_cells_only(spark):
    root = tempfile.mkdtemp(prefix="viewsift-repair-")
    landing, log, raw = root + "/landing", root + "/log", root + "/raw"

    def step(data):
        dumps.write_dump_files(rows(spark, data), landing)
        ingest.ingest_dumps(spark, landing, raw, root + "/ckpt-raw")
        ingest.daily_company_totals(spark, landing, log, root + "/ckpt", watermark="1 day")
    step([("en", "iPhone", 2000, "pageviews-20240130-100000.gz"), ("en", "Windows_11", 1500, "pageviews-20240130-110000.gz")])
    assert ingest.repair_totals(spark, raw, log) == 0
    step([("en", "iPhone", 5000, "pageviews-20240101-100000.gz"), ("en", "Azure", 10, "pageviews-20240101-110000.gz")])  # too late
    assert totals(spark, log) == {(30, "Apple"): (1, 2000), (30, "Microsoft"): (1, 1500)}
    assert ingest.repair_totals(spark, raw, log) == 1 and ingest.repair_totals(spark, raw, log) == 0
    want = {(30, "Apple"): (1, 2000), (30, "Microsoft"): (1, 1500), (1, "Apple"): (1, 5000)}
    assert totals(spark, log) == want and ingest.late_rows(spark, landing, log).count() == 0
    step([("en", "iPad", 3000, "pageviews-20240130-120000.gz")])  # in time: the live update counts
    want[30, "Apple"] = (2, 5000)
    assert totals(spark, log) == want and ingest.repair_totals(spark, raw, log) == 0
    # a second stream over another folder knows one file of the day
    dumps.write_dump_files(rows(spark, [("en", "iPhone", 2000, "pageviews-20240130-100000.gz")]), root + "/other")
    ingest.daily_company_totals(spark, root + "/other", log, root + "/ckpt-other")
    assert totals(spark, log)[30, "Apple"] == (1, 2000)
    assert ingest.repair_totals(spark, raw, log) == 1 and totals(spark, log) == want


def test_a_replayed_batch_replaces_its_own_updates(spark):
    root = tempfile.mkdtemp(prefix="viewsift-replay-")
    update = spark.createDataFrame([("2024-01-30", "Apple", 1, 10)], "processing_date string, company string, page_count long, total_views long") \
        .selectExpr("cast(processing_date as date) processing_date", "company", "page_count", "total_views")
    for _ in range(2):
        ingest._write_updates(update, root + "/log", "s", 0)
    assert ingest._updates(spark, root + "/log").count() == 1 and totals(spark, root + "/log") == {(30, "Apple"): (1, 10)}
