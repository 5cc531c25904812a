"""Registered jobs that write and read back: loads, file round trips, dumps, streams.

Each job writes under a fresh folder of the shared scratch root (``fresh_dir``),
runs the operator, and returns the table it produced, so the result can be
compared with SQL over the source tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewsift import schemas
from viewsift.functions import rules
from viewsift.operators import curate, fuzzy, manifest, prefilter, quality, scoring
from viewsift.plans import analytics, daily_job
from viewsift.session import delete_path, filesystem, fresh_dir
from viewsift.sources import dumps, files, testbed as tb, warehouse
from viewsift.streaming import ingest

RAW = [f.name for f in schemas.RAW_PAGEVIEWS.fields]
FILTERED = [f.name for f in schemas.FILTERED_PAGEVIEWS.fields]
BAD_LINES = ["en Bad Title x 9 0", "en Foo abc 0", "en OnlyTwo", "en Neg -5 0"]
ODD_NAME = "projectviews.gz"
CORRUPT_NAME = "pageviews-corrupt.gz"


class LoadCheckError(RuntimeError):
    """A repeated load or repair changed what it should have left alone."""


def raw_load(spark: SparkSession, sf: str) -> DataFrame:
    """K1: load the raw rows twice; the second load must add nothing (idempotent per file)."""
    path = fresh_dir(spark, "raw_pageviews")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    curate.raw_load(spark, rows, path)
    again = curate.raw_load(spark, rows, path)
    if again:
        raise LoadCheckError(f"second raw load added {again} rows")
    return warehouse.raw_table(spark, path)


def raw_load_retry(spark: SparkSession, sf: str) -> DataFrame:
    """K1: a load that broke off (part of the rows written, no manifest entry), then the retry."""
    path = fresh_dir(spark, "raw_pageviews")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    curate.write_raw(rows.where("count_views % 3 = 0"), f"{path}/load_id=broken")
    curate.raw_load(spark, rows, path)
    return warehouse.raw_table(spark, path)


def _raw_in_loads(spark: SparkSession, sf: str, n: int) -> str:
    """The raw rows as ``n`` loads (by hour of the day); returns the table's path."""
    path = fresh_dir(spark, "raw_pageviews")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    for i in range(n):
        curate.raw_load(spark, rows.where(F.hour("loaded_at") % n == i), path, f"load-{i}")
    return path


def raw_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Several loads, a compaction that broke off half-way, then a whole one and the deletion of what it replaced."""
    path = _raw_in_loads(spark, sf, 4)
    manifest.write_raw(warehouse.raw_table(spark, path).where("count_views % 2 = 0"), manifest.folder(path, "compact-broken"))
    manifest.compact(spark, path)
    manifest.vacuum(spark, path)
    if len(manifest.snapshot(spark, path).loads) != 1:
        raise LoadCheckError("the loads were not replaced by one")
    return warehouse.raw_table(spark, path)


def retention_drop(spark: SparkSession, sf: str, days: int) -> DataFrame:
    """K7: expired dates dropped from every load; the deletion of their files breaks off after one load and is repeated."""
    path = _raw_in_loads(spark, sf, 2)
    for day in manifest.drop_expired(spark, path, tb.AS_OF, days):
        delete_path(spark, f"{manifest.folder(path, 'load-0')}/processing_date={day}")
    left = warehouse.raw_table(spark, path).agg(F.min("processing_date")).first()[0]
    manifest.vacuum(spark, path)
    if warehouse.raw_table(spark, path).agg(F.min("processing_date")).first()[0] != left:
        raise LoadCheckError("readers saw a dropped date before its files were deleted")
    return warehouse.raw_table(spark, path)


def dq_from_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """V2 from the commits of several loads, two of them compacted before the others came."""
    path = fresh_dir(spark, "raw_pageviews")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    for i in range(3):
        curate.raw_load(spark, rows.where(F.hour("loaded_at") % 3 == i), path, f"load-{i}")
        if i == 1:
            manifest.compact(spark, path)
            manifest.vacuum(spark, path)
    return analytics.v_data_quality_from_manifest(spark, path, tb.filtered_pageviews(spark, sf)).drop("approx_domains")


def rankings_sketched(spark: SparkSession, sf: str, days: int) -> DataFrame:
    """Q4 from stored partials; ``median_ok`` tells whether the sketched median's rank among all rows is within its error."""
    path = fresh_dir(spark, "company_partials")
    rows = tb.filtered_pageviews(spark, sf)
    analytics.company_partials(rows).write.partitionBy("processing_date").parquet(path)
    found = analytics.rankings_from_partials(spark.read.parquet(path), tb.AS_OF, days)
    own = analytics.last_n_days(rows, tb.AS_OF, days).join(found.select("company", "median_views", "page_count"), "company")
    below, up_to = (F.avg(c.cast("double")) for c in (F.col("count_views") < F.col("median_views"),
                                                      F.col("count_views") <= F.col("median_views")))
    error = analytics.MEDIAN_RANK_ERROR + 1.0 / F.min("page_count")
    ok = own.groupBy("company").agg(((below <= 0.5 + error) & (up_to >= 0.5 - error)).alias("median_ok"))
    return found.drop("median_views").join(ok, "company")


def fuzzy_stored(spark: SparkSession, sf: str, query: str, threshold: float) -> DataFrame:
    """J6 from the stored trigrams of two loads; the second holds the first's titles too."""
    path = fresh_dir(spark, "trigrams")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    fuzzy.add_titles(spark, rows.where(F.hour("loaded_at") < 12), path)
    fuzzy.add_titles(spark, rows, path)
    return fuzzy.search_stored(spark, query, path, threshold)


def daily_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The daily job over dumps with bad lines and a corrupt file, twice; the second run opens no file."""
    landing, root = fresh_dir(spark, "landing"), fresh_dir(spark, "daily")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    good = rows.select("source_file", F.concat_ws(" ", "domain", "page_title", F.col("count_views").cast("string"), F.lit("0")).alias("line"))
    bad = rows.select("source_file").distinct().select("source_file", F.explode(F.array(*[F.lit(x) for x in BAD_LINES])).alias("line"))
    dumps.write_dump_lines(good.unionByName(bad), landing)
    store, folder = filesystem(landing)
    with store.open_output_stream(f"{folder}/{CORRUPT_NAME}", compression=None) as f:
        f.write(b"not a gzip file")
    for again in (False, True):
        done = daily_job.run_daily(spark, landing, root, event_time_from_name=True, audit=True)
        if again and (done.files_read or done.quarantined_lines or done.raw_rows_loaded):
            raise LoadCheckError(f"the second run read {done.files_read} files")
    lines = daily_job.read_quarantine(spark, root).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_quarantined"))
    ledger = manifest.file_states(spark, f"{root}/raw_pageviews").join(lines, "source_file", "left")
    return ledger.select("source_file", "state", "n_rows", F.coalesce("n_bad", F.lit(0)).alias("n_bad"),
                         F.coalesce("n_quarantined", F.lit(0)).alias("n_quarantined"))


def _kept_rows(candidates: DataFrame) -> DataFrame:
    """Curated-shaped rows of the candidates that the verdict rules keep."""
    kept = candidates.where(rules.is_kept_title("page_title"))
    return kept.select("domain", "page_title", "count_views", "company", F.col("loaded_at").alias("filtered_at"),
                       "processing_date", F.lit(tb.FILTER_METHOD).alias("filter_method"))


def curated_load(spark: SparkSession, sf: str) -> DataFrame:
    """K2: load kept verdict rows under the unique key (``max``), twice; the second changes nothing."""
    path = fresh_dir(spark, "filtered_pageviews")
    kept = tb.verdicts(spark, sf).where(F.col("verdict").startswith("keep:")).select(
        "domain", "page_title", "count_views", "company", F.col("loaded_at").alias("filtered_at"),
        "processing_date", F.lit(tb.FILTER_METHOD).alias("filter_method"), "event_id")
    for _ in range(2):
        curate.curated_load(spark, kept, path, on_duplicate="max", tie_break=["event_id"])
    return spark.read.parquet(path).select(*FILTERED)


def curated_two_loads(spark: SparkSession, sf: str) -> DataFrame:
    """K2: the hours before noon, then the rest, each curated by recomputing the dates touched (max and sum)."""
    raw_path = fresh_dir(spark, "raw_pageviews")
    paths = {mode: fresh_dir(spark, f"filtered_{mode}") for mode in ("max", "sum")}
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    morning = F.hour("loaded_at") < 12
    for load_id, part in (("am", morning), ("pm", ~morning)):
        curate.raw_load(spark, rows.where(part), raw_path, load_id)
        dates = curate.loaded_dates(spark, raw_path, load_id)
        raw = warehouse.raw_table(spark, raw_path).where(F.col("processing_date").isin(dates))
        kept = _kept_rows(prefilter.prefilter(raw, None, columns=None))
        for mode, path in paths.items():
            curate.curated_load(spark, kept, path, on_duplicate=mode, tie_break=["filtered_at"], dates=dates)
    both = [spark.read.parquet(path).select(F.lit(mode).alias("mode"), "domain", "page_title", "count_views", "company",
                                            "processing_date", "filter_method") for mode, path in paths.items()]
    return both[0].unionByName(both[1])


def union_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two separately written parts (morning / afternoon hours) read back as one frame."""
    raw = tb.raw_pageviews(spark, sf, with_event_id=False)
    am, pm = fresh_dir(spark, "raw_am"), fresh_dir(spark, "raw_pm")
    morning = F.hour("loaded_at") < 12
    raw.where(morning).write.parquet(am)
    raw.where(~morning).write.parquet(pm)
    return spark.read.parquet(am).unionByName(spark.read.parquet(pm)).select(*RAW)


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """S3/K3: candidates → CSV with header → read back with an explicit schema."""
    cols = "domain string, page_title string, count_views int, company string, processing_date date"
    path = fresh_dir(spark, "candidates_csv")
    files.write_csv(tb.candidates(spark, sf).select("domain", "page_title", "count_views", "company",
                                                    "processing_date"), path)
    return files.read_csv(spark, path, cols)


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K4: curated rows → JSON Lines → read back with the table schema."""
    path = fresh_dir(spark, "filtered_json")
    files.write_json(tb.filtered_pageviews(spark, sf), path)
    return files.read_json(spark, path, schemas.FILTERED_PAGEVIEWS).select(*FILTERED)


def csv_text_parse(spark: SparkSession, sf: str) -> DataFrame:
    """The ``csv_output`` text of scorer replies parsed back into rows."""
    replies = scoring.score_batches(scoring.build_prompts(tb.batched_candidates(spark, sf)))
    text = replies.select("bucket", "batch_no", F.get_json_object("reply", "$.csv_output").alias("csv_output"))
    return files.parse_csv_text(text, "csv_output", "domain string, page_title string, count_views long")


def csv_text_status(spark: SparkSession, sf: str) -> DataFrame:
    """Per batch, its rows and those that the CSV text of its reply holds; ``zero_rows`` where that is empty."""
    rows = tb.batched_candidates(spark, sf).withColumn("batch", F.concat_ws("/", "bucket", "batch_no"))
    replies = scoring.score_batches(scoring.build_prompts(rows))
    text = replies.select(F.concat_ws("/", "bucket", "batch_no").alias("batch"), F.get_json_object("reply", "$.csv_output").alias("csv"))
    kept = files.parse_csv_text(text, "csv", "domain string, page_title string, count_views long")
    return quality.zero_row_status(rows, kept, "batch")


def _dump_dir(spark: SparkSession, sf: str, where=None) -> str:
    path = fresh_dir(spark, "landing")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    dumps.write_dump_files(rows if where is None else rows.where(where), path)
    return path


def dump_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Raw rows written as hourly gzip dumps, then parsed back (strict: no bad lines)."""
    good, _ = dumps.parse_dumps(spark, _dump_dir(spark, sf), strict=True)
    return good.select("domain", "page_title", "count_views", "source_file")


def gz_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Audit of the written dump files: every file intact, one line per raw row."""
    return dumps.gz_audit(spark, _dump_dir(spark, sf)).select("file_name", "status", "lines")


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """availableNow ingest of the landing folder; a second run adds nothing."""
    landing = _dump_dir(spark, sf)
    table, ckpt = fresh_dir(spark, "raw_stream"), fresh_dir(spark, "ckpt")
    ingest.ingest_dumps(spark, landing, table, ckpt, max_files_per_trigger=250)
    ingest.ingest_dumps(spark, landing, table, ckpt)
    return ingest.read_raw_stream_table(spark, table)


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Dumps with bad lines and one file without an hour in its name; lines per fate (raw or a reason)."""
    landing = fresh_dir(spark, "landing")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    good = rows.select("source_file", F.concat_ws(" ", "domain", "page_title", F.col("count_views").cast("string"), F.lit("0")).alias("line"))
    names = rows.select("source_file").distinct()
    bad = names.select("source_file", F.explode(F.array(*[F.lit(x) for x in BAD_LINES])).alias("line"))
    odd = good.where("source_file LIKE '%-120000.gz'").select(F.lit(ODD_NAME).alias("source_file"), "line")
    dumps.write_dump_lines(good.unionByName(bad).unionByName(odd), landing)
    table, ckpt = fresh_dir(spark, "raw_stream"), fresh_dir(spark, "ckpt")
    ingest.ingest_dumps(spark, landing, table, ckpt, max_files_per_trigger=300)
    kept = ingest.read_raw_stream_table(spark, table).select(F.lit("raw").alias("fate"))
    lost = ingest.read_quarantine(spark, table).select(F.col("reason").alias("fate"))
    return kept.unionByName(lost).groupBy("fate").agg(F.count(F.lit(1)).alias("n_lines"))


def late_row_count(spark: SparkSession, sf: str) -> DataFrame:
    """Days 11 and later first, then the older ones behind the watermark; the rows the live totals leave out."""
    landing, log, ckpt = fresh_dir(spark, "landing"), fresh_dir(spark, "daily_log"), fresh_dir(spark, "ckpt")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    late = F.dayofmonth("loaded_at") <= 10
    for part in (~late, late):
        dumps.write_dump_files(rows.where(part), landing)
        ingest.daily_company_totals(spark, landing, log, ckpt, watermark="2 days")
    return ingest.late_rows(spark, landing, log)


def late_files(spark: SparkSession, sf: str) -> DataFrame:
    """R2: newer hours first, older (late) hours later; the late files still land."""
    landing = fresh_dir(spark, "landing")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    table, ckpt = fresh_dir(spark, "raw_stream"), fresh_dir(spark, "ckpt")
    late = F.dayofmonth("loaded_at") <= 15
    dumps.write_dump_files(rows.where(~late), landing)
    ingest.ingest_dumps(spark, landing, table, ckpt)
    dumps.write_dump_files(rows.where(late), landing)
    ingest.ingest_dumps(spark, landing, table, ckpt)
    return ingest.read_raw_stream_table(spark, table)


def stream_daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Live daily company totals from the dump stream, read from the update log."""
    landing = _dump_dir(spark, sf)
    log, ckpt = fresh_dir(spark, "daily_log"), fresh_dir(spark, "ckpt")
    ingest.daily_company_totals(spark, landing, log, ckpt, watermark="2 days")
    return ingest.latest_totals(spark, log)


def stream_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Late days behind the watermark, then a second checkpoint that sees the mornings only; the repaired totals."""
    landing, mornings = fresh_dir(spark, "landing"), fresh_dir(spark, "landing")
    log, raw, ckpt = fresh_dir(spark, "daily_log"), fresh_dir(spark, "raw_stream"), fresh_dir(spark, "ckpt")
    raw_ckpt = fresh_dir(spark, "ckpt")
    rows = tb.raw_pageviews(spark, sf, with_event_id=False)
    late = F.dayofmonth("loaded_at") <= 10
    for part in (~late, late):
        dumps.write_dump_files(rows.where(part), landing)
        ingest.ingest_dumps(spark, landing, raw, raw_ckpt)
        ingest.daily_company_totals(spark, landing, log, ckpt, watermark="2 days")
    ingest.repair_totals(spark, raw, log)
    dumps.write_dump_files(rows.where(F.hour("loaded_at") < 12), mornings)
    ingest.daily_company_totals(spark, mornings, log, fresh_dir(spark, "ckpt"), watermark="2 days")
    ingest.repair_totals(spark, raw, log)
    if ingest.repair_totals(spark, raw, log):
        raise LoadCheckError("a repair of repaired totals changed them")
    return ingest.latest_totals(spark, log)
