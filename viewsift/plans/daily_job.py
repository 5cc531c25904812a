"""The daily job end to end: dumps → raw table → prefilter → scoring → curated table.

Entry points 1 and 2 of the original (extract + load raw; transform + curate)
as one function over a landing folder and a warehouse root. Every step is a
Spark job; Python runs only for an external scorer, whose replies are written
before they are read twice.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewsift import schemas
from viewsift.functions import rules
from viewsift.operators import curate, manifest, prefilter, quality, scoring
from viewsift.session import drop_scratch, materialize, scratch_mark
from viewsift.sources import dumps, warehouse
from viewsift.streaming.ingest import classified_hours, split_hours


class LoadCheckError(RuntimeError):
    """A dump load that must not pass: no usable row, or a missing column."""


@dataclass
class DailyResult:
    raw_rows_loaded: int
    quarantined_lines: int
    curated_rows_loaded: int
    stats: dict
    verified: list = field(default_factory=list)
    files_read: int = 0


def run_daily(spark: SparkSession, landing: str, root: str, as_of=None, min_views: int = rules.DEFAULT_MIN_VIEWS,
              scorer: scoring.Scorer | None = None, filter_method: str = "rules_v1",
              loaded_at=None, processing_date=None, on_duplicate: str = "max",
              batch_size: int = scoring.DEFAULT_BATCH_SIZE, event_time_from_name: bool = False,
              audit: bool = False) -> DailyResult:
    """Load new dumps from ``landing`` and curate the dates of all raw loads not curated yet, and ``as_of``.

    A run that broke after its raw load is made good by the next one, with or without
    new dumps: curated raw loads are noted in ``{root}/filtered_pageviews_commits``.

    ``processing_date`` defaults to the load date as in the original (D4); pass
    it (and ``loaded_at``) explicitly, or set ``event_time_from_name`` to date each
    row by the hour in its dump's name (backfills). Tables live in
    ``{root}/raw_pageviews``, ``{root}/filtered_pageviews``; bad dump lines go to
    ``{root}/quarantine``; scorer replies to ``{root}/scorer_replies``. ``audit``
    checks every new gzip first (one extra decompression pass) and lists corrupt files
    in ``{root}/corrupt_files`` instead of failing on them.

    Every file read gets its state (loaded, quarantined, corrupt, empty) in the
    commit of the load. Files with a state are not opened again; a corrupt one is,
    once its length has changed.

    The curated dates are recomputed from all raw rows of theirs, so the result does
    not depend on how the dumps were split over runs. Checks stop the job: no good
    line (C1) or no candidate in the touched dates (C5); the per-file report of the
    load (C2) is returned as ``verified``.
    """
    raw_path, cur_path = f"{root}/raw_pageviews", f"{root}/filtered_pageviews"
    load_id, mark = uuid.uuid4().hex, scratch_mark(spark)
    # The ledger prunes files before any is opened; what is left is the run's own file list.
    files = materialize(manifest.new_files(dumps.list_files(spark, landing), raw_path), "new-files")
    if audit:
        # Corrupt files are recorded and skipped instead of failing the whole read.
        files = _audited(spark, files, f"{root}/corrupt_files/load_id={load_id}")
    sound = files.where(F.col("error").isNull()) if audit else files
    paths = [r.path for r in sound.select("path").collect()]
    n_raw = n_bad = 0
    if paths:
        # A gzip file is one task; REBALANCE spreads its lines (a dump holding a third of the day
        # included) over AQE-sized partitions. This is the job's one cached copy: gzip is read, and its lines parsed, once.
        lines = dumps.read_dump_lines(spark, paths).hint("rebalance")
        lines = (classified_hours(lines) if event_time_from_name else dumps.classify_dump_lines(lines)) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if event_time_from_name:
                good, bad = split_hours(lines)
                rows = dumps.fill_unknown(good).withColumnRenamed("event_hour", "loaded_at")
            else:
                good, bad = dumps.split_classified(lines)
                rows = curate.with_raw_lineage(dumps.fill_unknown(good), loaded_at, processing_date)
            found = quality.extract_checks(rows).first()
            if not found.passed:
                raise LoadCheckError(f"the dumps failed the extract checks: {found.asDict()}")
            bad_path = f"{quarantine_path(root)}/load_id={load_id}"
            bad.write.parquet(bad_path)
            bad = spark.read.schema(bad.schema).parquet(bad_path)
            n_bad = bad.count()
            files = files.join(bad.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_bad")), "source_file", "left")
            n_raw = curate.raw_load(spark, rows, raw_path, load_id, files)
        finally:
            lines.unpersist()
    elif not files.isEmpty():  # corrupt files only
        curate.raw_load(spark, spark.createDataFrame([], schemas.RAW_PAGEVIEWS), raw_path, load_id, files)
    loads = materialize(curate.uncurated_loads(spark, raw_path, cur_path), "uncurated-loads")
    dates = [] if loads.isEmpty() else curate.dates_of_loads(loads, raw_path)
    if as_of is not None:
        dates = sorted({*dates, dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of})
    if not dates:
        drop_scratch(spark, mark)
        return DailyResult(n_raw, n_bad, 0, {}, files_read=len(paths))

    raw = warehouse.raw_table(spark, raw_path).where(F.col("processing_date").isin(dates))
    verified = quality.verify_load(curate.load_rows(spark, raw_path, load_id)).collect() if n_raw else []  # one row per file
    cand = prefilter.prefilter(raw, None, min_views, columns=None, require_rows=True)
    cand = scoring.sticky_buckets(materialize(cand, "candidates"), batch_size).drop("depth", "prefix")
    batched = scoring.assign_batches(cand, batch_size, bucket=F.col("bucket"))
    prompts = scoring.build_prompts(batched)
    # An external scorer's replies are stored by prompt hash: a re-run only sends prompts not answered yet.
    replies = scoring.native_replies(prompts) if scorer is None else \
        scoring.score_batches_stored(prompts, f"{root}/scorer_replies", scorer)
    # Written once each: a reply's status and its records are read by the join back and the stats.
    statuses = scoring.persist_replies(scoring.reply_status(replies))
    records = materialize(scoring.reply_rows(statuses, status_col="status"), "reply-records")
    accepted = scoring.accepted_rows(batched, records)
    curated = accepted.select("domain", "page_title", "count_views", "company",
                              F.col("loaded_at").alias("filtered_at"), "processing_date",
                              F.lit(filter_method).alias("filter_method"))
    n_cur = curate.curated_load(spark, curated, cur_path, on_duplicate=on_duplicate, tie_break=["filtered_at"],
                                dates=dates)
    curate.mark_curated(loads, cur_path)
    stats = scoring.llm_stats(batched, statuses, records, batch_size).first().asDict()
    drop_scratch(spark, mark)
    return DailyResult(n_raw, n_bad, n_cur, stats, verified, len(paths))


def _audited(spark: SparkSession, files: DataFrame, report_path: str) -> DataFrame:
    """``files`` (path, ...) plus the ``error`` of corrupt ones, which are written to ``report_path``."""
    paths = [r.path for r in files.select("path").collect()]  # the run's own file list
    if not paths:
        return files.withColumn("error", F.lit(None).cast("string"))
    checked = dumps.gz_audit(spark, paths).where(F.col("status") != "ok").persist()
    try:
        checked.write.parquet(report_path)
    finally:
        checked.unpersist()
    found = spark.read.schema(dumps.AUDIT_SCHEMA).parquet(report_path)
    return materialize(files.join(found.select("path", F.coalesce("error", F.lit("corrupt")).alias("error")), "path", "left"),
                       "audited-files")


def quarantine_path(root: str) -> str:
    return f"{root.rstrip('/')}/quarantine"


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Bad lines (source_file, line, reason) of committed loads: each once, whatever runs broke off or were repeated."""
    schema = "source_file string, line string, reason string, load_id string"
    rows = spark.read.schema(schema).parquet(quarantine_path(root))
    loads = manifest.log(spark, f"{root}/raw_pageviews").where("action = 'load'").select("load_id")
    return rows.join(loads, "load_id", "left_semi").select("source_file", "line", "reason")


def dashboard(raw: DataFrame, filtered: DataFrame, as_of, days: int = 7, companies=None,
              search: str | None = None, raw_path: str | None = None) -> dict[str, DataFrame]:
    """The dashboard's queries over stored tables: Q3–Q8, V2's newest 30 dates, V1, V3, and Q9 for a search text.

    With ``raw_path``, the raw table's folder, V2 is read from its manifest instead of the raw rows.
    """
    from viewsift.plans import analytics as A

    if raw_path is None:
        quality_rows = A.dq_latest(raw, filtered, 30)
    else:
        quality_rows = A.v_data_quality_from_manifest(raw.sparkSession, raw_path, filtered).drop("approx_domains") \
            .orderBy(F.col("processing_date").desc()).limit(30)

    return {
        "filtered_window": A.filtered_window(filtered, as_of, days, companies),
        "rankings": A.rankings_window(filtered, as_of, days, companies),
        "trends": A.daily_trends(filtered, as_of, days, companies),
        "quality": quality_rows,
        "winner": A.winner_window(filtered, as_of, days),
        "top15": A.top_pages(filtered, as_of, days, 15),
        "overview": A.overview(filtered, as_of, days, companies),
        "daily_summary": A.v_daily_company_summary(filtered),
        "pages_by_company": A.v_top_pages_by_company(filtered, as_of, days, method="split"),
    } | ({"search": A.title_search(filtered, as_of, search, days)} if search else {})
