"""Incremental ingest of dump files with Structured Streaming.

* ``ingest_dumps`` (R1/R2): ``readStream.text`` over a landing folder → dump parse
  → ``foreachBatch``: each micro-batch is one raw load named after its checkpoint's
  query id and its batch number (``operators.curate.raw_load``), so a replayed batch
  changes nothing, another checkpoint's batches are loads of their own, and files
  already loaded stay out. Bad lines, and all lines of a file whose name
  holds no hour, go to the quarantine in the same batch. No watermark here: a dump
  that arrives late still lands in the raw table.
* ``daily_company_totals`` (R3): the same stream, prefiltered, aggregated per
  day and company with a watermark in update mode. Updates go to a log, an entry
  per (stream, batch) numbered in the order of writing; ``latest_totals`` reads the
  last one per key. Rows later than the watermark are left out of this live view:
  ``late_rows`` counts them, ``repair_totals`` replaces the cells they belong to.
  One job at a time writes the log.

Event time is the hour in the dump's file name (``pageviews-YYYYMMDD-HH0000.gz``).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewsift.functions import rules
from viewsift.operators import manifest, prefilter
from viewsift.operators.curate import dates_of_loads, raw_load
from viewsift.session import materialize
from viewsift.sources.dumps import classify_dump_lines, split_classified
from viewsift.sources.warehouse import raw_table

HOUR_PATTERN = r"pageviews-(\d{8}-\d{6})"


def event_hour_expr(file_col: str = "source_file") -> F.Column:
    """The hour in a dump's name; null where the name holds none."""
    return F.try_to_timestamp(F.regexp_extract(F.col(file_col), HOUR_PATTERN, 1), F.lit("yyyyMMdd-HHmmss")) \
        .cast("timestamp_ntz")


def line_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new dump files as a stream, with their ``source_file``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(landing_dir).select("value", F.col("_metadata.file_name").alias("source_file"))


def parsed_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with ``event_hour`` and ``processing_date``, quarantine) of dump lines."""
    return split_hours(classified_hours(lines))


def classified_hours(lines: DataFrame) -> DataFrame:
    """``classify_dump_lines`` with the ``event_hour`` in the file's name; files without one are odd."""
    named = lines.withColumn("event_hour", event_hour_expr("source_file"))
    return classify_dump_lines(named, odd=F.col("event_hour").isNull())


def split_hours(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with ``event_hour`` and ``processing_date``, quarantine) of ``classified_hours``."""
    good, bad = split_classified(classified)
    return good.withColumn("processing_date", F.to_date("event_hour")), bad.select("source_file", "line", "reason")


def dump_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parsed good rows of new dump files as a stream, with ``event_hour`` and ``processing_date``."""
    return parsed_lines(line_stream(spark, landing_dir, max_files_per_trigger))[0]


RAW_STREAM_COLUMNS = ["domain", "page_title", "count_views", "source_file", "event_hour", "processing_date"]


def quarantine_path(table_path: str) -> str:
    return table_path.rstrip("/") + "_quarantine"


def stream_id(spark: SparkSession, checkpoint_dir: str) -> str:
    """The query id that Spark wrote into the checkpoint: the same over restarts, another one per checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint_dir.rstrip('/')}/metadata").first()["id"]


def drop_settled_files(bad: DataFrame, table_path: str, load_id: str) -> DataFrame:
    """Bad lines of files that no other load has settled (the manifest's ledger; the quarantine is not read)."""
    known = manifest.file_states(bad.sparkSession, table_path).where(F.col("load_id") != load_id).select("source_file")
    return bad.join(known, "source_file", "left_anti").select(*bad.columns)


def _load_batch(table_path: str, checkpoint_dir: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"{stream_id(spark, checkpoint_dir)}-{batch_id}"
        # one partition per dump file: rebalance before caching, so an oversized dump is spread
        lines = batch.hint("rebalance").persist()
        try:
            good, bad = parsed_lines(lines)
            # Stream and batch number name both folders: a replayed batch overwrites its own.
            path = f"{quarantine_path(table_path)}/batch={name}"
            drop_settled_files(bad, table_path, f"stream-{name}").write.mode("overwrite").parquet(path)
            n_bad = spark.read.schema(bad.schema).parquet(path).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_bad"))
            files = lines.select("source_file").distinct().join(n_bad, "source_file", "left")
            raw_load(spark, good.withColumnRenamed("event_hour", "loaded_at"), table_path, f"stream-{name}", files)
        finally:
            lines.unpersist()
    return run


def _run(query) -> int:
    """Wait for an ``availableNow`` query; returns the number of batches it ran."""
    while query.isActive and not query.recentProgress:  # Spark keeps the newest progress only: note the first
        query.awaitTermination(1)
    progress = query.recentProgress
    begin = progress[0]["batchId"] if progress else 0
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    progress = query.recentProgress
    return progress[-1]["batchId"] - begin + 1 if progress else 0


def ingest_dumps(spark: SparkSession, landing_dir: str, table_path: str, checkpoint_dir: str,
                 max_files_per_trigger: int | None = None) -> int:
    """Ingest every dump file not seen before (``availableNow``); returns batches run."""
    return _run(line_stream(spark, landing_dir, max_files_per_trigger).writeStream
                .foreachBatch(_load_batch(table_path, checkpoint_dir))
                .option("checkpointLocation", checkpoint_dir)
                .trigger(availableNow=True).start())


def read_raw_stream_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The committed rows; ``event_hour`` is the hour they were loaded for."""
    return raw_table(spark, table_path).withColumnRenamed("loaded_at", "event_hour").select(*RAW_STREAM_COLUMNS)


def read_quarantine(spark: SparkSession, table_path: str) -> DataFrame:
    """Quarantined lines of the stream: source_file, line, reason."""
    schema = "source_file string, line string, reason string"
    return spark.read.schema(schema).parquet(quarantine_path(table_path)).select("source_file", "line", "reason")


UPDATE_LOG = "seq long, processing_date date, company string, page_count long, total_views long, stream string, batch_id long"
REPAIR = "repair"


def _updates(spark: SparkSession, log_path: str) -> DataFrame:
    try:
        return spark.read.schema(UPDATE_LOG).parquet(log_path)
    except AnalysisException:  # none yet
        return spark.createDataFrame([], UPDATE_LOG)


def _write_updates(rows: DataFrame, log_path: str, stream: str, batch_id: int) -> int:
    """One entry of the update log, named by (stream, batch) and numbered after all others; returns its number."""
    spark = rows.sparkSession
    seq = _updates(spark, log_path).agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0] + 1
    rows.select(F.lit(seq).cast("long").alias("seq"), "processing_date", "company", "page_count", "total_views") \
        .write.mode("overwrite").parquet(f"{log_path.rstrip('/')}/stream={stream}/batch_id={batch_id}")
    return seq


def _append_updates(log_path: str, checkpoint_dir: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        _write_updates(batch, log_path, stream_id(batch.sparkSession, checkpoint_dir), batch_id)
    return run


def prefiltered(rows: DataFrame, min_views: int = rules.DEFAULT_MIN_VIEWS) -> DataFrame:
    """Rows that pass stages A (views) to C, with their company."""
    return prefilter.with_company(prefilter.stage_c(prefilter.stage_b(rows.where(F.col("count_views") >= int(min_views)))))


def daily_company_totals(spark: SparkSession, landing_dir: str, log_path: str, checkpoint_dir: str,
                         watermark: str = "2 days", min_views: int = rules.DEFAULT_MIN_VIEWS,
                         max_files_per_trigger: int | None = None) -> int:
    """Live daily totals per company of the prefiltered rows (update mode → update log)."""
    pre = prefiltered(dump_stream(spark, landing_dir, max_files_per_trigger), min_views)
    # Watermarks need an instant (TIMESTAMP); build it from the zone-free hour as UTC so the
    # day windows and ``processing_date`` agree whatever the session time zone is.
    instant = F.timestamp_seconds(F.unix_date("processing_date").cast("long") * 86400
                                  + F.hour("event_hour").cast("long") * 3600)
    agg = (pre.withColumn("event_ts", instant).withWatermark("event_ts", watermark)
           .groupBy(F.window("event_ts", "1 day").alias("day"), "processing_date", "company")
           .agg(F.count(F.lit(1)).alias("page_count"), F.sum("count_views").cast("long").alias("total_views")))
    out = agg.select("processing_date", "company", "page_count", "total_views")
    return _run(out.writeStream.outputMode("update").foreachBatch(_append_updates(log_path, checkpoint_dir))
                .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())


def _newest(log: DataFrame) -> DataFrame:
    best = F.max_by(F.struct("page_count", "total_views"), "seq")
    return log.groupBy("processing_date", "company").agg(best.alias("_v")).select(
        "processing_date", "company", F.col("_v.page_count").alias("page_count"),
        F.col("_v.total_views").alias("total_views"))


def latest_totals(spark: SparkSession, log_path: str) -> DataFrame:
    """The last entry per (processing_date, company) of the update log, live update or correction."""
    return _newest(_updates(spark, log_path)).where("page_count > 0")


def repairs_path(log_path: str) -> str:
    return log_path.rstrip("/") + "_repairs"


def repair_totals(spark: SparkSession, raw_path: str, log_path: str, min_views: int = rules.DEFAULT_MIN_VIEWS) -> int:
    """Correct the live totals from the raw table; returns the number of (day, company) cells replaced.

    The live totals miss rows later than the watermark, and an update of a second
    checkpoint (or of a second landing folder) knows only what that stream has read.
    The raw table holds every file once. So the days that raw loads (R1's micro-batches)
    or live updates have touched since the last repair are counted again from its
    partitions of these days, and each cell that differs is replaced by a correction in
    the update log, an entry of its own of the stream ``repair``. A repair that broke
    off is repeated by the next one.
    """
    try:
        done = spark.read.schema("load_id string, seq long, batch_id long").parquet(repairs_path(log_path))
    except AnalysisException:  # the first repair
        done = spark.createDataFrame([], "load_id string, seq long, batch_id long")
    last = done.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("seq"), F.coalesce(F.max("batch_id"), F.lit(-1)).alias("batch")).first()
    loads = manifest.log(spark, raw_path).where("action = 'load'").join(done.select("load_id"), "load_id", "left_anti").select("load_id")
    loads = materialize(loads, "repair-loads")
    log = _updates(spark, log_path)
    touched = log.where((F.col("seq") > last.seq) & (F.col("stream") != REPAIR)).select("processing_date").distinct()
    dates = sorted({*dates_of_loads(loads, raw_path), *(r[0] for r in touched.collect())})  # days
    seen = log.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
    n = 0
    if dates:
        own = F.col("processing_date").isin(dates)
        whole = prefiltered(raw_table(spark, raw_path).where(own), min_views).groupBy("processing_date", "company").agg(
            F.count(F.lit(1)).alias("n"), F.sum("count_views").cast("long").alias("v"))
        both = _newest(log.where(own)).join(whole, ["processing_date", "company"], "full")
        n_rows, views = (F.coalesce(c, F.lit(0)) for c in ("n", "v"))
        wrong = both.where(~F.coalesce("page_count", F.lit(0)).eqNullSafe(n_rows) | ~F.coalesce("total_views", F.lit(0)).eqNullSafe(views))
        wrong = materialize(wrong.select("processing_date", "company", n_rows.alias("page_count"), views.alias("total_views")),
                            "corrections")
        n = wrong.count()
        if n:
            seen = _write_updates(wrong, log_path, REPAIR, last.batch + 1)
    noted = loads.select("load_id").unionByName(spark.createDataFrame([(None,)], "load_id string"))
    noted.select("load_id", F.lit(seen).cast("long").alias("seq"), F.lit(last.batch + 1).cast("long").alias("batch_id")) \
        .coalesce(1).write.mode("append").parquet(repairs_path(log_path))  # one file: the repair is done
    return n


def late_rows(spark: SparkSession, landing_dir: str, log_path: str, min_views: int = rules.DEFAULT_MIN_VIEWS) -> DataFrame:
    """Per day and company, prefiltered rows of the landing folder that the live totals left out as too late."""
    lines = spark.read.text(landing_dir).select("value", F.col("_metadata.file_name").alias("source_file"))
    every = prefiltered(parsed_lines(lines)[0], min_views).groupBy("processing_date", "company").agg(F.count(F.lit(1)).alias("n"))
    live = latest_totals(spark, log_path).select("processing_date", "company", "page_count")
    late = F.col("n") - F.coalesce("page_count", F.lit(0))
    return every.join(live, ["processing_date", "company"], "left") \
        .select("processing_date", "company", late.alias("late_rows")).where("late_rows > 0")
