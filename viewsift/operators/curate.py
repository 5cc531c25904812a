"""Loads and the curated table (K1, K2, K7) and keyed de-duplication.

Writes go to partitioned Parquet under a caller-given root (on a cluster: a
shared folder). Raw loads are all or nothing and once per ``source_file`` (a
manifest written last makes a load visible); curated loads replace the dates they
touch. A retried or repeated run changes nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewsift import schemas
from viewsift.operators import manifest
from viewsift.operators.manifest import load_rows, write_raw  # noqa: F401 (part of the load interface)
from viewsift.session import delete_path, materialize


class DuplicateKeyError(RuntimeError):
    """Raised when curated rows collide on the unique key and ``on_duplicate='error'``."""


def dedupe_keep_best(df: DataFrame, key: Sequence[str], desc: Sequence[str] = (),
                     asc: Sequence[str] = ()) -> DataFrame:
    """One row per ``key``: highest ``desc`` columns, then lowest ``asc`` columns.

    Written as ``min_by`` over a struct rather than ``row_number``: the aggregate
    is combined map-side, so a hot key (even a third of all rows) shrinks to one
    row per map task before the shuffle instead of landing whole in one task.
    ``desc`` columns must be numeric (they are negated in the ordering struct).
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    order = F.struct(*[(-F.col(c)).alias(f"_d{i}") for i, c in enumerate(desc)],
                     *[F.col(c).alias(f"_a{i}") for i, c in enumerate(asc)])
    best = F.min_by(F.struct(*rest), order).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_best.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def with_raw_lineage(parsed: DataFrame, loaded_at: dt.datetime | None = None,
                     processing_date: dt.date | None = None) -> DataFrame:
    """``loaded_at`` / ``processing_date`` for parsed dump rows that carry ``source_file``.

    Without explicit values, the current timestamp of the query is used (one value
    for the whole load, as one transaction has one).
    """
    ts = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else F.localtimestamp()
    day = F.lit(processing_date).cast("date") if processing_date else ts.cast("date")
    return parsed.withColumn("loaded_at", ts).withColumn("processing_date", day)


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # no table yet
        return None


# --------------------------------------------------------------------------- K1 raw loads

commits_path = manifest.log_path


def commits(spark: SparkSession, table_path: str) -> DataFrame:
    """The loaded files: load_id, source_file and row count of each."""
    rows = manifest.log(spark, table_path).where("action = 'file' AND state = 'loaded'")
    return rows.select("load_id", "source_file", "n_rows")


def drop_loaded_files(spark: SparkSession, rows: DataFrame, table_path: str) -> DataFrame:
    """Rows whose ``source_file`` no committed load holds yet.

    An anti join with the manifest, which has one row per file: the raw history is
    never scanned, and nothing is collected.
    """
    done = commits(spark, table_path).select("source_file").distinct()
    return rows.join(done, "source_file", "left_anti").select(*rows.columns)


def raw_load(spark: SparkSession, rows: DataFrame, table_path: str, load_id: str | None = None,
             files: DataFrame | None = None) -> int:
    """K1: load raw rows, all or nothing, each ``source_file`` once; returns the number of new rows.

    A load writes its own ``load_id=...`` folder and then one manifest commit; rows
    count as loaded only when the manifest names their load, so what a broken load
    left behind is invisible, and its files are loaded again by the next run. A
    load repeated under the same ``load_id`` (a replayed micro-batch) overwrites
    its folder until it is committed; after that, files not loaded yet go to a
    folder of their own, so only ``source_file`` decides what is skipped.

    ``files`` (source_file, and of length, n_bad, error what is known) lists the files
    the rows were read from: each gets its state in the same commit, those without
    rows too (``corrupt`` with an error, else ``quarantined`` with bad lines, else ``empty``).
    """
    load_id = load_id or uuid.uuid4().hex
    log = manifest.log(spark, table_path)
    if not log.where((F.col("action") == "load") & (F.col("load_id") == load_id)).isEmpty():  # its folder must stay
        load_id = f"{load_id}-{uuid.uuid4().hex}"
    rows = rows.select(*[f.name for f in schemas.RAW_PAGEVIEWS.fields])
    write_raw(drop_loaded_files(spark, rows, table_path), manifest.folder(table_path, load_id))
    written = load_rows(spark, table_path, load_id)
    own = written.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
    manifest.commit(spark, table_path, manifest.one(spark, action="load", load_id=load_id),
                    _file_actions(own, files, table_path, load_id), manifest.date_actions(written, load_id))
    own = commits(spark, table_path).where(F.col("load_id") == load_id)
    return own.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def _file_actions(own: DataFrame, files: DataFrame | None, table_path: str, load_id: str) -> DataFrame:
    """The ``file`` actions of a load from its rows per file and what is known of the files read."""
    if files is not None:
        more = [c for c in ("length", "n_bad", "error") if c in files.columns]
        # a file that an earlier load holds keeps its state
        known = files.join(commits(files.sparkSession, table_path).select("source_file"), "source_file", "left_anti")
        own = own.join(known.select("source_file", *more), "source_file", "full")
    for c, kind in (("length", "long"), ("n_bad", "long"), ("error", "string")):
        if c not in own.columns:
            own = own.withColumn(c, F.lit(None).cast(kind))
    state = (F.when(F.col("n_rows") > 0, "loaded").when(F.col("error").isNotNull(), "corrupt")
             .when(F.col("n_bad") > 0, "quarantined").otherwise("empty"))
    return own.withColumn("state", state).withColumn("n_rows", F.coalesce("n_rows", F.lit(0)).cast("long")) \
        .withColumn("action", F.lit("file")).withColumn("load_id", F.lit(load_id))


def loaded_dates(spark: SparkSession, table_path: str, load_id: str) -> list:
    """The dates one load touched (a day, or the days of a backfill)."""
    return dates_of_loads(spark.createDataFrame([(load_id,)], "load_id string"), table_path)


def uncurated_loads(spark: SparkSession, raw_path: str, curated_path: str) -> DataFrame:
    """``load_id`` of the committed raw loads that no finished curated load has covered yet."""
    loads = manifest.log(spark, raw_path).where("action = 'load'").select("load_id")
    done = _existing(spark, commits_path(curated_path))
    return loads if done is None else loads.join(done.select("load_id"), "load_id", "left_anti")


def mark_curated(loads: DataFrame, curated_path: str) -> None:
    """Note that the dates of these raw loads are curated: one row per load, in one file."""
    loads.select("load_id").coalesce(1).write.mode("append").parquet(commits_path(curated_path))


def dates_of_loads(loads: DataFrame, raw_path: str) -> list:
    """The dates these raw loads touched, as the manifest has them (their folders may be compacted away)."""
    rows = manifest.log(loads.sparkSession, raw_path).where("action = 'date'").join(loads.select("load_id"), "load_id", "left_semi")
    return sorted(r[0] for r in rows.select("processing_date").distinct().collect())


# --------------------------------------------------------------------------- K2 curated loads

def prepare_curated(rows: DataFrame, on_duplicate: str = "error",
                    tie_break: Sequence[str] = ()) -> DataFrame:
    """K2 (step 1): one row per unique key among the new rows.

    ``on_duplicate``: ``'error'`` (as the UNIQUE constraint), ``'max'`` (highest
    ``count_views``, then lowest ``tie_break`` columns) or ``'sum'`` (daily total).
    """
    key = schemas.FILTERED_KEY
    if on_duplicate == "max":
        return dedupe_keep_best(rows, key, desc=["count_views"], asc=list(tie_break))
    if on_duplicate == "sum":
        others = [c for c in rows.columns if c not in key and c != "count_views"]
        return rows.groupBy(*key).agg(F.sum("count_views").cast("int").alias("count_views"),
                                      *[F.min(c).alias(c) for c in others]).select(*rows.columns)
    if on_duplicate == "error":
        dup = rows.groupBy(*key).count().where(F.col("count") > 1).first()  # one job, stops at the first
        if dup is not None:
            raise DuplicateKeyError(f"duplicate curated keys, e.g. {dup}")
        return rows
    raise ValueError(f"on_duplicate must be error, max or sum, not {on_duplicate!r}")


def curated_load(spark: SparkSession, rows: DataFrame, table_path: str, on_duplicate: str = "error",
                 tie_break: Sequence[str] = (), dates: Sequence | None = None) -> int:
    """K2: replace whole dates of the curated table under the unique key; returns the rows written.

    ``rows`` must hold *all* kept rows of the dates they touch (not only those of
    the last load): the dates' partitions are replaced, so the table does not
    depend on how the loads were split, and a key that gets a second value later
    is judged by ``on_duplicate`` like one that had it at once. ``dates`` names
    dates that must be replaced even if no row of theirs is left.
    """
    cols = [f.name for f in schemas.FILTERED_PAGEVIEWS.fields]
    new = materialize(prepare_curated(rows, on_duplicate, tie_break).select(*cols), "curated-rows")
    (new.hint("rebalance", "processing_date").sortWithinPartitions("processing_date", "company")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("processing_date").parquet(table_path))
    if dates:
        left = {r[0] for r in new.select("processing_date").distinct().collect()}  # of these dates at most
        for day in set(dates) - left:
            delete_path(spark, f"{table_path.rstrip('/')}/processing_date={day}")
    return new.count()


def retention_window(df: DataFrame, as_of, days: int = 90, date_col: str = "processing_date") -> DataFrame:
    """K7: rows inside the retention window (a partition filter: pruned at scan time)."""
    return df.where(F.col(date_col) >= F.date_sub(F.lit(as_of).cast("date"), int(days)))


def expired_partitions(df: DataFrame, as_of, days: int = 90, date_col: str = "processing_date") -> DataFrame:
    """K7: the partition values past retention (to drop by path)."""
    return df.select(date_col).distinct().where(
        F.col(date_col) < F.date_sub(F.lit(as_of).cast("date"), int(days)))
