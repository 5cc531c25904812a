"""The raw table's manifest: an append-only log of commits, and the table maintenance built on it.

Every commit is one Parquet file (one rename), so it is visible whole or not at
all. It holds one row per action:

* ``load``: the folder of a load is part of the table.
* ``file``: what became of one dump file (``state``: loaded, quarantined, corrupt, empty).
* ``date``: what one load holds of one date: counts, load times, a sketch of its domains.
* ``compact``: a folder that holds the rows of other loads; ``replace``: one of these.
* ``drop``: a date is gone from every load up to this version.

The state of the table follows from the log (``snapshot``): readers get the
folders of the visible loads by name, and rows of dropped dates are left out by
partition filters, whether their files are deleted yet or not. Replaced folders
and dropped dates are deleted later (``vacuum``), so a reader that began before
keeps its files. The load actions are a list of folder names, far smaller than the
file listing that the driver holds for any scan; rows and file names stay in Spark.

Loads may run beside maintenance: a compaction replaces only the loads it read.
If two compactions replace the same load, the first to commit counts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewsift import schemas
from viewsift.session import delete_path

LOG = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("action", T.StringType()),
    T.StructField("load_id", T.StringType()), T.StructField("replaces", T.StringType()),
    T.StructField("source_file", T.StringType()), T.StructField("state", T.StringType()),
    T.StructField("length", T.LongType()), T.StructField("error", T.StringType()),
    T.StructField("processing_date", T.DateType()), T.StructField("n_rows", T.LongType()),
    T.StructField("n_bad", T.LongType()), T.StructField("n_files", T.LongType()),
    T.StructField("first_loaded", T.TimestampNTZType()), T.StructField("last_loaded", T.TimestampNTZType()),
    T.StructField("domains", T.BinaryType())])

#: Files in these states are not read again; a corrupt one is, once its length has changed.
DONE = ("loaded", "quarantined", "empty")


class UnknownVersionError(ValueError):
    """A version that the manifest does not hold, or whose files may be deleted."""


def log_path(table_path: str) -> str:
    return table_path.rstrip("/") + "_commits"


def folder(table_path: str, load_id: str) -> str:
    return f"{table_path.rstrip('/')}/load_id={load_id}"


def log(spark: SparkSession, table_path: str) -> DataFrame:
    """All actions committed so far."""
    try:
        return spark.read.schema(LOG).parquet(log_path(table_path))
    except AnalysisException:  # no commit yet
        return spark.createDataFrame([], LOG)


def commit(spark: SparkSession, table_path: str, *actions: DataFrame) -> int:
    """Write actions (columns of the log; missing ones are null) as one commit; returns its version."""
    version = current_version(spark, table_path) + 1
    out = spark.createDataFrame([], LOG).drop("version")
    for a in actions:
        out = out.unionByName(a, allowMissingColumns=True)
    out.select(F.lit(version).cast("long").alias("version"), *LOG.names[1:]).coalesce(1) \
        .write.mode("append").parquet(log_path(table_path))  # one file: the commit is one rename
    return version


def current_version(spark: SparkSession, table_path: str) -> int:
    """The newest version; 0 before the first commit."""
    return log(spark, table_path).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def one(spark: SparkSession, **values) -> DataFrame:
    """One action."""
    return spark.range(1).select(*[F.lit(v).cast(LOG[k].dataType).alias(k) for k, v in values.items()])


@dataclass
class Snapshot:
    """The table at one version: visible folders with the version of their rows, and the dropped dates."""

    version: int
    loads: dict[str, int]
    gone: list[str]
    drops: dict

    def hidden(self) -> list[tuple[str, object]]:
        """(load, date) pairs whose rows a drop hides."""
        return [(name, day) for name, since in sorted(self.loads.items()) for day, until in sorted(self.drops.items())
                if since <= until]


def snapshot(spark: SparkSession, table_path: str, version: int | None = None) -> Snapshot:
    """The state that the log gives, as of ``version`` (default: the newest)."""
    rows = log(spark, table_path).where(F.col("action").isin("load", "compact", "replace", "drop")) \
        .select("version", "action", "load_id", "replaces", "processing_date", F.col("n_rows").alias("base"))
    found = sorted((r for r in rows.collect() if version is None or r.version <= version),
                   key=lambda r: (r.version, r.load_id or ""))
    if version is not None and version and not any(r.version == version for r in found) \
            and version > current_version(spark, table_path):
        raise UnknownVersionError(f"{table_path} has no version {version}")
    loads = {r.load_id: r.version for r in found if r.action == "load"}
    merged = {(r.version, r.load_id): r.base for r in found if r.action == "compact"}  # base: the version it was read at
    parts: dict[str, set[str]] = {}
    for r in found:
        if r.action == "replace":
            parts.setdefault(r.load_id, set()).add(r.replaces)
    gone: list[str] = []
    for (_, name), base in merged.items():  # in the order of commits
        if parts.get(name, set()) <= loads.keys():
            for old in parts.get(name, ()):
                del loads[old]
                gone.append(old)
            loads[name] = base
        else:  # another compaction was first
            gone.append(name)
    drops: dict = {}
    for r in found:
        if r.action == "drop":
            drops[r.processing_date] = max(r.version, drops.get(r.processing_date, 0))
    return Snapshot(found[-1].version if found else 0, loads, sorted(gone), drops)


def _literal_in(hidden: list[tuple[str, object]]) -> F.Column:
    """True for the rows of the given (load, date) pairs; a condition on partition columns only."""
    by_days: dict[tuple, list[str]] = {}
    days: dict[str, list] = {}
    for name, day in hidden:
        days.setdefault(name, []).append(day)
    for name, own in days.items():
        by_days.setdefault(tuple(own), []).append(name)
    out = F.lit(False)
    for own, names in by_days.items():
        out = out | (F.col("load_id").isin(names) & F.col("processing_date").isin(list(own)))
    return out


def read_table(spark: SparkSession, table_path: str, version: int | None = None) -> DataFrame:
    """The rows of the visible loads (RAW_PAGEVIEWS), as of ``version`` while its files exist."""
    state = snapshot(spark, table_path, version)
    names = [f.name for f in schemas.RAW_PAGEVIEWS.fields]
    if not state.loads:
        return spark.createDataFrame([], schemas.RAW_PAGEVIEWS)
    schema = T.StructType([*schemas.RAW_PAGEVIEWS.fields, T.StructField("load_id", T.StringType())])
    rows = spark.read.schema(schema).option("basePath", table_path) \
        .parquet(*[folder(table_path, name) for name in sorted(state.loads)])
    hidden = state.hidden()
    return (rows.where(~_literal_in(hidden)) if hidden else rows).select(*names)


def file_states(spark: SparkSession, table_path: str) -> DataFrame:
    """The ledger: one row per dump file with its newest state."""
    rows = log(spark, table_path).where("action = 'file'")
    newest = F.max_by(F.struct("state", "load_id", "n_rows", "n_bad", "length", "error"), "version").alias("_f")
    return rows.groupBy("source_file").agg(newest).select("source_file", "_f.*")


def new_files(listing: DataFrame, table_path: str) -> DataFrame:
    """The rows of a file listing (source_file, length, ...) that the ledger does not settle."""
    known = file_states(listing.sparkSession, table_path).select("source_file", F.col("state").alias("_s"), F.col("length").alias("_l"))
    out = listing.join(known, "source_file", "left")
    return out.where(F.col("_s").isNull() | ((F.col("_s") == "corrupt") & ~F.col("_l").eqNullSafe(F.col("length")))) \
        .select(*listing.columns)


def load_dates(spark: SparkSession, table_path: str, version: int | None = None) -> DataFrame:
    """The ``date`` actions that make up the visible table: one row per (load, date)."""
    state = snapshot(spark, table_path, version)
    rows = log(spark, table_path).where(F.col("action") == "date")
    hidden = state.hidden()
    rows = rows.where(F.col("load_id").isin(sorted(state.loads)))
    return rows.where(~_literal_in(hidden)) if hidden else rows


def date_actions(rows: DataFrame, load_id: str) -> DataFrame:
    """What a load holds of each date; the sketch of distinct domains can be merged over loads."""
    return rows.groupBy("processing_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("source_file").alias("n_files"),
        F.min("loaded_at").alias("first_loaded"), F.max("loaded_at").alias("last_loaded"),
        F.hll_sketch_agg("domain").alias("domains")).withColumn("action", F.lit("date")).withColumn("load_id", F.lit(load_id))


def write_raw(rows: DataFrame, folder: str) -> None:
    """Write one load's rows, partitioned by date and laid out for the scans that follow.

    REBALANCE lets AQE split a hot date into several tasks and merge small ones.
    Each file is sorted by date, ``source_file``, then ``count_views`` descending
    (the writer itself asks for the partition column first, so the order holds in
    the files), so Parquet row-group statistics let stage A (``count_views >= n``)
    and per-file checks skip most row groups.
    """
    (rows.hint("rebalance", "processing_date")
     .sortWithinPartitions("processing_date", "source_file", F.col("count_views").desc())
     .write.mode("overwrite").partitionBy("processing_date").parquet(folder))


def load_rows(spark: SparkSession, table_path: str, load_id: str) -> DataFrame:
    """The rows one load wrote."""
    return spark.read.schema(schemas.RAW_PAGEVIEWS).parquet(folder(table_path, load_id))


# --------------------------------------------------------------------------- maintenance

def compact(spark: SparkSession, table_path: str, load_id: str | None = None, least: int = 2) -> int:
    """Swap all visible load folders for one in a single commit; returns how many were replaced.

    What a compaction that broke off left behind is no part of the table. Rows of
    dropped dates are not copied; a date dropped meanwhile stays hidden, as the new
    folder counts as old as the version it was read at.
    """
    state = snapshot(spark, table_path)
    if len(state.loads) < least:
        return 0
    load_id = load_id or f"compact-{uuid.uuid4().hex}"
    write_raw(read_table(spark, table_path, state.version), folder(table_path, load_id))
    old = spark.createDataFrame([(load_id, name) for name in sorted(state.loads)], "load_id string, replaces string")
    commit(spark, table_path, one(spark, action="compact", load_id=load_id, n_rows=state.version),
           old.withColumn("action", F.lit("replace")), date_actions(load_rows(spark, table_path, load_id), load_id))
    return len(state.loads)


def drop_dates(spark: SparkSession, table_path: str, dates) -> int:
    """Drop whole dates in one commit: from its version on, no reader sees a row of theirs loaded before."""
    days = sorted(set(dates))
    if not days:
        return 0
    found = spark.createDataFrame([(d,) for d in days], "processing_date date")
    commit(spark, table_path, found.withColumn("action", F.lit("drop")))
    return len(days)


def drop_expired(spark: SparkSession, table_path: str, as_of, days: int = 90) -> list:
    """K7: drop the dates past retention, found in the manifest; returns them. ``vacuum`` deletes their files."""
    cutoff = F.date_sub(F.lit(as_of).cast("date"), int(days))
    old = load_dates(spark, table_path).where(F.col("processing_date") < cutoff).select("processing_date").distinct()
    dates = sorted(r[0] for r in old.collect())  # dates
    drop_dates(spark, table_path, dates)
    return dates


def vacuum(spark: SparkSession, table_path: str) -> list[str]:
    """Delete the folders of replaced loads and of dropped dates; returns them. Repeating a broken run is safe."""
    state = snapshot(spark, table_path)
    paths = [folder(table_path, name) for name in state.gone]
    paths += [f"{folder(table_path, name)}/processing_date={day}" for name, day in state.hidden()]
    for path in paths:
        delete_path(spark, path)
    return paths


# --------------------------------------------------------------------------- metrics without a scan

def raw_metrics(spark: SparkSession, table_path: str) -> DataFrame:
    """Per date: raw_records, first/last_loaded, source_files (exact) and domains (from the merged sketches).

    Read from the manifest alone. A file belongs to one load, so the loads' distinct files of a date add up.
    """
    return load_dates(spark, table_path).groupBy("processing_date").agg(
        F.sum("n_rows").alias("raw_records"), F.min("first_loaded").alias("first_loaded"),
        F.max("last_loaded").alias("last_loaded"), F.sum("n_files").alias("source_files"),
        F.hll_sketch_estimate(F.hll_union_agg("domains")).alias("approx_domains"))
