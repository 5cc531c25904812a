"""Session helpers: a tuned local session for tests/bench and the shared scratch root.

On a cluster the caller owns the session; nothing here overrides its settings.
The scratch root for written tables and lineage cuts is the cluster's
``spark.checkpoint.dir``. Only a local session without that setting gets a
fresh ``mktemp`` folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package (see README "Scale").
SESSION_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # An external scorer must never be called twice for one batch.
    "spark.speculation": "false",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, app: str = "viewsift") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("VIEWSIFT_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). When both
    are unset, a local session gets its own ``mktemp`` folder; a cluster session
    must name a shared folder, as a machine-local one would break on executor loss.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) for this cluster")
        root = tempfile.mkdtemp(prefix="viewsift-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder under the scratch root (one per run, never reused)."""
    return f"{scratch_root(spark)}/viewsift/{name}-{uuid.uuid4().hex[:12]}"


_SCRATCH: dict[str, list[str]] = {}


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file system layer (any store it reads)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_mark(spark: SparkSession) -> int:
    """How many intermediate tables this application has written so far (see ``drop_scratch``)."""
    return len(_SCRATCH.get(spark.sparkContext.applicationId, []))


def drop_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables (``materialize``) written after mark ``since``; returns how many.

    For a job's end, when nothing reads results built on them any more.
    """
    paths = _SCRATCH.get(spark.sparkContext.applicationId, [])
    gone = paths[since:]
    del paths[since:]
    for path in gone:
        delete_path(spark, path)
    return len(gone)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in a fresh folder of the scratch root and read it back.

    Cuts lineage like a reliable checkpoint, but runs the plan once (an eager
    ``checkpoint()`` computes it, then recomputes it to write), and the table
    survives lost executors. Column values (not partition layout) carry state.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.parquet(path)


def filesystem(path: str):
    """(pyarrow filesystem, path inside it) for a Spark path: local, HDFS, S3, GCS, ABFS.

    Used inside tasks that must touch files directly (gzip audit, dump writer), so
    they work on the cluster's shared storage and not only on a local disk.
    """
    import pyarrow.fs as pafs

    for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if path.startswith(hadoop):
            path = arrow + path[len(hadoop):]
    return pafs.FileSystem.from_uri(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``viewsift`` importable in Python workers (``addPyFile`` of a zip, once per app).

    The few Python tasks (scorer, gzip audit, dump writer) run functions of this
    package; workers import them by module name, as with ``--py-files``.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="viewsift-pyfiles-"), "viewsift.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(pkg):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
