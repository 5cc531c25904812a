"""Hourly pageview dumps: read, parse, audit (S1, S2, S9) and write (fixture side).

A dump line is ``domain_code page_title count_views total_response_size``,
space-separated, gzip, no header and no quoting. Spark reads ``.gz`` text
natively; each gzip file is one task (not splittable), so parallelism comes from
many files, and Spark packs small files into shared tasks.

Parsing is a built-in ``split`` + ``try_cast`` (no CSV reader: D2 explains why
``DROPMALFORMED`` loses good 3-field lines and keeps bad ones once columns are
pruned). A line is good when it has 3 or 4 fields, non-empty domain and title,
and an integer ``count_views >= 0``; blank lines are ignored; every other line
goes to a quarantine frame with its reason (D1). ``strict=True`` makes the rows'
own query fail on a malformed line.
"""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewsift.session import filesystem, ship_package

# Tokens pandas reads as missing by default (P5 ``pandas_null_tokens``).
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
UNKNOWN = "unknown"


def read_dump_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of one or many dump files with their ``source_file`` (file name)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths).select(
        F.col("value"), F.col("_metadata.file_name").alias("source_file"))


def _classified(lines: DataFrame, value_col: str = "value", odd: Column | None = None) -> DataFrame:
    parts = F.split(F.col(value_col), " ")
    n = F.size(parts)
    # ``get`` is null-safe past the end (ANSI mode raises on element_at / [i]).
    count = F.get(F.col("_parts"), 2).try_cast("int")
    reason = F.when(F.trim(F.col(value_col)) == "", F.lit("blank"))
    if odd is not None:
        reason = reason.when(odd, F.lit("file_name"))
    reason = (reason.when(~F.col("_n").isin(3, 4), F.lit("field_count"))
              .when((F.get(F.col("_parts"), 0) == "") | (F.get(F.col("_parts"), 1) == ""), F.lit("empty_field"))
              .when(F.col("_count").isNull(), F.lit("count_not_integer"))
              .when(F.col("_count") < 0, F.lit("negative_count")))
    return (lines.withColumn("_parts", parts).withColumn("_n", n)
            .withColumn("_count", count).withColumn("_reason", reason))


def parse_dump_lines(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) from a frame of dump lines; other columns are carried."""
    return split_classified(classify_dump_lines(lines, value_col))


def classify_dump_lines(lines: DataFrame, value_col: str = "value", odd: Column | None = None) -> DataFrame:
    """One row per line: the fields of a good one, or the ``line`` of another one and its ``reason``.

    Where ``odd`` holds, no line of the file counts as good (reason ``file_name``).
    """
    extra = [c for c in lines.columns if c != value_col]
    c = _classified(lines, value_col, odd)
    good = F.col("_reason").isNull()
    return c.select(  # blank lines are left to the readers: their filter would parse the lines once more before a rebalance
        F.when(good, F.get(F.col("_parts"), 0)).alias("domain"),
        F.when(good, F.get(F.col("_parts"), 1)).alias("page_title"),
        F.when(good, F.col("_count")).alias("count_views"),
        *extra,
        F.when(~good, F.col(value_col)).alias("line"), F.col("_reason").alias("reason"))


def split_classified(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine) of ``classify_dump_lines``."""
    names = [c for c in classified.columns if c not in ("line", "reason")]
    good = classified.where(F.col("reason").isNull()).select(*names)
    bad = classified.where(F.col("reason") != "blank").select(*names[3:], "line", "reason")
    return good, bad


def parse_dumps(spark: SparkSession, paths: str | Sequence[str], strict: bool = False,
                repartition: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse dump files into (domain, page_title, count_views, source_file) + quarantine."""
    lines = read_dump_lines(spark, paths)
    if repartition:
        lines = lines.repartition(int(repartition))  # spread one huge file's parse
    if strict:
        return _strict_rows(lines), parse_dump_lines(lines)[1]
    return parse_dump_lines(lines)


def _strict_rows(lines: DataFrame) -> DataFrame:
    """The rows of the lines; a malformed line fails the query that reads them, in the same pass."""
    c = _classified(lines).where(F.col("_reason").isNull() | (F.col("_reason") != "blank"))
    message = F.concat(F.lit("malformed dump line ("), F.col("_reason"), F.lit(") in "), "source_file", F.lit(": "), "value")
    count = F.when(F.col("_reason").isNull(), F.col("_count")).otherwise(F.raise_error(message).cast("int"))
    return c.select(F.get(F.col("_parts"), 0).alias("domain"), F.get(F.col("_parts"), 1).alias("page_title"),
                    count.alias("count_views"), "source_file")


def fill_unknown(df: DataFrame, columns: Sequence[str] = ("domain", "page_title"),
                 pandas_null_tokens: bool = False) -> DataFrame:
    """P5: missing values become ``'unknown'``.

    By default only NULL or empty strings are missing (D3: real titles such as
    ``NaN`` are kept). ``pandas_null_tokens=True`` also maps pandas' default NA
    tokens, reproducing the original loader.
    """
    out = df
    for c in columns:
        col = F.col(c)
        missing = col.isNull() | (col == "")
        if pandas_null_tokens:
            missing = missing | col.isin(PANDAS_NULL_TOKENS)
        out = out.withColumn(c, F.when(missing, F.lit(UNKNOWN)).otherwise(col))
    return out


# --------------------------------------------------------------------------- audit

def _audit_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for path, length in zip(pdf["path"], pdf["length"]):
            status, error, first_line, lines = "ok", None, None, None
            try:
                fs, p = filesystem(path)
                with fs.open_input_stream(p, compression=None) as raw:
                    magic = raw.read(2)
                if magic != b"\x1f\x8b":
                    status, error = "corrupt", "not a gzip file (magic bytes)"
                else:
                    with fs.open_input_stream(p, compression=None) as raw, gzip.GzipFile(fileobj=raw) as gz:
                        head = gz.readline()  # one dump line, whole
                        first_line = head.decode("utf-8", "replace").rstrip("\n")
                        lines, last = head.count(b"\n"), head[-1:]
                        while chunk := gz.read(1 << 20):  # stream to the end: CRC and length checked
                            lines += chunk.count(b"\n")
                            last = chunk[-1:]
                        lines += 1 if last not in (b"", b"\n") else 0  # a last line without newline
            except (OSError, EOFError, zlib.error) as e:
                status, error = "corrupt", f"{type(e).__name__}: {e}"
            out.append((path, path.rstrip("/").rsplit("/", 1)[-1], int(length), status, error, first_line, lines))
        yield pd.DataFrame(out, columns=["path", "file_name", "length", "status", "error", "first_line", "lines"])


AUDIT_SCHEMA = ("path string, file_name string, length long, status string, error string, first_line string, "
                "lines long")


def list_files(spark: SparkSession, directory: str | Sequence[str], glob: str = "*") -> DataFrame:
    """path, source_file (file name) and length of the files of one or many folders; contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(directory))
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("source_file"), "length")


def gz_audit(spark: SparkSession, directory: str | Sequence[str], glob: str = "*.gz") -> DataFrame:
    """One row per file: gzip magic, full-stream integrity, first line, line count.

    The ``binaryFile`` scan selects only path and length, so file contents never
    enter the plan; each task streams its files with bounded memory.
    """
    ship_package(spark)
    return list_files(spark, directory, glob).select("path", "length").mapInPandas(_audit_files, AUDIT_SCHEMA)


# --------------------------------------------------------------------------- writing (fixtures)

def _write_dump_files(target: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(target)
        fs.create_dir(root, recursive=True)
        state = {"name": None, "raw": None, "gz": None, "tmp": None}
        written: list[str] = []

        def close():
            if state["gz"] is not None:
                state["gz"].close()
                state["raw"].close()
                # a hidden temporary name, then a move: readers never see half a file and a
                # retried task simply writes the file again
                fs.move(state["tmp"], f"{root}/{state['name']}")
                written.append(state["name"])

        for pdf in batches:
            for name, own in groupby(zip(pdf["source_file"], pdf["line"]), key=itemgetter(0)):
                if name != state["name"]:
                    close()
                    tmp = f"{root}/.{name}.{uuid.uuid4().hex}.tmp"
                    raw = fs.open_output_stream(tmp, compression=None)
                    state.update(name=name, raw=raw, tmp=tmp, gz=gzip.GzipFile(fileobj=raw, mode="wb", compresslevel=6))
                state["gz"].write("".join([line + "\n" for _, line in own]).encode("utf-8"))
        close()
        yield pd.DataFrame({"source_file": written})

    return run


def write_dump_files(rows: DataFrame, target: str, n_tasks: int | None = None) -> int:
    """Write rows as gzip dump files named by their ``source_file``; returns the number of files."""
    line = F.concat_ws(" ", "domain", "page_title", F.col("count_views").cast("string"), F.lit("0"))
    return write_dump_lines(rows.select("source_file", line.alias("line")), target, n_tasks)


def write_dump_lines(lines: DataFrame, target: str, n_tasks: int | None = None) -> int:
    """Write (source_file, line) rows as gzip files, one per name.

    Rows are hash-partitioned by ``source_file`` and sorted inside each task, so a
    task streams each of its files out once.
    """
    ship_package(lines.sparkSession)
    df = lines.select("source_file", "line")
    df = (df.repartition(n_tasks, "source_file") if n_tasks else df.repartition("source_file"))
    df = df.sortWithinPartitions("source_file")
    return df.mapInPandas(_write_dump_files(target), "source_file string").count()
