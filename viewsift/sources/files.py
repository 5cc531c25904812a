"""CSV and JSON files and CSV held in strings.

Files are read with explicit schemas (no inference pass over the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# A quote inside a quoted field is doubled, as CSV readers elsewhere (pandas included) expect.
QUOTING = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """K3: CSV with a header line (one file per task)."""
    df.write.mode(mode).options(header=True, **QUOTING).csv(path)


def export_csv(df: DataFrame, root: str, prefix: str, at=None) -> str:
    """CSV export into ``{root}/{prefix}_{YYYYMMDD_HHmmss}``; returns the folder."""
    import datetime as dt

    stamp = (at or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")
    path = f"{root.rstrip('/')}/{prefix}_{stamp}"
    write_csv(df, path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S3: CSV with header and an explicit schema; malformed rows fail the read."""
    return spark.read.schema(schema).options(header=True, mode="FAILFAST", **QUOTING).csv(path)


# Microsecond timestamps: the writer's default keeps milliseconds only.
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """K4: JSON Lines, UTF-8, timestamps with microseconds."""
    df.write.mode(mode).option("encoding", "UTF-8").option("timestampNTZFormat", TS_NTZ_FORMAT).json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return (spark.read.schema(schema).option("mode", "FAILFAST")
            .option("timestampNTZFormat", TS_NTZ_FORMAT).json(path))


def _schema(schema: T.StructType | str) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T._parse_datatype_string(schema)


def csv_text_column(rows: DataFrame, group_cols: list[str], columns: list[str],
                    order_cols: list[str] | None = None) -> DataFrame:
    """CSV text (header + one line per row) per group, built natively.

    ``to_csv(struct)`` renders each row with CSV quoting; lines are joined per
    group in ``order_cols`` order. Groups must be bounded (here: scorer batches).
    """
    order_cols = order_cols or columns
    line = F.to_csv(F.struct(*[F.col(c) for c in columns]), QUOTING)
    keyed = F.struct(*[F.col(c) for c in order_cols], line.alias("_line"))
    agg = rows.groupBy(*group_cols).agg(F.sort_array(F.collect_list(keyed)).alias("_lines"))
    header = ",".join(columns)
    text = F.concat(F.lit(header + "\n"),
                    F.array_join(F.transform("_lines", lambda s: s["_line"]), "\n"), F.lit("\n"))
    return agg.select(*group_cols, text.alias("csv_text"))


def parse_csv_text(df: DataFrame, text_col: str, schema: T.StructType | str) -> DataFrame:
    """Rows of CSV held in a string column (first line = header), other columns carried.

    Lines are split and exploded, the header line is dropped, and each line is
    parsed with ``from_csv`` against the explicit schema; a malformed line fails the
    query (as in ``read_csv``). Fields hold no line breaks. Empty text gives no rows
    (C6: the empty-input path).
    """
    st = _schema(schema)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in st.fields)
    carried = [c for c in df.columns if c != text_col]
    lines = df.select(*carried, F.posexplode(F.split(F.col(text_col), "\r?\n")).alias("_pos", "_line"))
    lines = lines.where((F.col("_pos") > 0) & (F.col("_line") != ""))
    parsed = lines.select(*carried, "_pos", F.from_csv(F.col("_line"), ddl, {**QUOTING, "mode": "FAILFAST"}).alias("_r"))
    return parsed.select(*carried, F.col("_pos").alias("line_no"), *[F.col(f"_r.{f.name}").alias(f.name)
                                                                      for f in st.fields])
