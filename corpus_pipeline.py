"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, BPE encoding.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the rows its successor works on. Each stage's rows are written as
Parquet and read again, which cuts lineage: a lost executor repeats tasks of one
stage only. All stages but the last return the columns of ``documents``.

Defined cases are those of the stages' operators; an empty table passes through
as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewsift.llm import bpe, line_dedup, mixing, quality, simhash
from viewsift.session import materialize, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    ship_package(spark)
    return quality.apply_policy(quality.rule_ledger(docs)).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; ``n_chars`` counts what is left."""
    ship_package(spark)
    out = line_dedup.line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ship_package(spark)
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the sources' target weights, in a global random order."""
    ship_package(spark)
    return mixing.mix(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, checked by decoding them again."""
    ship_package(spark)
    out = bpe.bpe_round_trip(docs)
    return out.select("doc_id", "lang", "source", "n_tokens", "ids",
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", dedup_lines), ("simhash_near_dedup", near_dedup),
          ("source_mixing", mix_sources), ("bpe", encode)]

#: SimHash components and BPE merges cannot be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
