"""The pipeline's stages against brute force, each on its predecessor's rows, and the guard around the subpackage."""

import os
import sys

from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(os.path.dirname(HERE))]
import cases  # noqa: E402
import corpus_pipeline  # noqa: E402
from test_lines_and_quality import brute_lines, brute_measures  # noqa: E402
from test_simhash import brute_near_dedup  # noqa: E402

from viewsift.llm import mixing  # noqa: E402
from viewsift.session import materialize  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def run_stages(spark, docs):
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], "unused"), "test-" + name))
    return seen


def test_stages_on_a_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    given, good, lines, single, mixed, tokens = run_stages(spark, docs)
    for stage in (good, lines, single, mixed):
        assert stage.columns == COLUMNS
    data = given.collect()
    kept = {r.doc_id for r in good.collect()}
    for r in data:
        words, _, _, _, repeated = brute_measures(r.text)
        if words < 10 or 100 * repeated > 20 * words:
            assert r.doc_id not in kept
    assert len(kept) > 0.6 * len(data)
    want = sorted((d, t) for d, _, _, t in brute_lines([(r.doc_id, r.text) for r in good.collect()]))
    assert sorted((r.doc_id, r.text) for r in lines.collect()) == want
    assert lines.where(F.col("n_chars") != F.length("text")).count() == 0
    assert sorted(((r.doc_id, r.text) for r in single.collect()), key=str) == brute_near_dedup([(r.doc_id, r.text) for r in lines.collect()])
    copies = mixing.mix(single)
    assert rows_of(mixed) == rows_of(copies.select(*COLUMNS))
    assert tokens.count() == mixed.count()
    check = tokens.select("doc_id", "decoded_sha256").distinct().join(
        mixed.select("doc_id", F.sha2("text", 256).alias("want")).distinct(), "doc_id")
    assert check.where("decoded_sha256 <> want").count() == 0


def test_hand_made_rows_and_clashing_columns_pass(spark):
    docs = cases.frame(spark).withColumn("failed", F.lit("x")).withColumn("copy", F.lit(1)).withColumn("n_lines", F.lit(None).cast("int"))
    good, lines, single = run_stages_until(spark, docs, 3)
    assert set(good.columns) == set(docs.columns)
    assert single.count() <= lines.count() == good.count()


def run_stages_until(spark, docs, n):
    out = []
    for name, stage in corpus_pipeline.STAGES[:n]:
        docs = stage(spark, docs, "unused")
        out.append(docs)
    return out


def test_empty_table_passes_through(spark):
    last = run_stages(spark, cases.frame(spark, []))[-1]
    assert last.count() == 0 and "ids" in last.columns
