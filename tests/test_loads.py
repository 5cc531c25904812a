"""Loads: idempotent raw load (D11), curated unique key modes (K2), zero-row guard (C5), checks."""

import datetime as dt
import tempfile

import pytest

from viewsift.operators import curate, prefilter, quality
from viewsift.sources import warehouse

TS = dt.datetime(2024, 1, 30, 1)
D = dt.date(2024, 1, 30)


def raw(spark, rows):
    return spark.createDataFrame(rows, "domain string, page_title string, count_views int, source_file string, "
                                       "loaded_at timestamp_ntz, processing_date date")


def test_raw_load_is_idempotent_per_file(spark):
    path = tempfile.mkdtemp(prefix="viewsift-raw-") + "/t"
    a = raw(spark, [("en", "A", 1, "f1", TS, D), ("en", "B", 2, "f1", TS, D)])
    assert curate.raw_load(spark, a, path) == 2
    assert curate.raw_load(spark, a, path) == 0
    b = raw(spark, [("en", "A", 1, "f1", TS, D), ("en", "C", 3, "f2", TS, D)])
    assert curate.raw_load(spark, b, path) == 1
    assert warehouse.raw_table(spark, path).count() == 3
    assert sorted((r.source_file, r.n_rows) for r in curate.commits(spark, path).collect()) == [("f1", 2), ("f2", 1)]


def test_broken_load_is_invisible_and_loaded_again(spark):
    path = tempfile.mkdtemp(prefix="viewsift-raw-") + "/t"
    rows = raw(spark, [("en", t, i, "f1", TS, D) for i, t in enumerate("ABCDE")])
    curate.write_raw(rows.where("count_views < 2"), f"{path}/load_id=broken")
    assert warehouse.raw_table(spark, path).count() == 0
    assert curate.raw_load(spark, rows, path, "retry") == 5
    assert warehouse.raw_table(spark, path).count() == 5
    assert curate.raw_load(spark, rows, path, "retry") == 0  # the same load again


def test_raw_load_reads_no_history(spark):
    path = tempfile.mkdtemp(prefix="viewsift-raw-") + "/t"
    a = raw(spark, [("en", "A", 1, "f1", TS, D)])
    curate.raw_load(spark, a, path)
    plan = curate.drop_loaded_files(spark, a, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "t_commits" in plan  # the manifest's file names, no raw rows
    assert "ReadSchema: struct<action:string,source_file:string,state:string>" in plan


def curated(spark, rows):
    return spark.createDataFrame(rows, "domain string, page_title string, count_views int, company string, "
                                       "filtered_at timestamp_ntz, processing_date date, filter_method string")


def test_curated_duplicate_modes(spark):
    rows = curated(spark, [("en", "A", 1, "X", TS, D, "m"), ("en", "A", 5, "X", TS, D, "m"),
                           ("en", "B", 2, "X", TS, D, "m")])
    with pytest.raises(curate.DuplicateKeyError):
        curate.prepare_curated(rows, "error").count()
    assert sorted((r.page_title, r.count_views) for r in curate.prepare_curated(rows, "max").collect()) == \
        [("A", 5), ("B", 2)]
    assert sorted((r.page_title, r.count_views) for r in curate.prepare_curated(rows, "sum").collect()) == \
        [("A", 6), ("B", 2)]
    path = tempfile.mkdtemp(prefix="viewsift-cur-") + "/t"
    for _ in range(2):  # the second load replaces the same date
        assert curate.curated_load(spark, rows, path, on_duplicate="max") == 2
    assert sorted((r.page_title, r.count_views) for r in spark.read.parquet(path).collect()) == [("A", 5), ("B", 2)]


def test_curated_error_mode_sees_a_second_value_over_two_loads(spark):
    path = tempfile.mkdtemp(prefix="viewsift-cur-") + "/t"
    first = curated(spark, [("en", "A", 1, "X", TS, D, "m")])
    assert curate.curated_load(spark, first, path, on_duplicate="error") == 1
    both = first.unionByName(curated(spark, [("en", "A", 9, "X", TS, D, "m")]))
    with pytest.raises(curate.DuplicateKeyError):
        curate.curated_load(spark, both, path, on_duplicate="error")
    assert spark.read.parquet(path).count() == 1


def test_curated_date_left_without_rows_goes(spark):
    path = tempfile.mkdtemp(prefix="viewsift-cur-") + "/t"
    other = dt.date(2024, 1, 29)
    rows = curated(spark, [("en", "A", 1, "X", TS, D, "m"), ("en", "A", 1, "X", TS, other, "m")])
    curate.curated_load(spark, rows, path)
    assert curate.curated_load(spark, rows.where("false"), path, dates=[D]) == 0
    assert [r.processing_date for r in spark.read.parquet(path).collect()] == [other]


def test_dedupe_keeps_best_under_skew(spark):
    df = spark.range(30000).selectExpr("'hot' AS k", "CAST(id % 1000 AS INT) AS v", "id AS tie")
    best = curate.dedupe_keep_best(df, ["k"], desc=["v"], asc=["tie"]).first()
    assert (best.v, best.tie) == (999, 999)


def test_zero_row_guard(spark):
    r = raw(spark, [("en", "Apple", 5, "f", TS, D)])
    with pytest.raises(prefilter.PrefilterError):
        prefilter.prefilter(r, D, require_rows=True)


def test_key_and_constraint_violations(spark):
    rows = curated(spark, [("en", "A", -1, "X", TS, D, "m"), ("en", "A", 5, "X" * 60, TS, D, "m")])
    kv = quality.key_violations(rows, ["domain", "page_title", "processing_date", "filter_method"]).collect()
    assert [r.n_rows for r in kv] == [2]
    cv = {r.rule: r.violations for r in quality.constraint_violations(rows, "filtered_pageviews").collect()}
    assert cv["negative_count_views"] == 1 and cv["company_too_long"] == 1 and cv["null_domain"] == 0


def test_extract_checks_old_and_new_names(spark):
    old = spark.createDataFrame([("en", "A", 1)], "domain_code string, page_title string, count_views int")
    r = quality.extract_checks(old).first()
    assert r.has_required_columns and r.count_views_integer and r.passed
    bad = spark.createDataFrame([("en", "A", "1")], "domain string, page_title string, count_views string")
    assert not quality.extract_checks(bad).first().passed
