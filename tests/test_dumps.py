"""Dump parsing edge cases (D1–D3), strict mode, null tokens and the gzip audit."""

import gzip
import os
import tempfile

import pytest

from viewsift.sources import dumps

LINES = ["en iPhone 50 0", "en.m AWS 12", "", "en Bad Title x 9 0", "en Foo abc 0", "en OnlyTwo",
         "en NaN 3 0", 'en "Quoted 7 0', "en Neg -4 0"]


@pytest.fixture(scope="module")
def landing():
    d = tempfile.mkdtemp(prefix="viewsift-dumps-")
    with gzip.open(os.path.join(d, "pageviews-20240130-120000.gz"), "wt") as fh:
        fh.write("\n".join(LINES) + "\n")
    with open(os.path.join(d, "pageviews-20240130-130000.gz"), "wb") as fh:
        fh.write(b"not gzip at all")
    good_only = tempfile.mkdtemp(prefix="viewsift-dumps-good-")
    with gzip.open(os.path.join(good_only, "pageviews-20240130-120000.gz"), "wt") as fh:
        fh.write("\n".join(LINES) + "\n")
    return d, good_only


def test_parse_keeps_good_lines_and_quarantines_bad(spark, landing):
    _, d = landing
    good, bad = dumps.parse_dumps(spark, d)
    rows = sorted((r.domain, r.page_title, r.count_views, r.source_file) for r in good.collect())
    f = "pageviews-20240130-120000.gz"
    assert rows == sorted([("en", "iPhone", 50, f), ("en.m", "AWS", 12, f), ("en", "NaN", 3, f),
                           ("en", '"Quoted', 7, f)])
    reasons = sorted((r.line, r.reason) for r in bad.collect())
    assert reasons == sorted([("en Bad Title x 9 0", "field_count"), ("en Foo abc 0", "count_not_integer"),
                              ("en OnlyTwo", "field_count"), ("en Neg -4 0", "negative_count")])


def test_strict_raises(spark, landing):
    _, d = landing
    good, _ = dumps.parse_dumps(spark, d, strict=True)  # lazy: the query that reads the rows fails
    with pytest.raises(Exception, match="malformed dump line"):
        good.collect()


def test_null_tokens(spark):
    df = spark.createDataFrame([("en", "NaN"), ("en", None), ("en", ""), ("en", "Real")], "domain string, page_title string")
    keep = [r.page_title for r in dumps.fill_unknown(df).orderBy("page_title").collect()]
    assert sorted(keep) == sorted(["NaN", "unknown", "unknown", "Real"])
    pandas_like = [r.page_title for r in dumps.fill_unknown(df, pandas_null_tokens=True).collect()]
    assert sorted(pandas_like) == sorted(["unknown", "unknown", "unknown", "Real"])


def test_gz_audit_flags_corrupt(spark, landing):
    d, _ = landing
    res = {os.path.basename(r.path): r.status for r in dumps.gz_audit(spark, d).collect()}
    assert res == {"pageviews-20240130-120000.gz": "ok", "pageviews-20240130-130000.gz": "corrupt"}


def test_write_then_parse_round_trip(spark):
    rows = spark.createDataFrame([("en", "A", 1, "pageviews-20240101-000000.gz"),
                                  ("en.m", "B", 2, "pageviews-20240101-000000.gz"),
                                  ("en", "C", 3, "pageviews-20240101-010000.gz")],
                                 "domain string, page_title string, count_views int, source_file string")
    d = tempfile.mkdtemp(prefix="viewsift-rt-")
    assert dumps.write_dump_files(rows, d) == 2
    good, bad = dumps.parse_dumps(spark, d)
    assert sorted(tuple(r) for r in good.collect()) == sorted(tuple(r) for r in rows.collect())
    assert bad.count() == 0
