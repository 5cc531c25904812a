"""Properties: stage C ⊆ B ⊆ A, shares total 100, curated keys unique, results stable under repartition."""

import datetime as dt

from pyspark.sql import functions as F

from viewsift.operators import prefilter
from viewsift.plans import analytics as A
from viewsift.sources import testbed as tb

SF = "/root/testdata/sf0.01"
D = tb.AS_OF


def keyset(df):
    return {tuple(r) for r in df.collect()}


def test_stages_nest(spark):
    raw = tb.raw_pageviews(spark, SF, with_event_id=False)
    a = prefilter.stage_a(raw, D)
    b = prefilter.stage_b(a)
    c = prefilter.stage_c(b)
    ka, kb, kc = keyset(a), keyset(b), keyset(c)
    assert kc <= kb <= ka and len(kc) > 0


def test_shares_total_100(spark):
    rows = A.rankings_window(tb.filtered_pageviews(spark, SF), D, 30).collect()
    assert abs(sum(r.market_share_pct for r in rows) - 100.0) <= 0.01 * len(rows)


def test_curated_keys_unique(spark):
    f = tb.filtered_pageviews(spark, SF)
    assert f.groupBy("domain", "page_title", "processing_date", "filter_method").count().where("count > 1").count() == 0


def test_unchanged_under_repartition(spark):
    f = tb.filtered_pageviews(spark, SF)
    base = keyset(A.company_rankings(f, D))
    assert keyset(A.company_rankings(f.repartition(13, "page_title"), D)) == base
    assert keyset(A.company_rankings(f.repartition(1), D)) == base
