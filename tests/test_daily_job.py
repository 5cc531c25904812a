"""The daily job end to end on dumps written from the sf0.001 testbed."""

import tempfile

from viewsift.plans import daily_job
from viewsift.sources import dumps, testbed as tb, warehouse

SF = "/root/testdata/sf0.001"


def test_run_daily_equals_testbed_curation(spark):
    root = tempfile.mkdtemp(prefix="viewsift-daily-")
    landing = root + "/landing"
    dumps.write_dump_files(tb.raw_pageviews(spark, SF, with_event_id=False), landing)
    res = daily_job.run_daily(spark, landing, root + "/wh", as_of=None, event_time_from_name=True)
    assert res.raw_rows_loaded == 1000 and res.quarantined_lines == 0
    cur = warehouse.curated_table(spark, root + "/wh/filtered_pageviews")
    cols = ["domain", "page_title", "processing_date", "count_views", "company"]
    got = sorted(map(tuple, cur.select(*cols).collect()))
    want = sorted(map(tuple, tb.filtered_pageviews(spark, SF).select(*cols).collect()))
    assert got == want and res.curated_rows_loaded == len(want)
    # no duplicate keys at this scale, so every kept record is curated
    assert res.stats["input_records"] == tb.candidates(spark, SF).count()
    assert res.stats["output_records"] == len(want) > 500
    again = daily_job.run_daily(spark, landing, root + "/wh", as_of=None, event_time_from_name=True)
    assert again.raw_rows_loaded == 0 and again.curated_rows_loaded == 0
    views = daily_job.dashboard(warehouse.raw_table(spark, root + "/wh/raw_pageviews"), cur, tb.AS_OF)
    assert views["quality"].count() == 30 and views["overview"].count() == 1
    stored = daily_job.dashboard(warehouse.raw_table(spark, root + "/wh/raw_pageviews"), cur, tb.AS_OF, raw_path=root + "/wh/raw_pageviews")
    assert stored["quality"].collect() == views["quality"].collect()


def test_run_daily_audit_skips_corrupt_files(spark):
    import os

    root = tempfile.mkdtemp(prefix="viewsift-daily-audit-")
    landing = root + "/landing"
    rows = spark.createDataFrame([("en", "iPhone_15", 5000, "pageviews-20240130-100000.gz")],
                                 "domain string, page_title string, count_views int, source_file string")
    dumps.write_dump_files(rows, landing)
    with open(os.path.join(landing, "pageviews-20240130-110000.gz"), "wb") as fh:
        fh.write(b"\x1f\x8b broken")
    res = daily_job.run_daily(spark, landing, root + "/wh", event_time_from_name=True, audit=True)
    assert res.raw_rows_loaded == 1 and res.curated_rows_loaded == 1
    bad = spark.read.parquet(root + "/wh/corrupt_files").collect()
    assert [r.file_name for r in bad] == ["pageviews-20240130-110000.gz"]


def test_split_runs_give_the_same_curated_table(spark):
    """Hour 0 then hour 1 of one day, for both duplicate modes, equals one run over both."""
    import pytest

    schema = "domain string, page_title string, count_views int, source_file string"
    hours = [spark.createDataFrame([("en", "Google_Maps", v, f"pageviews-20240130-{h:02d}0000.gz")], schema)
             for h, v in ((0, 2000), (1, 9000))]
    for mode, want in (("max", 9000), ("sum", 11000)):
        root = tempfile.mkdtemp(prefix="viewsift-split-")
        for rows in hours:
            dumps.write_dump_files(rows, root + "/landing")
            res = daily_job.run_daily(spark, root + "/landing", root + "/wh", event_time_from_name=True, on_duplicate=mode)
            assert res.raw_rows_loaded == 1 and [r.record_count for r in res.verified] == [1]
        cur = warehouse.curated_table(spark, root + "/wh/filtered_pageviews").collect()
        assert [(r.page_title, r.count_views) for r in cur] == [("Google_Maps", want)]
    dumps.write_dump_lines(spark.createDataFrame([("pageviews-20240131-000000.gz", "en broken")], "source_file string, line string"),
                           root + "/bad")
    with pytest.raises(daily_job.LoadCheckError):
        daily_job.run_daily(spark, root + "/bad", root + "/wh2", event_time_from_name=True)


def test_title_search_folds_every_alphabet(spark):
    import datetime as dt

    from viewsift.plans import analytics as A

    rows = [("en", "Google_ÉCOLE", 5, "Google", dt.datetime(2024, 1, 30), dt.date(2024, 1, 30), "m")]
    df = spark.createDataFrame(rows, "domain string, page_title string, count_views int, company string, "
                                     "filtered_at timestamp_ntz, processing_date date, filter_method string")
    assert A.title_search(df, tb.AS_OF, "école").count() == 1 == A.title_search(df, tb.AS_OF, "école", literal=True).count()


def test_verdict_borders_do_not_depend_on_accents(spark):
    import duckdb
    from pyspark.sql import functions as F

    from viewsift.functions import rules

    titles = ["Apple_cupé", "Apple_cup", "écup_Apple", "Google_CEO", "Café_conference_é", "Pixel_v._é", "v._Apple", "List_of", "List_ofé"]
    got = {r.page_title: r.v for r in spark.createDataFrame([(t,) for t in titles], "page_title string")
           .select("page_title", rules.verdict_expr("page_title").alias("v")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest(?) AS page_title", [titles])
    assert got == dict(con.execute(f"SELECT page_title, {rules.sql_verdict()} FROM t").fetchall())


def test_links_as_an_html_parser_sees_them(spark):
    from viewsift.sources import pages

    html = ('<a data-href="no.gz" href="yes.gz">x</a><A HREF=\'two.gz\' class=c><a title="a > b" href=three.gz>'
            '<a href="four.gz?a=1&amp;b=.gz"/><a name="n"><area href="no2.gz"><a\nhref = "five.gz"><a href>')
    df = spark.createDataFrame([(1, "http://h.org/d/i.html", html)], "page_id long, url string, html string")
    got = [r.href for r in pages.page_links(df).orderBy("link_pos").collect()]
    assert got == ["yes.gz", "two.gz", "three.gz", "four.gz?a=1&b=.gz", "five.gz"]


def test_exact_ratios_of_large_totals(spark):
    import random
    from fractions import Fraction

    from pyspark.sql import functions as F

    from viewsift.functions.numeric import exact_round_pct

    rnd = random.Random(4)
    rows = [(rnd.randrange(1, 10 ** k), rnd.randrange(1, 10 ** k)) for k in range(10, 19) for _ in range(300)] + [(1, 0)]
    df = spark.createDataFrame(rows, "a long, b long").select("a", "b", exact_round_pct(F.col("a"), F.col("b")).alias("p"))
    for r in df.collect():
        if not r.b:
            assert r.p is None
            continue
        q = Fraction(r.a * 10_000, r.b)
        if q < 2 ** 62:
            assert r.p == int(q + Fraction(1, 2)) / 100.0, r


def test_a_run_broken_between_the_loads_is_made_good(spark, monkeypatch):
    import datetime as dt

    import pytest

    root = tempfile.mkdtemp(prefix="viewsift-broken-")
    schema = "domain string, page_title string, count_views int, source_file string"

    def land(day):
        dumps.write_dump_files(spark.createDataFrame([("en", "Google_Maps", 5000, f"pageviews-202401{day}-000000.gz")], schema),
                               root + "/landing")

    def run(**more):
        return daily_job.run_daily(spark, root + "/landing", root + "/wh", event_time_from_name=True, **more)

    def broken(*args, **more):
        raise RuntimeError("lost executors")
    for day in ("20", "21"):
        land(day)
        with monkeypatch.context() as m:
            m.setattr(daily_job.curate, "curated_load", broken)
            with pytest.raises(RuntimeError, match="lost executors"):
                run()
        if day == "21":
            land("22")  # the next run has new dumps, of another day
        res = run()
        assert res.curated_rows_loaded == (1 if day == "20" else 2) and res.raw_rows_loaded == (0 if day == "20" else 1)
    cur = warehouse.curated_table(spark, root + "/wh/filtered_pageviews")
    assert sorted(r.processing_date.day for r in cur.collect()) == [20, 21, 22]
    assert run().curated_rows_loaded == 0
    assert run(as_of=dt.date(2024, 1, 20)).curated_rows_loaded == 1 == run(as_of="2024-01-21").curated_rows_loaded
