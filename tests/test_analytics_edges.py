"""Hand-made frames for rank ties (D12), NULLIF (D14), the rolling window (D5) and F7/F8."""

import datetime as dt

from viewsift.plans import analytics as A

DAY = dt.date(2024, 1, 30)
SCHEMA = ("domain string, page_title string, count_views int, company string, filtered_at timestamp_ntz, "
          "processing_date date, filter_method string")


def frame(spark, rows):
    ts = dt.datetime(2024, 1, 30, 12)
    return spark.createDataFrame([("en", f"T{i}", v, c, ts, d, "m") for i, (c, v, d) in enumerate(rows)], SCHEMA)


def test_two_leaders_give_no_row(spark):
    f = frame(spark, [("Apple", 10, DAY), ("Meta", 10, DAY), ("Google", 5, DAY)])
    assert A.biggest_company(f, DAY).count() == 0


def test_two_runners_up_give_two_rows(spark):
    f = frame(spark, [("Apple", 20, DAY), ("Meta", 10, DAY), ("Google", 10, DAY)])
    rows = A.biggest_company(f, DAY).collect()
    assert sorted(r.runner_up_company for r in rows) == ["Google", "Meta"]
    assert {r.lead_percentage for r in rows} == {100.0}
    assert {r.winner_market_share for r in rows} == {50.0}


def test_single_company_gives_no_row(spark):
    assert A.biggest_company(frame(spark, [("Apple", 20, DAY)]), DAY).count() == 0


def test_zero_runner_up_views_is_null_not_error(spark):
    r = A.biggest_company(frame(spark, [("Apple", 20, DAY), ("Meta", 0, DAY)]), DAY).first()
    assert r.lead_percentage is None and r.lead_by_views == 20


def test_rankings_ties_and_shares(spark):
    f = frame(spark, [("Apple", 1, DAY), ("Meta", 1, DAY), ("Google", 1, DAY)])
    rows = A.company_rankings(f, DAY).collect()
    assert {r.rank for r in rows} == {1}
    assert [r.market_share_pct for r in rows] == [33.33] * 3


def test_exact_half_up_rounding(spark):
    # 401 / 200 = 2.005 exactly: numeric rounding gives 2.01, rounding the double 2.00499.. gives 2.0
    f = frame(spark, [("Apple", 2, DAY)] * 199 + [("Apple", 3, DAY)])
    assert A.company_rankings(f, DAY).first().avg_views == 2.01


def test_window_has_no_upper_bound_and_n_plus_one_days(spark):
    rows = [("Apple", 1, DAY - dt.timedelta(days=d)) for d in range(0, 10)] + [("Apple", 1, DAY + dt.timedelta(days=3))]
    f = frame(spark, rows)
    assert A.filtered_window(f, DAY, 7).count() == 8 + 1


def test_company_filter_empty_means_all_and_f8_after_ranking(spark):
    f = frame(spark, [("Apple", 30, DAY), ("Meta", 20, DAY), ("Google", 10, DAY)])
    assert A.filtered_window(f, DAY, 7, []).count() == 3
    sel = A.rankings_window(f, DAY, 7, ["Google"]).first()
    assert sel.rank == 3 and sel.market_share_pct == 16.67


def test_top_k_is_total_order(spark):
    f = frame(spark, [("Apple", 5, DAY)] * 20)
    out = A.top_pages(f, DAY, 7, 15).collect()
    assert len(out) == 15 and sorted(r.rank for r in out) == list(range(1, 16))


def test_split_row_number_equals_window(spark):
    from pyspark.sql import Window, functions as F

    from viewsift.operators.ranking import split_row_number
    df = spark.range(5000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 7 AS STRING) END AS g",
                                      "CAST(id % 11 AS INT) AS v", "id AS t")
    ties = [F.col("t").desc()]
    got = {tuple(r) for r in split_row_number(df, ["g"], "v", ties).collect()}
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), *ties)
    want = {tuple(r) for r in df.withColumn("rank", F.row_number().over(w).cast("long")).collect()}
    assert got == want


def test_sorted_row_number_equals_window_on_hot_group(spark):
    from pyspark.sql import Window, functions as F

    from viewsift.operators.ranking import sorted_row_number
    # a third of the rows in one group, heavy ties on v, a NULL group; more range partitions than groups
    df = spark.range(6000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 97 = 1 THEN NULL ELSE CAST(id % 5 AS STRING) END AS g",
        "CAST(id % 4 AS INT) AS v", "id AS t").repartition(7)
    order = [F.col("v").desc(), F.col("t")]
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {tuple(r) for r in sorted_row_number(df, ["g"], order, "rn").collect()}
        whole = {tuple(r) for r in sorted_row_number(df, [], order, "rn").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    want = {tuple(r) for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order))
                                            .cast("long")).collect()}
    want_all = {tuple(r) for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*order))
                                                .cast("long")).collect()}
    assert got == want and whole == want_all


def test_approx_options_close_to_exact(spark):
    rows = [("Apple", v, DAY) for v in range(1, 1002)] + [("Meta", 7, DAY)]
    f = frame(spark, rows)
    exact = {r.company: r.median_views for r in A.company_rankings(f, DAY).collect()}
    approx = {r.company: r.median_views for r in A.company_rankings(f, DAY, approx_median=True).collect()}
    assert exact == {"Apple": 501.0, "Meta": 7.0} and abs(approx["Apple"] - 501) <= 1 and approx["Meta"] == 7


def test_v3_methods_agree_on_hot_company_and_ties(spark):
    # one company holds most rows and one (company, views) pair is hot; dates break some ties
    rows = [("Apple", 7, DAY - dt.timedelta(days=i % 3)) for i in range(300)] + \
           [("Apple", v, DAY) for v in range(50)] + [("Meta", 3, DAY)] * 20
    f = frame(spark, rows)
    got = {m: sorted(tuple(r) for r in A.v_top_pages_by_company(f, DAY, 7, method=m).collect())
           for m in ("sorted", "split", "window")}
    assert got["sorted"] == got["split"] == got["window"] and len(got["window"]) == 370


def test_sorted_row_number_equals_window(spark):
    from pyspark.sql import Window, functions as F

    from viewsift.operators.ranking import sorted_row_number
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 4 AS STRING) END AS g",
                                      "CAST(id % 5 AS INT) AS v", "id AS t")
    order = [F.col("v").desc(), F.col("t")]
    want = {tuple(r) for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order))
                                            .cast("long")).collect()}
    assert {tuple(r) for r in sorted_row_number(df, ["g"], order, "rn").collect()} == want


def test_equal_rows_are_split_over_partitions(spark, monkeypatch):
    """200,000 equal rows: the range-partitioned sort deals them to several tasks, each number once."""
    from pyspark.sql import functions as F

    from viewsift.operators import ranking
    written = {}
    plain = ranking.materialize

    def keep(df, name):
        written[name] = plain(df, name)
        return written[name]
    monkeypatch.setattr(ranking, "materialize", keep)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(200_000).select(F.lit("hot").alias("g"), F.lit(7).alias("v"))
        out = ranking.sorted_row_number(df, ["g"], ["v"], "rn")
        n, low, high, distinct = out.agg(F.count("*"), F.min("rn"), F.max("rn"), F.count_distinct("rn")).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (n, low, high, distinct) == (200_000, 1, 200_000, 200_000)
    sizes = [r["count"] for r in written["sorted-rows"].groupBy("_part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 100_000


def test_live_ranks_of_a_hot_pair_are_spread(spark):
    """A third of all rows share company and views: the live V3 equals the sorted form, and no window task has its rows."""
    from pyspark.sql import functions as F

    from viewsift.operators import ranking
    from viewsift.sources import testbed as tb

    rows = spark.range(6000).select(
        F.lit("en").alias("domain"), F.concat(F.lit("Google_Maps_"), F.xxhash64("id").cast("string")).alias("page_title"),
        F.when(F.col("id") % 3 == 0, 777).otherwise((F.xxhash64("id") % 500 + 500).cast("int")).cast("int").alias("count_views"),
        F.when(F.col("id") % 3 < 2, "Google").otherwise("Other").alias("company"),
        F.date_add(F.lit("2024-01-28").cast("date"), (F.col("id") % 2).cast("int")).alias("processing_date"))
    got = {m: sorted(map(tuple, A.v_top_pages_by_company(rows, tb.AS_OF, 7, method=m).collect())) for m in ("split", "window")}
    assert got["split"] == got["window"] and len(got["split"]) == 6000
    one = rows.groupBy("company", "count_views", "processing_date", "domain", *[F.substring("page_title", 1, n) for n in A.TITLE_CUTS]).count()
    assert one.agg(F.max("count")).first()[0] < 5 < rows.where("count_views = 777").count()
    assert ranking.split_row_number(rows.where("false"), ["company"], "count_views", [F.col("page_title")]).count() == 0


def test_totals_of_bigint_counts_are_exact_beyond_bigint(spark):
    def rankings(rows):
        f = spark.createDataFrame([(c, v, DAY) for c, v in rows], "company string, count_views long, processing_date date")
        return A.rankings_window(f, DAY, 7)

    half = 2 ** 62
    beyond = rankings([("Google", half), ("Google", half), ("Google", half), ("Apple", half)])  # 3 * 2^62 is no BIGINT
    assert [(r.company, int(r.total_views), r.market_share_pct) for r in beyond.orderBy("rank").collect()] == \
        [("Google", 3 * half, 75.0), ("Apple", half, 25.0)]
    fits = rankings([("Google", half), ("Google", half // 2), ("Apple", half), ("Apple", half // 2)])  # only their sum is none
    assert dict(fits.dtypes)["total_views"] == "bigint"
    assert [(r.total_views, r.market_share_pct) for r in fits.collect()] == [(half + half // 2, 50.0)] * 2
