"""Analytical queries and views over the curated table (Q1–Q9, V1–V4).

Every function takes the curated (and, for V2, raw) table as a DataFrame plus
explicit parameters (``as_of`` replaces CURRENT_DATE, D4) and returns a
DataFrame, lazily but for V3's sorted numbering. Presentation sorts are left to the caller (``present``): the views
themselves do not sort.

Plan shape: each query is scan → date filter (partition pruning) → partial hash
aggregate → shuffle on the group key → final aggregate. The only unpartitioned
windows (rank, share of total, winner fields) run *after* the aggregation by
``company``, whose domain has six values, so one partition holds at most six rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewsift.functions.numeric import exact_round_avg, exact_round_pct
from viewsift.operators import manifest
from viewsift.operators.ranking import sorted_row_number, split_row_number
from viewsift.session import materialize

#: Characters of a title that the live V3 view tells rows apart by.
TITLE_CUTS = (8, 16, 24)
TOP_COMPANIES = ["Amazon", "Apple", "Google", "Microsoft", "Meta"]


def _as_date(as_of) -> Column:
    return F.lit(as_of).cast("date")


def on_day(df: DataFrame, as_of, date_col: str = "processing_date") -> DataFrame:
    """rows of one processing date."""
    return df.where(F.col(date_col) == _as_date(as_of))


def last_n_days(df: DataFrame, as_of, days: int = 7, date_col: str = "processing_date") -> DataFrame:
    """``processing_date >= as_of - days`` with no upper bound (D5: n+1 dates)."""
    return df.where(F.col(date_col) >= F.date_sub(_as_date(as_of), int(days)))


def only_companies(df: DataFrame, companies: Sequence[str] | None) -> DataFrame:
    """optional IN list; empty or None means no filter."""
    return df.where(F.col("company").isin(list(companies))) if companies else df


def _company_metrics(df: DataFrame, approx_median: bool = False) -> DataFrame:
    v = F.col("count_views")
    # Exact median (percentile_cont 0.5): its buffer holds distinct values, not rows.
    # ``approx_median`` bounds the buffer (GK sketch, 1/10000 rank error) for raw-size inputs.
    median = (F.percentile_approx(v, 0.5, 10000).cast("double") if approx_median
              else F.median(v).cast("double"))
    # The sum of BIGINTs can leave BIGINT: it is exact in DECIMAL(30,0) (see ``_fitted``).
    total = F.sum(v.cast("decimal(20,0)")) if isinstance(df.schema["count_views"].dataType, T.LongType) else F.sum(v).cast("long")
    return df.groupBy("company").agg(
        F.count(F.lit(1)).alias("page_count"),
        total.alias("total_views"),
        F.max(v).alias("max_views"),
        F.min(v).alias("min_views"),
        median.alias("median_views"),
    ).withColumn("avg_views", exact_round_avg(F.col("total_views"), F.col("page_count")))


def _ranked(metrics: DataFrame) -> DataFrame:
    everyone = Window.partitionBy()  # after aggregation: at most one row per company
    by_total = Window.orderBy(F.col("total_views").desc())
    return metrics.select(
        "*",
        F.rank().over(by_total).cast("long").alias("rank"),
        exact_round_pct(F.col("total_views"), F.sum(F.col("total_views").cast("decimal(28,0)")).over(everyone)).alias("market_share_pct"),
    )


def _fitted(rankings: DataFrame) -> DataFrame:
    """``total_views`` as BIGINT; as DECIMAL(30,0) if a total of BIGINT counts lies beyond it.

    The type of decimal totals depends on the rows, so these rankings (one row per
    company) are written first.
    """
    if not isinstance(rankings.schema["total_views"].dataType, T.DecimalType):
        return rankings
    rows = materialize(rankings, "rankings")
    beyond = rows.where(~F.col("total_views").between(-2 ** 63, 2 ** 63 - 1))
    return rows.withColumn("total_views", F.col("total_views").cast("long")) if beyond.isEmpty() else rows


RANKING_COLUMNS = ["rank", "company", "page_count", "total_views", "avg_views", "median_views",
                   "max_views", "min_views", "market_share_pct"]


def company_rankings(filtered: DataFrame, as_of, approx_median: bool = False) -> DataFrame:
    """Q1: rank, company, page_count, total/avg/median/max/min views, share, report_date.

    Totals of BIGINT counts are exact beyond BIGINT too (``_fitted``).
    """
    out = _ranked(_company_metrics(on_day(filtered, as_of), approx_median))
    return _fitted(out.select(*RANKING_COLUMNS, _as_date(as_of).alias("report_date")))


def rankings_window(filtered: DataFrame, as_of, days: int = 7,
                    companies: Sequence[str] | None = None, approx_median: bool = False) -> DataFrame:
    """Q4 / F8: rankings over the last ``days``; shares over all companies, then the IN filter.

    Totals of BIGINT counts are exact beyond BIGINT too (``_fitted``).
    """
    out = _ranked(_company_metrics(last_n_days(filtered, as_of, days), approx_median)).select(*RANKING_COLUMNS)
    return only_companies(_fitted(out), companies)


def _winner_vs_runner_up(df: DataFrame) -> DataFrame:
    """Winner × runner-up without a join (J1/J3 re-expressed with windows).

    RANK ties keep the original semantics (D12): two leaders → no rank 2 → no row;
    two runners-up → two rows; a single company → no row.
    """
    totals = df.groupBy("company").agg(F.count(F.lit(1)).alias("page_count"),
                                       F.sum("count_views").cast("long").alias("total_views"))
    everyone = Window.partitionBy()  # at most one row per company
    ranked = totals.withColumn("rank", F.rank().over(Window.orderBy(F.col("total_views").desc())))
    first = F.col("rank") == 1
    ranked = ranked.select(
        "*",
        F.sum(F.when(first, 1).otherwise(0)).over(everyone).alias("n_winners"),
        F.max(F.when(first, F.col("company"))).over(everyone).alias("winner_company"),
        F.max(F.when(first, F.col("page_count"))).over(everyone).alias("winner_page_count"),
        F.max(F.when(first, F.col("total_views"))).over(everyone).alias("winner_total_views"),
        F.sum("total_views").over(everyone).cast("long").alias("grand_total_views"),
    )
    r = ranked.where((F.col("rank") == 2) & (F.col("n_winners") == 1))
    lead = F.col("winner_total_views") - F.col("total_views")
    return r.select(
        "winner_company", "winner_page_count", "winner_total_views",
        F.col("company").alias("runner_up_company"),
        F.col("total_views").alias("runner_up_views"),
        lead.alias("lead_by_views"),
        exact_round_pct(lead, F.col("total_views")).alias("lead_percentage"),  # NULLIF form (D14)
        "grand_total_views",
        exact_round_pct(F.col("winner_total_views"), F.col("grand_total_views")).alias("winner_market_share"),
    )


def biggest_company(filtered: DataFrame, as_of) -> DataFrame:
    """Q2: winner vs runner-up on one day."""
    return _winner_vs_runner_up(on_day(filtered, as_of)).withColumn("report_date", _as_date(as_of))


def winner_window(filtered: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Q6: winner vs runner-up over the last ``days``; first row only (by runner-up name)."""
    return _winner_vs_runner_up(last_n_days(filtered, as_of, days)) \
        .orderBy("runner_up_company").limit(1)


FILTERED_WINDOW_COLUMNS = ["domain", "page_title", "count_views", "company", "processing_date",
                           "filtered_at", "filter_method"]


def filtered_window(filtered: DataFrame, as_of, days: int = 7,
                    companies: Sequence[str] | None = None) -> DataFrame:
    """Q3: curated rows of the last ``days``, optional companies."""
    return only_companies(last_n_days(filtered, as_of, days), companies).select(*FILTERED_WINDOW_COLUMNS)


def daily_trends(filtered: DataFrame, as_of, days: int = 7,
                 companies: Sequence[str] | None = None) -> DataFrame:
    """Q5: pages and views per date and company."""
    df = only_companies(last_n_days(filtered, as_of, days), companies)
    return df.groupBy("processing_date", "company").agg(
        F.count(F.lit(1)).alias("page_count"),
        F.sum("count_views").cast("long").alias("total_views"))


def _page_order() -> list[Column]:
    # count_views desc, then deterministic tie-breakers (the original is arbitrary on ties)
    return [F.col("count_views").desc(), F.col("processing_date").desc(), F.col("domain"), F.col("page_title")]


def top_pages(filtered: DataFrame, as_of, days: int = 7, k: int = 15,
              companies: Sequence[str] | None = TOP_COMPANIES) -> DataFrame:
    """Top ``k`` pages per company.

    ``row_number() <= k`` plans as WindowGroupLimit: a partial top-k runs before
    the shuffle, so a hot company ships at most k rows per map task.
    """
    df = only_companies(last_n_days(filtered, as_of, days), companies)
    w = Window.partitionBy("company").orderBy(*_page_order())
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= int(k)).select(
        "company", F.col("rank").cast("long").alias("rank"), "page_title", "count_views",
        "processing_date", "domain")


def overview(filtered: DataFrame, as_of, days: int = 7, companies: Sequence[str] | None = None) -> DataFrame:
    """Global totals of the window (one row)."""
    df = only_companies(last_n_days(filtered, as_of, days), companies)
    agg = df.agg(F.count(F.lit(1)).alias("total_pages"),
                 F.sum("count_views").cast("long").alias("total_views"),
                 F.count_distinct("company").alias("companies"))
    return agg.select("total_pages", "total_views",
                      exact_round_avg(F.col("total_views"), F.col("total_pages")).alias("avg_views"),
                      "companies")


def title_search(filtered: DataFrame, as_of, query: str, days: int = 7,
                 literal: bool = False, companies: Sequence[str] | None = None) -> DataFrame:
    """Case-insensitive regex search in titles (``literal`` = plain substring)."""
    df = only_companies(last_n_days(filtered, as_of, days), companies)
    t = F.col("page_title")
    cond = F.lower(t).contains(query.lower()) if literal else t.rlike("(?iu)" + query)
    return df.where(F.coalesce(cond, F.lit(False))).select(
        "processing_date", "page_title", "company", "count_views", "filter_method")


def rankings_selected(filtered: DataFrame, as_of, days: int, companies: Sequence[str]) -> DataFrame:
    """F8: the ranking restricted to ``companies`` after shares and ranks are computed."""
    return rankings_window(filtered, as_of, days, companies)


def v_daily_company_summary(filtered: DataFrame) -> DataFrame:
    """V1: metrics per company and date."""
    v = F.col("count_views")
    return filtered.groupBy("company", "processing_date").agg(
        F.count(F.lit(1)).alias("page_count"),
        F.sum(v).cast("long").alias("total_views"),
        F.max(v).alias("max_views"),
        F.min(v).alias("min_views"),
    ).withColumn("avg_views", exact_round_avg(F.col("total_views"), F.col("page_count"))).select(
        "company", "processing_date", "page_count", "total_views", "avg_views", "max_views", "min_views")


def v_data_quality_metrics(raw: DataFrame, filtered: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """V2: per raw date: raw and curated counts, kept %, load times, source files.

    The correlated subquery of the original is rewritten (J2): both sides are
    aggregated by date first, then left-joined on the date (a few rows per side).
    """
    r = raw.groupBy("processing_date").agg(
        F.count(F.lit(1)).alias("raw_records"),
        F.min("loaded_at").alias("first_loaded"),
        F.max("loaded_at").alias("last_loaded"),
        (F.approx_count_distinct("source_file") if approx_distinct else F.count_distinct("source_file"))
        .alias("source_files"))
    f = filtered.groupBy("processing_date").agg(F.count(F.lit(1)).alias("filtered_count"))
    j = r.join(f, "processing_date", "left")
    kept = F.coalesce(F.col("filtered_count"), F.lit(0)).cast("long")
    return j.select("processing_date", "raw_records", kept.alias("filtered_records"),
                    exact_round_pct(kept, F.col("raw_records")).alias("filter_rate_pct"),
                    "first_loaded", "last_loaded", "source_files")


def v_data_quality_from_manifest(spark: SparkSession, raw_path: str, filtered: DataFrame) -> DataFrame:
    """V2 without a scan of the raw table, plus ``approx_domains`` (A4).

    The raw side is added up from what each load noted per date in its commit; the
    curated side counts rows by partition, reading no column.
    """
    kept = filtered.groupBy("processing_date").agg(F.count(F.lit(1)).alias("_kept"))
    j = manifest.raw_metrics(spark, raw_path).join(kept, "processing_date", "left")
    n = F.coalesce(F.col("_kept"), F.lit(0)).cast("long")
    return j.select("processing_date", "raw_records", n.alias("filtered_records"),
                    exact_round_pct(n, F.col("raw_records")).alias("filter_rate_pct"),
                    "first_loaded", "last_loaded", "source_files", "approx_domains")


#: Items a quantile sketch keeps per level; its rank error is below 1 % (``MEDIAN_RANK_ERROR``) with near certainty.
SKETCH_K = 400
MEDIAN_RANK_ERROR = 0.01


def company_partials(filtered: DataFrame) -> DataFrame:
    """Per (date, company): counts, totals, extremes and a quantile sketch of the views; all can be merged."""
    v = F.col("count_views").cast("long")
    return filtered.groupBy("processing_date", "company").agg(
        F.count(F.lit(1)).alias("page_count"), F.sum(v).alias("total_views"), F.max("count_views").alias("max_views"),
        F.min("count_views").alias("min_views"), F.kll_sketch_agg_bigint(v, F.lit(SKETCH_K)).alias("views_sketch"))


def rankings_from_partials(partials: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Q4 over any window from the stored partials: all columns exact but ``median_views`` (a value of the data).

    The work grows with dates times companies, not with rows, and a hot company is as
    small as any other: its rows are folded into sketches before the shuffle.
    """
    own = last_n_days(partials, as_of, days).groupBy("company").agg(
        F.sum("page_count").alias("page_count"), F.sum("total_views").alias("total_views"),
        F.max("max_views").alias("max_views"), F.min("min_views").alias("min_views"),
        F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("views_sketch", F.lit(SKETCH_K)), F.lit(0.5)).alias("median_views"))
    own = own.withColumn("avg_views", exact_round_avg(F.col("total_views"), F.col("page_count")))
    return _ranked(own).select(*RANKING_COLUMNS)


def dq_latest(raw: DataFrame, filtered: DataFrame, n: int = 30) -> DataFrame:
    """The newest ``n`` dates of V2.

    The oldest of these dates is a scalar subquery over the raw table's partition
    column, so the aggregation scans only their partitions, not the history.
    """
    day = F.col("processing_date")
    oldest = raw.select("processing_date").distinct().orderBy(day.desc()).limit(int(n)).agg(F.min(day)).scalar()
    raw, filtered = raw.where(day >= oldest), filtered.where(day >= oldest)
    return v_data_quality_metrics(raw, filtered).orderBy(F.col("processing_date").desc()).limit(int(n))


def v_top_pages_by_company(filtered: DataFrame, as_of, days: int = 7, method: str = "sorted") -> DataFrame:
    """V3: every page of the last ``days`` with its row number inside its company.

    All ranks are kept (no limit), so a plain window (``method="window"``) would
    sort a whole company in one task. ``"sorted"`` (default) runs a
    range-partitioned sort and writes its rows when called, so no company or
    (company, views) pair lands whole in one task. ``"split"`` stays lazy (for the
    live temp view): a hot company is spread over its view counts, a hot (company,
    views) pair over dates, domains and the first characters of titles.
    """
    df = last_n_days(filtered, as_of, days).select("company", "page_title", "count_views", "processing_date",
                                                   "domain")
    ties = [F.col("processing_date").desc(), F.col("domain"), F.col("page_title")]
    if method == "sorted":
        out = sorted_row_number(df, ["company"], [F.col("count_views").desc(), *ties], "rank")
    elif method == "split":
        title = F.col("page_title")
        cuts = [(F.col("processing_date"), True), (F.col("domain"), False), *((F.substring(title, 1, n), False) for n in TITLE_CUTS)]
        out = split_row_number(df, ["company"], "count_views", ties, cuts=cuts)
    elif method == "window":
        out = df.withColumn("rank", F.row_number().over(Window.partitionBy("company").orderBy(*_page_order()))
                            .cast("long"))
    else:
        raise ValueError(f"method must be sorted, split or window, not {method!r}")
    return out.select(*df.columns, "rank")


def v_sentiment_distribution(sentiment: DataFrame) -> DataFrame:
    """V4: count, rounded mean score and views per company, date and label."""
    milli = (F.col("sentiment_score") * 1000).cast("long")  # decimal(4,3) → exact integer
    return sentiment.groupBy("company", "processing_date", "sentiment_label").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(milli).alias("_score_milli"),
        F.count("sentiment_score").alias("_scored"),
        F.sum("count_views").cast("long").alias("total_views"),
    ).select("company", "processing_date", "sentiment_label", "count",
             exact_round_avg(F.col("_score_milli"), F.col("_scored") * 1000, 3).alias("avg_score"),
             "total_views")


def present(df: DataFrame, *order: Column | str) -> DataFrame:
    """O1: presentation sort, applied only when a caller displays or exports."""
    return df.orderBy(*order)


VIEW_NAMES = ["v_daily_company_summary", "v_data_quality_metrics", "v_top_pages_by_company",
              "v_sentiment_distribution"]


def register_views(raw: DataFrame, filtered: DataFrame, sentiment: DataFrame | None, as_of,
                   days: int = 7) -> list[str]:
    """K6: the four views as session temp views (lazy plans, recomputed on each read)."""
    views = {
        "v_daily_company_summary": v_daily_company_summary(filtered),
        "v_data_quality_metrics": v_data_quality_metrics(raw, filtered),
        "v_top_pages_by_company": v_top_pages_by_company(filtered, as_of, days, method="split"),
    }
    if sentiment is not None:
        views["v_sentiment_distribution"] = v_sentiment_distribution(sentiment)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
