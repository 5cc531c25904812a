"""Registered queries: key → callable(spark, sf_dir) → DataFrame, plus their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from viewsift.operators import fuzzy as FZ
from viewsift.operators import prefilter as PF
from viewsift.operators import quality as QC
from viewsift.operators import scoring as SC
from viewsift.plans import load_jobs as LJ
from viewsift.sources import dumps as DU
from viewsift.sources import pages as PG
from viewsift.operators import curate as C
from viewsift.plans import analytics as A
from viewsift.plans import oracle as O
from viewsift.sources import testbed as tb

AS_OF = tb.AS_OF

Query = Callable[[SparkSession, str], DataFrame]


def _filtered(spark: SparkSession, sf: str) -> DataFrame:
    return tb.filtered_pageviews(spark, sf)


# Parameters of the registered analytics (the dashboard's defaults).
DAYS = 7
SELECTED = ["Apple", "Meta"]
SEARCH = "apple|pixel"
SEARCH_DAYS = 30
LITERAL = ",_NO._"

#: A user's query over the four named views (K6).
VIEWS_SQL = """
SELECT d.processing_date, d.company, d.total_views, q.raw_records, q.source_files, t.page_title AS top_page, s.n_sentiments
FROM v_daily_company_summary d
JOIN v_data_quality_metrics q ON q.processing_date = d.processing_date
LEFT JOIN v_top_pages_by_company t ON t.company = d.company AND t.processing_date = d.processing_date AND t.rank = 1
LEFT JOIN (SELECT company, processing_date, SUM(count) AS n_sentiments FROM v_sentiment_distribution GROUP BY company, processing_date) s
  ON s.company = d.company AND s.processing_date = d.processing_date"""


def _views_by_sql(s: SparkSession, sf: str) -> DataFrame:
    """K6: the views registered by name and read by SQL."""
    A.register_views(tb.raw_pageviews(s, sf, with_event_id=False), _filtered(s, sf), tb.sentiment_results(s, sf), AS_OF, DAYS)
    return s.sql(VIEWS_SQL)


QUERIES: dict[str, Query] = {
    "company_rankings": lambda s, sf: A.company_rankings(_filtered(s, sf), AS_OF),
    "biggest_company": lambda s, sf: A.biggest_company(_filtered(s, sf), AS_OF),
    "filtered_window": lambda s, sf: A.filtered_window(_filtered(s, sf), AS_OF, DAYS),
    "rankings_window": lambda s, sf: A.rankings_window(_filtered(s, sf), AS_OF, DAYS),
    "rankings_selected": lambda s, sf: A.rankings_selected(_filtered(s, sf), AS_OF, DAYS, SELECTED),
    "daily_trends": lambda s, sf: A.daily_trends(_filtered(s, sf), AS_OF, DAYS),
    "filtered_window_selected": lambda s, sf: A.filtered_window(_filtered(s, sf), AS_OF, DAYS, SELECTED),
    "daily_trends_selected": lambda s, sf: A.daily_trends(_filtered(s, sf), AS_OF, DAYS, SELECTED),
    "title_search_literal": lambda s, sf: A.title_search(_filtered(s, sf), AS_OF, LITERAL, SEARCH_DAYS, literal=True),
    "views_by_sql": lambda s, sf: _views_by_sql(s, sf),
    "winner_window": lambda s, sf: A.winner_window(_filtered(s, sf), AS_OF, DAYS),
    "top15_pages": lambda s, sf: A.top_pages(_filtered(s, sf), AS_OF, DAYS, 15, A.TOP_COMPANIES),
    "top_pages_k": lambda s, sf: A.top_pages(_filtered(s, sf), AS_OF, 30, 10, None),
    "overview": lambda s, sf: A.overview(_filtered(s, sf), AS_OF, DAYS),
    "title_search": lambda s, sf: A.title_search(_filtered(s, sf), AS_OF, SEARCH, SEARCH_DAYS),
    "v_daily_company_summary": lambda s, sf: A.v_daily_company_summary(_filtered(s, sf)),
    "v_data_quality_metrics": lambda s, sf: A.v_data_quality_metrics(
        tb.raw_pageviews(s, sf, with_event_id=False), _filtered(s, sf)),
    "dq_latest30": lambda s, sf: A.dq_latest(tb.raw_pageviews(s, sf, with_event_id=False), _filtered(s, sf), 30),
    "v_top_pages_by_company": lambda s, sf: A.v_top_pages_by_company(_filtered(s, sf), AS_OF, DAYS),
    "v_sentiment_distribution": lambda s, sf: A.v_sentiment_distribution(tb.sentiment_results(s, sf)),
}


def _batched(s: SparkSession, sf: str) -> DataFrame:
    return tb.batched_candidates(s, sf)


def _scored_replies(s: SparkSession, sf: str) -> DataFrame:
    return SC.score_batches(SC.build_prompts(_batched(s, sf)))


def _with_replies(s: SparkSession, sf: str, op) -> DataFrame:
    """``op(batched, reply_rows)`` with the replies built from the same batched frame."""
    b = _batched(s, sf)
    return op(b, SC.reply_rows(tb.replies(s, sf, b)))


def _llm_stats(s: SparkSession, sf: str) -> DataFrame:
    b = _batched(s, sf)
    r = tb.replies(s, sf, b)
    return SC.llm_stats(b, SC.reply_status(r), SC.reply_rows(r))


SCORE_COLUMNS = ["bucket", "batch_no", "domain", "page_title", "count_views", "company", "processing_date"]

QUERIES.update({
    "batches": lambda s, sf: _batched(s, sf).select(
        "bucket", "batch_no", "row_in_batch", "domain", "page_title", "count_views", "processing_date",
        "event_id", "company"),
    "sticky_batches": lambda s, sf: SC.sticky_buckets(tb.candidates(s, sf)).groupBy("processing_date", "depth", "prefix").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("count_views").alias("total_views")),
    "rule_verdict": lambda s, sf: tb.verdicts(s, sf).select(
        "domain", "page_title", "count_views", "processing_date", "company", "verdict"),
    "prompts": lambda s, sf: SC.build_prompts(_batched(s, sf)),
    "score_batches": lambda s, sf: _scored_replies(s, sf),
    "scored_rows": lambda s, sf: SC.reply_rows(_scored_replies(s, sf)),
    "reply_status": lambda s, sf: SC.reply_status(tb.replies(s, sf)).select("bucket", "batch_no", "status"),
    "reply_rows": lambda s, sf: SC.reply_rows(tb.replies(s, sf)),
    "batch_stats": lambda s, sf: SC.batch_stats(SC.reply_status(tb.replies(s, sf))),
    "llm_stats": lambda s, sf: _llm_stats(s, sf),
    "accepted_rows": lambda s, sf: _with_replies(s, sf, SC.accepted_rows).select(*SCORE_COLUMNS),
    "invented_rows": lambda s, sf: _with_replies(s, sf, SC.invented_rows),
    "csv_fallback": lambda s, sf: SC.csv_fallback(SC.reply_rows(tb.replies(s, sf))),
})


def _raw(s: SparkSession, sf: str) -> DataFrame:
    return tb.raw_pageviews(s, sf, with_event_id=False)


def _links(s: SparkSession, sf: str) -> DataFrame:
    return PG.page_links(tb.table(s, sf, "pages"), suffix=None)


def _gz_links(s: SparkSession, sf: str) -> DataFrame:
    """S7 with its suffix: links to dumps, made from the pages' links that end in ``e``."""
    pages = tb.table(s, sf, "pages")
    return PG.page_links(pages.withColumn("html", F.replace("html", F.lit('e">'), F.lit('e.gz">'))))


RETENTION_DAYS = 14
SEED = "viewsift"
FUZZY_QUERY = "google pixel phone"
FUZZY_THRESHOLD = 0.3

LARGE_FACTOR = 7_000_000_001  # totals of some 10^15 views
ONE_FILE = "pageviews-20240115-120000.gz"

QUERIES.update({
    "stage_a": lambda s, sf: PF.stage_a(_raw(s, sf), AS_OF),
    "stage_b": lambda s, sf: PF.stage_b(PF.stage_a(_raw(s, sf), AS_OF)),
    "stage_c": lambda s, sf: PF.stage_c(PF.stage_b(PF.stage_a(_raw(s, sf), AS_OF))),
    "prefilter_status": lambda s, sf: QC.zero_row_status(_raw(s, sf), PF.prefilter(_raw(s, sf), AS_OF, require_rows=False, columns=None),
                                                         "processing_date"),
    "csv_text_status": LJ.csv_text_status,
    "prefilter": lambda s, sf: PF.prefilter(_raw(s, sf), AS_OF, require_rows=False),
    "company_distribution": lambda s, sf: PF.company_distribution(PF.prefilter(_raw(s, sf), AS_OF)),
    "classify_company": lambda s, sf: PF.with_company(_raw(s, sf).select("page_title")),
    "null_fill": lambda s, sf: DU.fill_unknown(_raw(s, sf), pandas_null_tokens=True),
    "retention": lambda s, sf: C.retention_window(_raw(s, sf), AS_OF, RETENTION_DAYS),
    "raw_load": LJ.raw_load,
    "raw_load_retry": LJ.raw_load_retry,
    "raw_compacted": LJ.raw_compacted,
    "retention_drop": lambda s, sf: LJ.retention_drop(s, sf, RETENTION_DAYS),
    "v_data_quality_incremental": LJ.dq_from_manifest,
    "rankings_sketched": lambda s, sf: LJ.rankings_sketched(s, sf, DAYS),
    "daily_rerun": LJ.daily_rerun,
    "stream_repair": LJ.stream_repair,
    "curated_two_loads": LJ.curated_two_loads,
    "stream_quarantine": LJ.stream_quarantine,
    "late_row_count": LJ.late_row_count,
    "share_large_totals": lambda s, sf: A.rankings_window(
        _filtered(s, sf).withColumn("count_views", F.col("count_views").cast("long") * LARGE_FACTOR), AS_OF, 30),
    "verify_one_file": lambda s, sf: QC.verify_load(_raw(s, sf), ONE_FILE),
    "sentiment_key_violations": lambda s, sf: QC.key_violations(
        tb.sentiment_results(s, sf).unionByName(tb.sentiment_results(s, sf).where("sentiment_label = 'neutral'")),
        ["page_title", "processing_date"]),
    "curated_load": LJ.curated_load,
    "union_files": LJ.union_files,
    "csv_roundtrip": LJ.csv_roundtrip,
    "json_roundtrip": LJ.json_roundtrip,
    "csv_text_parse": LJ.csv_text_parse,
    "dump_parse": LJ.dump_parse,
    "gz_audit": LJ.gz_audit,
    "stream_ingest": LJ.stream_ingest,
    "late_files": LJ.late_files,
    "stream_daily_summary": LJ.stream_daily_summary,
    "page_links": _links,
    "gz_links": _gz_links,
    "seeded_pick": lambda s, sf: PG.seeded_pick(_links(s, sf), SEED, ["page_id"]),
    "extract_checks": lambda s, sf: QC.extract_checks(_raw(s, sf)),
    "verify_load": lambda s, sf: QC.verify_load(_raw(s, sf)),
    "constraint_violations": lambda s, sf: QC.constraint_violations(_raw(s, sf), "raw_pageviews")
    .unionByName(QC.constraint_violations(_filtered(s, sf), "filtered_pageviews"))
    .unionByName(QC.constraint_violations(tb.sentiment_results(s, sf), "sentiment_results")),
    "key_violations": lambda s, sf: QC.key_violations(
        tb.candidates(s, sf).withColumn("filter_method", F.lit(tb.FILTER_METHOD)),
        ["domain", "page_title", "processing_date", "filter_method"]),
    "fuzzy_titles_stored": lambda s, sf: LJ.fuzzy_stored(s, sf, FUZZY_QUERY, FUZZY_THRESHOLD),
    "fuzzy_titles": lambda s, sf: FZ.fuzzy_search(_raw(s, sf), FUZZY_QUERY, threshold=FUZZY_THRESHOLD),
})

ORACLES: dict[str, Callable[[], str]] = {
    "company_rankings": O.company_rankings,
    "biggest_company": O.biggest_company,
    "filtered_window": lambda: O.filtered_window(DAYS),
    "rankings_window": lambda: O.rankings_window(DAYS),
    "rankings_selected": lambda: O.rankings_window(DAYS, SELECTED),
    "daily_trends": lambda: O.daily_trends(DAYS),
    "filtered_window_selected": lambda: O.filtered_window(DAYS, SELECTED),
    "daily_trends_selected": lambda: O.daily_trends(DAYS, SELECTED),
    "title_search_literal": lambda: O.title_search(LITERAL, SEARCH_DAYS, literal=True),
    "views_by_sql": lambda: O.views_by_sql(DAYS),
    "winner_window": lambda: O.winner_window(DAYS),
    "top15_pages": lambda: O.top_pages(DAYS, 15, A.TOP_COMPANIES),
    "top_pages_k": lambda: O.top_pages(30, 10, None),
    "overview": lambda: O.overview(DAYS),
    "title_search": lambda: O.title_search(SEARCH, SEARCH_DAYS),
    "v_daily_company_summary": O.v_daily_company_summary,
    "v_data_quality_metrics": O.v_data_quality_metrics,
    "dq_latest30": lambda: O.v_data_quality_metrics(30),
    "v_top_pages_by_company": lambda: O.v_top_pages_by_company(DAYS),
    "v_sentiment_distribution": O.v_sentiment_distribution,
    "batches": O.batches,
    "sticky_batches": O.sticky_batches,
    "rule_verdict": O.rule_verdict,
    "prompts": O.prompts,
    "score_batches": O.score_batches,
    "gz_audit": O.gz_audit,
    "scored_rows": O.scored_rows,
    "reply_status": O.reply_status,
    "reply_rows": O.reply_rows,
    "batch_stats": O.batch_stats,
    "llm_stats": O.llm_stats,
    "accepted_rows": O.accepted_rows,
    "invented_rows": O.invented_rows,
    "csv_fallback": O.csv_fallback,
    "stage_a": O.stage_a,
    "stage_b": O.stage_b,
    "stage_c": O.stage_c,
    "prefilter_status": O.prefilter_status,
    "csv_text_status": O.csv_text_status,
    "prefilter": O.prefilter,
    "company_distribution": O.company_distribution,
    "classify_company": O.classify_company,
    "null_fill": O.null_fill,
    "retention": lambda: O.retention(RETENTION_DAYS),
    "raw_load": O.raw_rows,
    "raw_load_retry": O.raw_rows,
    "raw_compacted": O.raw_rows,
    "retention_drop": lambda: O.retention(RETENTION_DAYS),
    "v_data_quality_incremental": O.v_data_quality_metrics,
    "rankings_sketched": lambda: O.rankings_sketched(DAYS),
    "daily_rerun": lambda: O.daily_rerun(len(LJ.BAD_LINES), LJ.CORRUPT_NAME),
    "stream_repair": O.stream_daily_summary,
    "curated_two_loads": O.curated_two_loads,
    "stream_quarantine": lambda: O.stream_quarantine(len(LJ.BAD_LINES)),
    "late_row_count": O.late_row_count,
    "share_large_totals": lambda: O.share_large_totals(LARGE_FACTOR),
    "verify_one_file": lambda: O.verify_load(ONE_FILE),
    "sentiment_key_violations": O.sentiment_key_violations,
    "curated_load": O.filtered_rows,
    "union_files": O.raw_rows,
    "csv_roundtrip": O.candidate_rows,
    "json_roundtrip": O.filtered_rows,
    "csv_text_parse": O.csv_text_parse,
    "dump_parse": O.dump_rows,
    "stream_ingest": O.stream_rows,
    "late_files": O.stream_rows,
    "stream_daily_summary": O.stream_daily_summary,
    "page_links": O.page_links,
    "gz_links": O.gz_links,
    "seeded_pick": lambda: O.seeded_pick(SEED),
    "extract_checks": O.extract_checks,
    "verify_load": O.verify_load,
    "constraint_violations": O.constraint_violations,
    "key_violations": O.key_violations,
    "fuzzy_titles_stored": lambda: O.fuzzy_titles(FUZZY_QUERY, FUZZY_THRESHOLD),
    "fuzzy_titles": lambda: O.fuzzy_titles(FUZZY_QUERY, FUZZY_THRESHOLD),
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: f() for k, f in ORACLES.items()}
