"""Testbed adapter: pageview-shaped tables derived by Spark from the given test tables.

The given tables hold no pageview dumps, so ``raw_pageviews`` is derived from
``events`` joined to a fixed 72-title catalogue (``event_id % 72 = k``); every
other table is derived from it with this package's own operators. All work grows
with ``events``; the catalogue is the only fixed input and is broadcast with a
proven size bound (72 rows).

``event_id`` is carried as a fixture-only lineage column so that tie-breaks and
the synthetic sentiment/reply tables are repeatable in Spark and in SQL.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewsift.functions import rules
from viewsift.operators import curate, prefilter
from viewsift.session import fresh_dir

# The last day in ``events`` at every scale; plays the role of CURRENT_DATE.
AS_OF = dt.date(2024, 1, 30)
FILTER_METHOD = "rules_v1"

# The title catalogue (k, title) with edge cases for every rule.
CATALOGUE_TITLES = [
    "Amazon_Echo", "Amazon_(company)", "AWS_Lambda", "Amazon_rainforest", "Kindle", "Amazon_Kindle",
    "Apple_Inc.", "iPhone_15", "IPHONE_(device)", "Apple_Watch", "macOS_Sonoma", "Apple_pie", "Snapple",
    "Google_Maps", "Google_Pixel", "Android_(operating_system)", "YouTube", "Pixel_art", "Alphabet_Inc.",
    "Alphabet", "Microsoft_Office", "Windows_11", "Xbox_Series_X", "Microsoft_Azure", "LinkedIn",
    "Facebook", "Meta_Quest", "Metallica", "Instagram_(app)", "WhatsApp", "Oculus_Rift",
    "Google_Chrome_version_history", "List_of_Amazon_products", "ListXof_Apple_devices",
    "History_of_Google", "Timeline_of_Facebook", "Comparison_of_Android_phones", "Outline_of_Apple",
    "Apple_(film)", "Windows_(movie)", "Meta_(book)", "Pixel_(novel)", "Google_(documentary)",
    "Wikipedia:Google", "Category:Microsoft", "Template:Apple", "Portal:Android", "Apple_(person)",
    "Airborne_Windows", "Pixel_(actor)", "Meta_(musician)", "Apple_(entrepreneur)", "wikipedia:google",
    "list_of_apple_products", "Epic_Games_v._Apple", "Google_antitrust_lawsuit", "Apple_Campus",
    "Apple_store_(building)", "Microsoft_CEO", "Google_Developers_conference", "Facebook_(tv_series)",
    "Amazon.com", "Windows_(typeface)", "Google_(2023)", "Apple_stock", "Apple_(disambiguation)",
    "Main_Page", "NaN_Amazon", "Laws_of_Oz", "Windows_Surface_Android", "iPhone_15_(2023)",
    "Unknown_Windows_(software)",
]
N_TITLES = len(CATALOGUE_TITLES)

RAW_COLUMNS = ["domain", "page_title", "count_views", "source_file", "loaded_at", "processing_date"]
FILTERED_COLUMNS = ["domain", "page_title", "count_views", "company", "filtered_at", "processing_date",
                    "filter_method"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def catalogue(spark: SparkSession) -> DataFrame:
    """(k, title) built in the JVM (a range and an array literal), so no Python scan enters plans."""
    titles = F.array(*[F.lit(t) for t in CATALOGUE_TITLES])
    return spark.range(N_TITLES).select(F.col("id").cast("int").alias("k"),
                                        F.element_at(titles, (F.col("id") + 1).cast("int")).alias("title"))


def source_file_expr(ts_col: str = "ts") -> F.Column:
    """Hourly dump name ``pageviews-YYYYMMDD-HH0000.gz`` for an event time."""
    return F.concat(F.lit("pageviews-"), F.date_format(F.col(ts_col), "yyyyMMdd-HH"), F.lit("0000.gz"))


def title_expr(title: F.Column, event_id: F.Column) -> F.Column:
    """A row's title: every third row one of many Google pages, others the catalogue's, some with odd characters.

    So curated rows grow with the events, one company holds over a third of all
    rows, and titles hold commas, quotes, backslashes and accents.
    """
    kind = event_id % 12
    number = (event_id % 100_003).cast("string")
    return (F.when(event_id % 3 == 0, F.concat(F.lit("Google_Maps_"), number))
            .when(kind == 1, F.concat(title, F.lit(",_No._"), (event_id % 7).cast("string")))
            .when(kind == 2, F.concat(F.lit('"'), title, F.lit('"')))
            .when(kind == 4, F.concat(title, F.lit("\\_II")))
            .when(kind == 5, F.concat(title, F.lit("_Café")))
            .otherwise(title))


_STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``build`` derives, written once per application, by date as the warehouse has it.

    Queries over the warehouse read stored tables; without this each would derive its input again.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    rows = build()
    if key not in _STORED:
        path = fresh_dir(spark, f"testbed-{name}")
        rows.hint("rebalance", "processing_date").write.partitionBy("processing_date").parquet(path)
        _STORED[key] = path
    return spark.read.schema(rows.schema).parquet(_STORED[key]).select(*rows.columns)


def raw_pageviews(spark: SparkSession, sf_dir: str, with_event_id: bool = True) -> DataFrame:
    df = _stored(spark, sf_dir, "raw_pageviews", lambda: _derived_raw(spark, sf_dir))
    return df if with_event_id else df.drop("event_id")


def _derived_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    cat = F.broadcast(catalogue(spark))  # 72 rows: proven size bound
    return ev.join(cat, (ev.event_id % N_TITLES) == cat.k).select(
        F.when(F.col("user_id") % 3 == 0, F.lit("en.m")).otherwise(F.lit("en")).alias("domain"),
        title_expr(F.col("title"), F.col("event_id")).alias("page_title"),
        F.floor(F.col("value") * 100).cast("int").alias("count_views"),
        source_file_expr("ts").alias("source_file"),
        F.col("ts").cast("timestamp_ntz").alias("loaded_at"),
        F.col("ts").cast("date").alias("processing_date"),
        F.col("event_id"),
    )


def candidates(spark: SparkSession, sf_dir: str, min_views: int = rules.DEFAULT_MIN_VIEWS) -> DataFrame:
    """Stage A (every date) ∧ B ∧ C, with the company column."""
    return prefilter.prefilter(raw_pageviews(spark, sf_dir), as_of=None, min_views=min_views,
                               columns=None)


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).withColumn("verdict", rules.verdict_expr("page_title"))


def filtered_pageviews(spark: SparkSession, sf_dir: str, with_event_id: bool = False) -> DataFrame:
    """Curated rows: kept verdicts, one per (domain, page_title, processing_date)."""
    best = _stored(spark, sf_dir, "filtered_pageviews", lambda: _derived_filtered(spark, sf_dir))
    return best if with_event_id else best.select(*FILTERED_COLUMNS)


def _derived_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = verdicts(spark, sf_dir).where(rules.is_kept("verdict")).select(
        "domain", "page_title", "count_views", "company",
        F.col("loaded_at").alias("filtered_at"), "processing_date",
        F.lit(FILTER_METHOD).alias("filter_method"), "event_id")
    return curate.dedupe_keep_best(kept, key=["domain", "page_title", "processing_date", "filter_method"],
                                   desc=["count_views"], asc=["event_id"])


SENTIMENT_BY_MOD3 = ["positive", "neutral", "negative"]


def sentiment_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic scores for the curated rows, one per (page_title, processing_date)."""
    f = filtered_pageviews(spark, sf_dir, with_event_id=True)
    one = curate.dedupe_keep_best(f, key=["page_title", "processing_date"], desc=["count_views"],
                                  asc=["event_id"])
    label = F.element_at(F.array(*[F.lit(x) for x in SENTIMENT_BY_MOD3]), (F.col("event_id") % 3 + 1).cast("int"))
    score = (((F.col("event_id") % 2001) - 1000).cast("decimal(10,0)") / 1000).cast("decimal(4,3)")
    return one.select(
        "page_title", "company", label.alias("sentiment_label"), score.alias("sentiment_score"),
        "count_views", "processing_date", F.col("filtered_at").alias("analyzed_at"), "event_id")


# --------------------------------------------------------------------------- scorer fixtures

N_BUCKETS = 4
BATCH_SIZE = 50
REPLY_VARIANTS = ["valid", "not_json", "no_key", "string_output", "first_lacks_domain", "empty_list"]
INVENTED_SUFFIX = "_(invented)"


def batched_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with verdicts, cut into batches of 50 inside ``event_id % 4`` buckets."""
    from viewsift.operators import scoring

    order = [F.col("count_views").desc(), F.col("domain"), F.col("page_title"), F.col("processing_date"),
             F.col("event_id")]
    return scoring.assign_batches(verdicts(spark, sf_dir), BATCH_SIZE, bucket=F.col("event_id") % N_BUCKETS,
                                  order=order)


def replies(spark: SparkSession, sf_dir: str, batched: DataFrame | None = None) -> DataFrame:
    """Synthetic scorer replies, one per batch, covering every reply failure mode.

    Variant ``(bucket + batch_no) % 6``: valid (kept records, plus one invented
    record when ``batch_no % 4 = 0``) · not JSON · object without ``json_output`` ·
    ``json_output`` a string · first record lacks ``domain`` · empty list.
    """
    b = batched if batched is not None else batched_candidates(spark, sf_dir)
    rec = F.struct("row_in_batch", "domain", "page_title", "count_views",
                   F.col("verdict").startswith("keep:").alias("kept"))
    g = b.groupBy("bucket", "batch_no").agg(F.sort_array(F.collect_list(rec)).alias("recs"))
    kept = F.transform(F.filter("recs", lambda r: r["kept"]),
                       lambda r: F.struct(r["domain"].alias("domain"), r["page_title"].alias("page_title"),
                                          r["count_views"].alias("count_views")))
    first = F.col("recs")[0]
    invented = F.array(F.struct(first["domain"].alias("domain"),
                                F.concat(first["page_title"], F.lit(INVENTED_SUFFIX)).alias("page_title"),
                                F.lit(1).alias("count_views")))
    valid_list = F.when(F.col("batch_no") % 4 == 0, F.concat(kept, invented)).otherwise(kept)
    variant = (F.col("bucket") + F.col("batch_no")) % 6
    reply = (F.when(variant == 0, F.to_json(F.struct(valid_list.alias("json_output"))))
             .when(variant == 1, F.concat(F.lit("not json: "), first["page_title"]))
             .when(variant == 2, F.lit('{"result": []}'))
             .when(variant == 3, F.to_json(F.struct(F.concat(F.size("recs").cast("string"), F.lit(" records"))
                                                     .alias("json_output"))))
             .when(variant == 4, F.to_json(F.struct(F.array(F.struct(
                 first["page_title"].alias("page_title"), first["count_views"].alias("count_views")))
                 .alias("json_output"))))
             .otherwise(F.lit('{"json_output": [], "csv_output": ""}')))
    return g.select("bucket", "batch_no", reply.alias("reply"))
