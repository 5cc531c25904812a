"""ANSI SQL oracles (DuckDB) for the registered queries.

Each oracle rebuilds the testbed tables from the given views (``events``,
``pages``) with plain SQL, then states the query the way the original warehouse
states it (CTEs, correlated subqueries, cross join). The Spark side is written
independently in the DataFrame API; both read the same rule data.
"""

from __future__ import annotations

from viewsift.functions import rules
from viewsift.functions.numeric import sql_round_div, sql_round_pct
from viewsift.sources import testbed

AS_OF_SQL = f"DATE '{testbed.AS_OF.isoformat()}'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def adapter_ctes() -> str:
    values = ", ".join(f"({k}, {_q(t)})" for k, t in enumerate(testbed.CATALOGUE_TITLES))
    labels = testbed.SENTIMENT_BY_MOD3
    return f"""
catalogue(k, title) AS (VALUES {values}),
raw_full AS (
  SELECT CASE WHEN e.user_id % 3 = 0 THEN 'en.m' ELSE 'en' END AS domain,
         CASE WHEN e.event_id % 3 = 0 THEN 'Google_Maps_' || CAST(e.event_id % 100003 AS VARCHAR)
              WHEN e.event_id % 12 = 1 THEN c.title || ',_No._' || CAST(e.event_id % 7 AS VARCHAR)
              WHEN e.event_id % 12 = 2 THEN '"' || c.title || '"'
              WHEN e.event_id % 12 = 4 THEN c.title || chr(92) || '_II'
              WHEN e.event_id % 12 = 5 THEN c.title || '_Café'
              ELSE c.title END AS page_title,
         CAST(floor(e.value * 100) AS INTEGER) AS count_views,
         'pageviews-' || strftime(e.ts, '%Y%m%d-%H') || '0000.gz' AS source_file,
         CAST(e.ts AS TIMESTAMP) AS loaded_at,
         CAST(e.ts AS DATE) AS processing_date,
         e.event_id
  FROM events e JOIN catalogue c ON e.event_id % {testbed.N_TITLES} = c.k
),
raw_pageviews AS (
  SELECT domain, page_title, count_views, source_file, loaded_at, processing_date FROM raw_full
),
candidates AS (
  SELECT *, {rules.sql_company()} AS company FROM raw_full
  WHERE count_views >= {rules.DEFAULT_MIN_VIEWS} AND {rules.sql_stage_b()} AND {rules.sql_stage_c()}
),
verdicts AS (SELECT *, {rules.sql_verdict()} AS verdict FROM candidates),
filtered_full AS (
  SELECT domain, page_title, count_views, company, loaded_at AS filtered_at, processing_date,
         {_q(testbed.FILTER_METHOD)} AS filter_method, event_id
  FROM (SELECT *, row_number() OVER (PARTITION BY domain, page_title, processing_date
                                     ORDER BY count_views DESC, event_id) AS rn
        FROM verdicts WHERE verdict LIKE 'keep:%')
  WHERE rn = 1
),
filtered_pageviews AS (
  SELECT domain, page_title, count_views, company, filtered_at, processing_date, filter_method
  FROM filtered_full
),
sentiment_results AS (
  SELECT page_title, company,
         CASE event_id % 3 WHEN 0 THEN {_q(labels[0])} WHEN 1 THEN {_q(labels[1])} ELSE {_q(labels[2])} END
           AS sentiment_label,
         CAST(CAST((event_id % 2001) - 1000 AS DECIMAL(10,0)) / 1000 AS DECIMAL(4,3)) AS sentiment_score,
         count_views, processing_date, filtered_at AS analyzed_at, event_id
  FROM (SELECT *, row_number() OVER (PARTITION BY page_title, processing_date
                                     ORDER BY count_views DESC, event_id) AS rn
        FROM filtered_full)
  WHERE rn = 1
)"""


def with_adapter(body_ctes: str, select: str) -> str:
    extra = f",\n{body_ctes}" if body_ctes else ""
    return f"WITH {adapter_ctes()}{extra}\n{select}"


def _window(days: int) -> str:
    return f"processing_date >= {AS_OF_SQL} - INTERVAL '{int(days)} days'"


# --------------------------------------------------------------------------- analytics

def _per_company(rows: str) -> str:
    """Each company's figures over ``rows``; its rank counts the companies with a larger total."""
    return f"""
own AS (SELECT company, CAST(count_views AS HUGEINT) AS v FROM {rows}),
figures AS (
  SELECT company, count(*) AS page_count, CAST(sum(v) AS BIGINT) AS total_views, max(v) AS max_views, min(v) AS min_views,
         CAST(quantile_cont(CAST(v AS DOUBLE), 0.5) AS DOUBLE) AS median_views
  FROM own GROUP BY company),
ranked AS (
  SELECT 1 + (SELECT count(*) FROM figures o WHERE o.total_views > f.total_views) AS rank, company, page_count, total_views,
         {sql_round_div('total_views', 'page_count')} AS avg_views, median_views, max_views, min_views,
         {sql_round_pct('total_views', '(SELECT sum(v) FROM own)')} AS market_share_pct
  FROM figures f)"""


RANKED = ("rank, company, page_count, total_views, avg_views, median_views, CAST(max_views AS INTEGER) AS max_views, "
          "CAST(min_views AS INTEGER) AS min_views, market_share_pct")


def company_rankings() -> str:
    day = f"(SELECT * FROM filtered_pageviews WHERE processing_date = {AS_OF_SQL})"
    return with_adapter(_per_company(day), f"SELECT {RANKED}, {AS_OF_SQL} AS report_date FROM ranked")


def share_large_totals(factor: int) -> str:
    rows = (f"(SELECT company, CAST(count_views AS HUGEINT) * {factor} AS count_views FROM filtered_pageviews "
            f"WHERE {_window(30)})")
    wide = RANKED.replace("INTEGER", "BIGINT")
    return with_adapter(_per_company(rows), f"SELECT {wide} FROM ranked")


def rankings_window(days: int = 7, companies: list[str] | None = None) -> str:
    where = f"WHERE company IN ({', '.join(_q(c) for c in companies)})" if companies else ""
    return with_adapter(_per_company(f"(SELECT * FROM filtered_pageviews WHERE {_window(days)})"),
                        f"SELECT {RANKED} FROM ranked {where}")


def _winner_sql(where: str, report_date: bool) -> str:
    """The company nobody exceeds beside each one that exactly one company exceeds."""
    day = f", {AS_OF_SQL} AS report_date" if report_date else ""
    return with_adapter(f"""
sums AS (
  SELECT company, count(*) AS pages, CAST(sum(count_views) AS BIGINT) AS views
  FROM filtered_pageviews WHERE {where} GROUP BY company),
placed AS (SELECT *, (SELECT count(*) FROM sums o WHERE o.views > s.views) AS above FROM sums s)""", f"""
SELECT best.company AS winner_company, best.pages AS winner_page_count, best.views AS winner_total_views,
       next.company AS runner_up_company, next.views AS runner_up_views, best.views - next.views AS lead_by_views,
       {sql_round_pct('best.views - next.views', 'next.views')} AS lead_percentage,
       (SELECT CAST(sum(views) AS BIGINT) FROM sums) AS grand_total_views,
       {sql_round_pct('best.views', '(SELECT sum(views) FROM sums)')} AS winner_market_share {day}
FROM placed best JOIN placed next ON best.above = 0 AND next.above = 1""")


def biggest_company() -> str:
    return _winner_sql(f"processing_date = {AS_OF_SQL}", True)


def winner_window(days: int = 7) -> str:
    return _winner_sql(_window(days), False) + "\nORDER BY next.company LIMIT 1"


def filtered_window(days: int = 7, companies: list[str] | None = None) -> str:
    comp = f" AND company IN ({', '.join(_q(c) for c in companies)})" if companies else ""
    return with_adapter("", f"""
SELECT domain, page_title, count_views, company, processing_date, filtered_at, filter_method
FROM filtered_pageviews WHERE {_window(days)}{comp}""")


def daily_trends(days: int = 7, companies: list[str] | None = None) -> str:
    comp = f" AND company IN ({', '.join(_q(c) for c in companies)})" if companies else ""
    return with_adapter("", f"""
SELECT processing_date, company, COUNT(*) AS page_count, CAST(SUM(count_views) AS BIGINT) AS total_views
FROM filtered_pageviews WHERE {_window(days)}{comp} GROUP BY processing_date, company""")


def top_pages(days: int, k: int, companies: list[str] | None) -> str:
    comp = f" AND company IN ({', '.join(_q(c) for c in companies)})" if companies else ""
    return with_adapter("", f"""
SELECT company, rank, page_title, count_views, processing_date, domain FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY company ORDER BY count_views DESC, processing_date DESC,
                                    domain, page_title) AS BIGINT) AS rank
  FROM filtered_pageviews WHERE {_window(days)}{comp})
WHERE rank <= {int(k)}""")


def overview(days: int = 7) -> str:
    return with_adapter("", f"""
SELECT COUNT(*) AS total_pages, CAST(SUM(count_views) AS BIGINT) AS total_views,
       {sql_round_div('SUM(count_views)', 'COUNT(*)')} AS avg_views,
       COUNT(DISTINCT company) AS companies
FROM filtered_pageviews WHERE {_window(days)}""")


def title_search(query: str, days: int, literal: bool = False) -> str:
    match = f"contains(lower(page_title), {_q(query.lower())})" if literal else f"regexp_matches(page_title, {_q(query)}, 'i')"
    return with_adapter("", f"""
SELECT processing_date, page_title, company, count_views, filter_method
FROM filtered_pageviews WHERE {_window(days)} AND {match}""")


def views_by_sql(days: int) -> str:
    return with_adapter(f"""
raw_days AS (SELECT processing_date, count(*) AS raw_records, count(DISTINCT source_file) AS source_files FROM raw_pageviews GROUP BY 1),
firsts AS (
  SELECT company, processing_date, page_title, row_number() OVER (
    PARTITION BY company ORDER BY count_views DESC, processing_date DESC, domain, page_title) AS rank
  FROM filtered_pageviews WHERE {_window(days)})""", """
SELECT processing_date, company, CAST(sum(count_views) AS BIGINT) AS total_views, any_value(raw_records) AS raw_records,
       any_value(source_files) AS source_files,
       (SELECT page_title FROM firsts t WHERE t.rank = 1 AND t.company = f.company AND t.processing_date = f.processing_date) AS top_page,
       (SELECT CASE WHEN count(*) > 0 THEN count(*) END FROM sentiment_results s
        WHERE s.company = f.company AND s.processing_date = f.processing_date) AS n_sentiments
FROM filtered_pageviews f JOIN raw_days USING (processing_date) GROUP BY processing_date, company""")


def _status(n_out: str) -> str:
    return f"CAST({n_out} AS BIGINT) AS rows_out, CASE WHEN {n_out} > 0 THEN 'ok' ELSE 'zero_rows' END AS status"


def prefilter_status() -> str:
    n = f"(SELECT count(*) FROM candidates c WHERE c.processing_date = {AS_OF_SQL} AND c.processing_date = r.processing_date)"
    return with_adapter("", f"SELECT processing_date, count(*) AS rows_in, {_status(n)} FROM raw_pageviews r GROUP BY processing_date")


def csv_text_status() -> str:
    n = "count(*) FILTER (verdict LIKE 'keep:%')"
    return with_adapter(_batched_ctes(), f"""
SELECT CAST(bucket AS VARCHAR) || '/' || CAST(batch_no AS VARCHAR) AS batch, count(*) AS rows_in, {_status(n)}
FROM batched GROUP BY bucket, batch_no""")


def v_daily_company_summary() -> str:
    return with_adapter("", f"""
SELECT company, processing_date, COUNT(*) AS page_count, CAST(SUM(count_views) AS BIGINT) AS total_views,
       {sql_round_div('SUM(count_views)', 'COUNT(*)')} AS avg_views,
       MAX(count_views) AS max_views, MIN(count_views) AS min_views
FROM filtered_pageviews GROUP BY company, processing_date""")


def v_data_quality_metrics(limit: int | None = None) -> str:
    sub = "(SELECT COUNT(*) FROM filtered_pageviews f WHERE f.processing_date = r.processing_date)"
    tail = f"\nORDER BY processing_date DESC LIMIT {int(limit)}" if limit else ""
    return with_adapter("", f"""
SELECT processing_date, COUNT(*) AS raw_records,
       COALESCE({sub}, 0) AS filtered_records,
       {sql_round_pct(f'COALESCE({sub}, 0)', 'COUNT(*)')} AS filter_rate_pct,
       MIN(loaded_at) AS first_loaded, MAX(loaded_at) AS last_loaded,
       COUNT(DISTINCT source_file) AS source_files
FROM raw_pageviews r GROUP BY processing_date""" + tail)


def v_top_pages_by_company(days: int = 7) -> str:
    return with_adapter("", f"""
SELECT company, page_title, count_views, processing_date, domain,
       CAST(row_number() OVER (PARTITION BY company ORDER BY count_views DESC, processing_date DESC,
                               domain, page_title) AS BIGINT) AS rank
FROM filtered_pageviews WHERE {_window(days)}""")


def v_sentiment_distribution() -> str:
    return with_adapter("", f"""
SELECT company, processing_date, sentiment_label, COUNT(*) AS count,
       {sql_round_div('SUM(CAST(sentiment_score * 1000 AS BIGINT))', 'COUNT(sentiment_score) * 1000', 3)}
         AS avg_score,
       CAST(SUM(count_views) AS BIGINT) AS total_views
FROM sentiment_results GROUP BY company, processing_date, sentiment_label""")


# --------------------------------------------------------------------------- scorer fixtures

def _batched_ctes() -> str:
    n, size = testbed.N_BUCKETS, testbed.BATCH_SIZE
    return f"""
numbered AS (
  SELECT *, event_id % {n} AS bucket,
         row_number() OVER (PARTITION BY event_id % {n}
                            ORDER BY count_views DESC, domain, page_title, processing_date, event_id) - 1 AS rn
  FROM verdicts
),
batched AS (
  SELECT * EXCLUDE (rn), CAST(rn // {size} AS BIGINT) AS batch_no, CAST(rn % {size} AS BIGINT) AS row_in_batch
  FROM numbered
),
batch_recs AS (
  SELECT bucket, batch_no,
         list({{'domain': domain, 'page_title': page_title, 'count_views': count_views}} ORDER BY row_in_batch)
           FILTER (WHERE verdict LIKE 'keep:%') AS kept,
         arg_min(domain, row_in_batch) AS first_domain,
         arg_min(page_title, row_in_batch) AS first_title,
         arg_min(count_views, row_in_batch) AS first_views,
         COUNT(*) AS n
  FROM batched GROUP BY bucket, batch_no
),
replies AS (
  SELECT bucket, batch_no,
    CASE (bucket + batch_no) % 6
      WHEN 0 THEN to_json({{'json_output': CASE WHEN batch_no % 4 = 0
              THEN list_concat(coalesce(kept, []), [{{'domain': first_domain,
                     'page_title': first_title || {_q(testbed.INVENTED_SUFFIX)}, 'count_views': 1}}])
              ELSE coalesce(kept, []) END}})::VARCHAR
      WHEN 1 THEN 'not json: ' || first_title
      WHEN 2 THEN '{{"result": []}}'
      WHEN 3 THEN to_json({{'json_output': CAST(n AS VARCHAR) || ' records'}})::VARCHAR
      WHEN 4 THEN to_json({{'json_output': [{{'page_title': first_title, 'count_views': first_views}}]}})::VARCHAR
      ELSE '{{"json_output": [], "csv_output": ""}}'
    END AS reply
  FROM batch_recs
),
statuses AS (
  SELECT bucket, batch_no, reply,
    CASE
      WHEN reply IS NULL THEN 'null'
      WHEN NOT json_valid(reply) THEN 'bad_json'
      WHEN json_type(reply) <> 'OBJECT' THEN 'not_object'
      WHEN json_type(reply, '$.json_output') IS NULL OR json_type(reply, '$.json_output') = 'NULL'
        THEN 'missing_key'
      WHEN json_type(reply, '$.json_output') <> 'ARRAY' THEN 'not_list'
      WHEN json_array_length(reply, '$.json_output') = 0 THEN 'empty'
      WHEN json_type(reply, '$.json_output[0]') <> 'OBJECT'
        OR NOT list_has_all(json_keys(reply, '$.json_output[0]'), ['domain', 'page_title', 'count_views'])
        THEN 'bad_record'
      ELSE 'ok'
    END AS status
  FROM replies
),
reply_rows AS (
  SELECT bucket, batch_no, CAST(i - 1 AS BIGINT) AS pos,
         json_extract_string(reply, '$.json_output[' || (i - 1) || '].domain') AS domain,
         json_extract_string(reply, '$.json_output[' || (i - 1) || '].page_title') AS page_title,
         TRY_CAST(json_extract_string(reply, '$.json_output[' || (i - 1) || '].count_views') AS BIGINT)
           AS count_views
  FROM statuses, range(1, CAST(json_array_length(reply, '$.json_output') AS BIGINT) + 1) AS r(i)
  WHERE status = 'ok'
)"""


def batches() -> str:
    return with_adapter(_batched_ctes(), """
SELECT bucket, batch_no, row_in_batch, domain, page_title, count_views, processing_date, event_id, company
FROM batched""")


def rule_verdict() -> str:
    return with_adapter("", """
SELECT domain, page_title, count_views, processing_date, company, verdict FROM verdicts""")


def scored_rows() -> str:
    return with_adapter(_batched_ctes(), """
SELECT bucket, batch_no,
       CAST(row_number() OVER (PARTITION BY bucket, batch_no ORDER BY row_in_batch) - 1 AS BIGINT) AS pos,
       domain, page_title, CAST(count_views AS BIGINT) AS count_views
FROM batched WHERE verdict LIKE 'keep:%'""")


def reply_status() -> str:
    return with_adapter(_batched_ctes(), "SELECT bucket, batch_no, status FROM statuses")


def reply_rows() -> str:
    return with_adapter(_batched_ctes(), "SELECT * FROM reply_rows")


def batch_stats() -> str:
    return with_adapter(_batched_ctes(), """
SELECT COUNT(*) AS total_batches, CAST(count_if(status = 'ok') AS BIGINT) AS successful_batches,
       CAST(count_if(status <> 'ok') AS BIGINT) AS failed_batches, CAST(count_if(status = 'empty') AS BIGINT) AS empty_batches,
       CAST(count_if(status NOT IN ('ok', 'empty')) AS BIGINT) AS invalid_batches
FROM statuses""")


def llm_stats() -> str:
    i = "(SELECT COUNT(*) FROM batched)"
    o = "(SELECT COUNT(*) FROM reply_rows)"
    return with_adapter(_batched_ctes(), f"""
SELECT {i} AS input_records, {o} AS output_records, {i} - {o} AS removed_records,
       CASE WHEN {o} = 0 THEN 100.0 ELSE coalesce({sql_round_pct(f'{i} - {o}', i)}, 0.0) END AS filter_rate_pct,
       CASE WHEN {o} = 0 THEN 0.0 ELSE coalesce({sql_round_pct(o, i)}, 0.0) END AS kept_rate_pct,
       COUNT(*) AS total_batches, CAST(count_if(status = 'ok') AS BIGINT) AS successful_batches,
       CAST(count_if(status <> 'ok') AS BIGINT) AS failed_batches,
       CAST(ceil({i} / {testbed.BATCH_SIZE}) AS BIGINT) * 30 AS estimated_seconds,
       {i} > 10000 AS large_input
FROM statuses""")


def accepted_rows() -> str:
    return with_adapter(_batched_ctes(), """
SELECT b.bucket, b.batch_no, b.domain, b.page_title, b.count_views, b.company, b.processing_date
FROM batched b
WHERE EXISTS (SELECT 1 FROM reply_rows r WHERE r.bucket = b.bucket AND r.batch_no = b.batch_no
                AND r.domain = b.domain AND r.page_title = b.page_title)""")


def invented_rows() -> str:
    return with_adapter(_batched_ctes(), """
SELECT r.* FROM reply_rows r
WHERE NOT EXISTS (SELECT 1 FROM batched b WHERE r.bucket = b.bucket AND r.batch_no = b.batch_no
                    AND r.domain = b.domain AND r.page_title = b.page_title)""")


#: A title as a CSV field: quoted where it must be, quotes doubled.
_CSV_TITLE = ("CASE WHEN regexp_matches(page_title, '[,\"]') THEN '\"' || replace(page_title, '\"', '\"\"') || '\"' "
              "ELSE page_title END")


def csv_fallback() -> str:
    return with_adapter(_batched_ctes(), f"""
SELECT bucket, batch_no,
       'domain,page_title,count_views' || chr(10) ||
       string_agg(domain || ',' || {_CSV_TITLE} || ',' || CAST(count_views AS VARCHAR), chr(10) ORDER BY pos)
       || chr(10) AS csv_text
FROM reply_rows GROUP BY bucket, batch_no""")


# --------------------------------------------------------------------------- prefilter, loads, sources

def stage_a() -> str:
    return with_adapter("", f"""
SELECT domain, page_title, count_views FROM raw_pageviews
WHERE processing_date = {AS_OF_SQL} AND count_views >= {rules.DEFAULT_MIN_VIEWS}""")


def stage_b() -> str:
    return with_adapter("", f"""
SELECT domain, page_title, count_views FROM raw_pageviews
WHERE processing_date = {AS_OF_SQL} AND count_views >= {rules.DEFAULT_MIN_VIEWS} AND {rules.sql_stage_b()}""")


def stage_c() -> str:
    return with_adapter("", f"""
SELECT domain, page_title, count_views FROM raw_pageviews
WHERE processing_date = {AS_OF_SQL} AND count_views >= {rules.DEFAULT_MIN_VIEWS}
  AND {rules.sql_stage_b()} AND {rules.sql_stage_c()}""")


def prefilter() -> str:
    return with_adapter("", f"""
SELECT domain, page_title, count_views, {rules.sql_company()} AS company FROM raw_pageviews
WHERE processing_date = {AS_OF_SQL} AND count_views >= {rules.DEFAULT_MIN_VIEWS}
  AND {rules.sql_stage_b()} AND {rules.sql_stage_c()}""")


def company_distribution() -> str:
    return with_adapter("", f"""
SELECT company, COUNT(*) AS page_count FROM (
  SELECT {rules.sql_company()} AS company FROM raw_pageviews
  WHERE processing_date = {AS_OF_SQL} AND count_views >= {rules.DEFAULT_MIN_VIEWS}
    AND {rules.sql_stage_b()} AND {rules.sql_stage_c()})
GROUP BY company""")


def classify_company() -> str:
    return with_adapter("", f"SELECT page_title, {rules.sql_company()} AS company FROM raw_pageviews")


def raw_rows() -> str:
    return with_adapter("", "SELECT * FROM raw_pageviews")


def filtered_rows() -> str:
    return with_adapter("", "SELECT * FROM filtered_pageviews")


def retention(days: int) -> str:
    return with_adapter("", f"SELECT * FROM raw_pageviews WHERE {_window(days)}")


def dump_rows() -> str:
    return with_adapter("", "SELECT domain, page_title, count_views, source_file FROM raw_pageviews")


def stream_rows() -> str:
    return with_adapter("", """
SELECT domain, page_title, count_views, source_file, date_trunc('hour', loaded_at) AS event_hour,
       processing_date
FROM raw_pageviews""")


def stream_daily_summary() -> str:
    return with_adapter("", """
SELECT processing_date, company, COUNT(*) AS page_count, CAST(SUM(count_views) AS BIGINT) AS total_views
FROM candidates GROUP BY processing_date, company""")


def candidate_rows() -> str:
    return with_adapter("", """
SELECT domain, page_title, count_views, company, processing_date FROM candidates""")


def csv_text_parse() -> str:
    return with_adapter(_batched_ctes(), """
SELECT bucket, batch_no,
       CAST(row_number() OVER (PARTITION BY bucket, batch_no ORDER BY row_in_batch) AS BIGINT) AS line_no,
       domain, page_title, count_views
FROM batched WHERE verdict LIKE 'keep:%'""")


def null_fill() -> str:
    from viewsift.sources.dumps import PANDAS_NULL_TOKENS, UNKNOWN
    toks = ", ".join(_q(t) for t in PANDAS_NULL_TOKENS)
    return with_adapter("", f"""
SELECT CASE WHEN domain IS NULL OR domain IN ({toks}) THEN {_q(UNKNOWN)} ELSE domain END AS domain,
       CASE WHEN page_title IS NULL OR page_title IN ({toks}) THEN {_q(UNKNOWN)} ELSE page_title END AS page_title,
       count_views, source_file, loaded_at, processing_date
FROM raw_pageviews""")


def _resolve_sql(base: str, href: str) -> str:
    from viewsift.sources.pages import ORIGIN_PATTERN
    return (f"CASE WHEN regexp_matches({href}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {href} "
            f"WHEN starts_with({href}, '/') THEN regexp_extract({base}, {_q(ORIGIN_PATTERN)}, 1) || {href} "
            f"ELSE regexp_extract({base}, '^([^?#]*/)', 1) || {href} END")


def _links_cte(html: str = "html") -> str:
    return f"""
link_lists AS (SELECT page_id, url, regexp_extract_all({html}, '<a href="([^"]*)"', 1) AS links FROM pages),
links AS (
  SELECT page_id, CAST(i - 1 AS BIGINT) AS link_pos, links[i] AS href, {_resolve_sql('url', 'links[i]')} AS full_url
  FROM link_lists, range(1, len(links) + 1) AS r(i)
)"""


def page_links() -> str:
    return with_adapter(_links_cte(), "SELECT * FROM links")


def gz_links() -> str:
    return with_adapter(_links_cte("replace(html, 'e\">', 'e.gz\">')"), "SELECT * FROM links WHERE href LIKE '%.gz'")


def seeded_pick(seed: str) -> str:
    return with_adapter(_links_cte(), f"""
SELECT page_id, arg_min(full_url, md5({_q(seed)} || full_url)) AS full_url FROM links GROUP BY page_id""")


# --------------------------------------------------------------------------- checks

def extract_checks() -> str:
    return with_adapter("", """
SELECT COUNT(*) AS row_count, TRUE AS has_required_columns, TRUE AS count_views_integer,
       CAST(count_if(domain IS NULL) AS BIGINT) AS null_domain, CAST(count_if(page_title IS NULL) AS BIGINT) AS null_page_title,
       CAST(count_if(count_views IS NULL) AS BIGINT) AS null_count_views, COUNT(*) > 0 AS passed
FROM raw_pageviews""")


def verify_load(source_file: str | None = None) -> str:
    where = f"WHERE source_file = {_q(source_file)}" if source_file else ""
    return with_adapter("", f"""
SELECT source_file, COUNT(*) AS record_count, MIN(loaded_at) AS load_time,
       COUNT(DISTINCT domain) AS domain_count, CAST(SUM(count_views) AS BIGINT) AS total_views
FROM raw_pageviews {where} GROUP BY source_file""")


def _violations(table: str, rules_sql: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT {_q(table)} AS table_name, {_q(name)} AS rule, CAST(count_if(coalesce({cond}, FALSE)) AS BIGINT) AS violations "
        f"FROM {table}" for name, cond in rules_sql)


def constraint_violations() -> str:
    from viewsift import schemas as S

    def nulls(st):
        return [(f"null_{f.name}", f"{f.name} IS NULL") for f in st.fields if not f.nullable]

    def lengths(t):
        return [(f"{c}_too_long", f"length({c}) > {n}") for c, n in S.MAX_LENGTHS[t].items()]

    labels = ", ".join(_q(x) for x in S.SENTIMENT_LABELS)
    parts = [
        _violations("raw_pageviews", nulls(S.RAW_PAGEVIEWS) + [("negative_count_views", "count_views < 0")]
                    + lengths("raw_pageviews")),
        _violations("filtered_pageviews", nulls(S.FILTERED_PAGEVIEWS)
                    + [("negative_count_views", "count_views < 0")] + lengths("filtered_pageviews")),
        _violations("sentiment_results", nulls(S.SENTIMENT_RESULTS)
                    + [("invalid_sentiment_label", f"sentiment_label NOT IN ({labels})"),
                       ("score_out_of_range", "abs(sentiment_score) > 1")] + lengths("sentiment_results")),
    ]
    return with_adapter("", "\nUNION ALL\n".join(parts))


def key_violations() -> str:
    return with_adapter("", f"""
SELECT domain, page_title, processing_date, {_q(testbed.FILTER_METHOD)} AS filter_method, COUNT(*) AS n_rows
FROM candidates GROUP BY domain, page_title, processing_date HAVING COUNT(*) > 1""")


def sentiment_key_violations() -> str:
    return with_adapter("", """
SELECT page_title, processing_date, CAST(2 AS BIGINT) AS n_rows FROM sentiment_results WHERE sentiment_label = 'neutral'""")


def curated_two_loads() -> str:
    return with_adapter("", f"""
SELECT 'max' AS mode, domain, page_title, count_views, company, processing_date, filter_method FROM filtered_pageviews
UNION ALL
SELECT 'sum', domain, page_title, CAST(sum(count_views) AS INTEGER), company, processing_date, {_q(testbed.FILTER_METHOD)}
FROM verdicts WHERE verdict LIKE 'keep:%' GROUP BY domain, page_title, company, processing_date""")


def sticky_batches(size: int = 50, deepest: int = 14) -> str:
    return with_adapter(f"""
hashed AS (
  SELECT processing_date, count_views, row_number() OVER () AS id, CAST(('0x' || substr(md5(
    domain || '|' || page_title || '|' || CAST(count_views AS VARCHAR) || '|' || source_file), 1, 15)) AS BIGINT) AS h FROM candidates),
paths AS (SELECT *, h >> (60 - d) AS p FROM hashed, (SELECT unnest(range({deepest + 1})) AS d)),
nodes AS (SELECT processing_date, d, p, count(*) AS n FROM paths GROUP BY ALL),
own AS (
  SELECT id, min(d) AS d FROM paths JOIN nodes USING (processing_date, d, p) WHERE n <= {size} OR d = {deepest} GROUP BY id)""", """
SELECT processing_date, CAST(d AS INTEGER) AS depth, p AS prefix, count(*) AS n_rows, CAST(sum(count_views) AS BIGINT) AS total_views
FROM paths JOIN own USING (id, d) GROUP BY ALL""")


def daily_rerun(n_bad: int, corrupt: str) -> str:
    return with_adapter("", f"""
SELECT source_file, 'loaded' AS state, count(*) AS n_rows, CAST({n_bad} AS BIGINT) AS n_bad, CAST({n_bad} AS BIGINT) AS n_quarantined
FROM raw_pageviews GROUP BY source_file
UNION ALL SELECT {_q(corrupt)}, 'corrupt', 0, 0, 0""")


def rankings_sketched(days: int) -> str:
    columns = RANKED.replace("median_views, ", "")
    return with_adapter(_per_company(f"(SELECT * FROM filtered_pageviews WHERE {_window(days)})"),
                        f"SELECT {columns}, true AS median_ok FROM ranked")


def stream_quarantine(n_bad: int) -> str:
    return with_adapter("files AS (SELECT count(DISTINCT source_file) AS n FROM raw_pageviews)", f"""
SELECT 'raw' AS fate, count(*) AS n_lines FROM raw_pageviews
UNION ALL SELECT 'field_count', 2 * n FROM files
UNION ALL SELECT 'count_not_integer', n FROM files
UNION ALL SELECT 'negative_count', ({n_bad} - 3) * n FROM files
UNION ALL SELECT 'file_name', count(*) FROM raw_pageviews WHERE source_file LIKE '%-120000.gz' HAVING count(*) > 0""")


def late_row_count() -> str:
    return with_adapter("", """
SELECT processing_date, company, count(*) AS late_rows FROM candidates WHERE day(processing_date) <= 10
GROUP BY processing_date, company""")


def fuzzy_titles(query: str, threshold: float) -> str:
    from viewsift.operators.fuzzy import WORD_SPLIT, trigrams
    q = "[" + ", ".join(_q(t) for t in trigrams(query)) + "]"
    tri = (f"list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower(page_title), "
           f"{_q(WORD_SPLIT)}), lambda w: w <> ''), lambda w: list_transform(range(1, length('  ' || w || ' ') - 1), "
           f"lambda i: substring('  ' || w || ' ', i, 3)))))")
    return with_adapter(f"""
titles AS (SELECT DISTINCT page_title FROM raw_pageviews),
scored AS (
  SELECT page_title, {tri} AS t FROM titles
)""", f"""
SELECT page_title,
       CASE WHEN len(list_distinct(list_concat(t, {q}))) = 0 THEN 0.0
            ELSE len(list_intersect(t, {q})) / len(list_distinct(list_concat(t, {q}))) END AS similarity
FROM scored
WHERE (CASE WHEN len(list_distinct(list_concat(t, {q}))) = 0 THEN 0.0
            ELSE len(list_intersect(t, {q})) / len(list_distinct(list_concat(t, {q}))) END) >= {float(threshold)}""")


def prompts() -> str:
    from viewsift.operators.scoring import PROMPT_TEMPLATE

    head, tail = PROMPT_TEMPLATE.split("{records}")
    h1, h2 = head.split("{n}")
    unb = lambda x: x.replace("{{", "{").replace("}}", "}")
    return with_adapter(_batched_ctes(), f"""
SELECT bucket, batch_no, CAST(COUNT(*) AS BIGINT) AS n_records,
       {_q(unb(h1))} || CAST(COUNT(*) AS VARCHAR) || {_q(unb(h2))} ||
       CAST(to_json(list({{'domain': domain, 'page_title': page_title, 'count_views': count_views}}
                         ORDER BY row_in_batch)) AS VARCHAR) || {_q(unb(tail))} AS prompt
FROM batched GROUP BY bucket, batch_no""")


def score_batches() -> str:
    """Replies by the verdict rules, as compact JSON with quoted CSV."""
    keep = "verdict LIKE 'keep:%'"
    rec = ("'{\"domain\":' || CAST(to_json(domain) AS VARCHAR) || ',\"page_title\":' || "
           "CAST(to_json(page_title) AS VARCHAR) || ',\"count_views\":' || CAST(count_views AS VARCHAR) || '}'")
    line = f"domain || ',' || {_CSV_TITLE} || ',' || CAST(count_views AS VARCHAR) || chr(10)"
    return with_adapter(_batched_ctes(), f"""
SELECT bucket, batch_no,
       '{{"json_output":[' || coalesce(string_agg({rec}, ',' ORDER BY row_in_batch) FILTER (WHERE {keep}), '')
       || '],"csv_output":' || CAST(to_json(CASE WHEN count_if({keep}) = 0 THEN ''
            ELSE 'domain,page_title,count_views' || chr(10)
                 || string_agg({line}, '' ORDER BY row_in_batch) FILTER (WHERE {keep}) END) AS VARCHAR)
       || '}}' AS reply,
       'ok' AS call_status, CAST(NULL AS VARCHAR) AS call_error
FROM batched GROUP BY bucket, batch_no""")


def gz_audit() -> str:
    return with_adapter("", """
SELECT source_file AS file_name, 'ok' AS status, COUNT(*) AS lines FROM raw_pageviews GROUP BY source_file""")
