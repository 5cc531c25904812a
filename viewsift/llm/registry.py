"""The registered queries of this subpackage: one per operator, over whole tables.

Each query reads its table with Spark, calls its operator with production
parameters and derives the digest columns of its contract. ``ORACLE_SQL`` has
the DuckDB text where SQL can state the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewsift.llm import align, ann, bpe, chat, langid, line_dedup, lm, mixing, quality, quality_model, runs, simhash, urls
from viewsift.llm.common import WORD_BREAK, id_text
from viewsift.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.line_dedup(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.bpe_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = urls.url_filter(table(spark, sf_dir, "pages").select("page_id", "url"))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.stored_ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return quality.judged(ledger).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("kept_base")).alias("base_failed"),
        F.col("kept_v2").alias("kept"), "kept_v1", F.col("failed").alias("failed_rules"), "only_rule", "n_only_this_rule")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


def with_loops(docs: DataFrame) -> DataFrame:
    """The input of op11: a tenth of the texts, chosen by crc32 of doc_id (missing: of the empty text), end in a loop of words."""
    h = F.crc32(id_text(F.col("doc_id")).cast("binary"))
    rows = docs.select("doc_id", "text", h.alias("_h"), F.floor(h / 10).cast("long").alias("_g"),
                       F.array_remove(F.split(F.coalesce("text", F.lit("")), WORD_BREAK), "").alias("_w"))
    rows = rows.withColumn("_n", F.size("_w")).withColumn("_a", F.expr("if(_n > 0, _g % _n, 0)"))
    rows = rows.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    loop = F.expr("array_join(concat(slice(_w, 1, int(_a)), slice(flatten(array_repeat(slice(_w, int(_a) + 1, int(_p)),"
                  " int((_n - _a) div _p) + 1)), 1, int(_n - _a))), ' ')")
    return rows.select("doc_id", F.when((F.col("_h") % 10 == 0) & (F.col("_n") > 0), loop).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = runs.periodic_runs(with_loops(table(spark, sf_dir, "documents")))
    exponent = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", exponent,
                      F.sha2(runs.run_lines(F.col("runs")), 256).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align.align(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    out = materialize(out.select("doc_id", *align.COUNTS, digest, *align.LINKS), "aligned")
    return align.judge(out, align.link_counts(out)).select("doc_id", *align.COUNTS, "n_best", "count_sum", "groups_sha256")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_model.score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_bpe": op4_bpe,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_chat_rotation": op6_chat_rotation,
    "op7_url_filter": op7_url_filter,
    "op8_source_mixing": op8_source_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_quality_classifier": op13_quality_classifier,
}

_OP1 = r"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeats AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT keyed.*, repeats.last IS NOT NULL AND doc_id < repeats.last AS gone
  FROM keyed LEFT JOIN repeats ON keyed.k = repeats.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_OP6 = r"""
WITH turns AS (
  SELECT conv_id, role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, coalesce(text, '')) AS seq FROM conversations),
speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role IS NOT NULL AND role <> 'system'),
seen AS (
  SELECT t.conv_id, speaker, (seq - 1) // 256 AS block, seq, text, coalesce(role = speaker, false) AS own,
         CASE WHEN role = 'system' THEN '<|system|>' || chr(10) WHEN role = speaker THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || coalesce(role, 'unknown') || '|>' || chr(10) END AS head
  FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
lines AS (SELECT *, head || text || '<|end|>' || chr(10) AS line FROM seen),
placed AS (
  SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY conv_id, speaker ORDER BY seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS begins FROM lines)
SELECT conv_id, speaker, CAST(block AS BIGINT) AS block, count(*) AS n_turns,
       CAST(sum(CASE WHEN own THEN 1 ELSE 0 END) AS BIGINT) AS n_trained, CAST(min(begins - length(head)) AS BIGINT) AS offset, string_agg(line, '' ORDER BY seq) AS text,
       coalesce(string_agg(CASE WHEN own THEN CAST(CAST(begins AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(begins AS BIGINT) + length(text) AS VARCHAR) END, ','
         ORDER BY seq), '') AS mask
FROM placed GROUP BY conv_id, speaker, block
"""

_OP8 = r"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n_docs, sqrt(count(*)) AS share FROM documents GROUP BY source),
rates AS (
  SELECT source, share / (SELECT sum(share) FROM counts) * (SELECT CAST(sum(n_docs) AS DOUBLE) FROM counts) / n_docs AS rate
  FROM counts),
steps AS (SELECT source, rate, greatest(CAST(ceil(rate / 16.0) AS INT), 1) AS steps FROM rates),
cdf AS (
  SELECT source, rate, steps, 0 AS k, exp(-(rate / steps)) AS p, exp(-(rate / steps)) AS c FROM steps
  UNION ALL
  SELECT source, rate, steps, k + 1, p * (rate / steps) / (k + 1), c + p * (rate / steps) / (k + 1) FROM cdf WHERE k < 80),
below AS (SELECT source, steps, list(c ORDER BY k) AS cs FROM cdf GROUP BY source, steps),
keyed AS (
  SELECT d.*, '11:' || CAST(doc_id AS VARCHAR) AS key, s.rate, s.steps, b.cs
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
  JOIN below b ON d.source IS NOT DISTINCT FROM b.source),
drawn AS (
  SELECT *, list_sum(list_transform(range(1, steps + 1), lambda i: least(80, len(list_filter(cs, lambda c: c <
           (CAST(('0x' || substr(md5(key || ':draw:' || CAST(i AS VARCHAR)), 1, 13)) AS BIGINT) + 0.5)
           / 4503599627370496.0))))) AS n FROM keyed),
copied AS (SELECT *, unnest(range(1, CAST(n AS BIGINT) + 1)) AS copy FROM drawn WHERE n > 0)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS BIGINT) AS copy, CAST(n AS BIGINT) AS n_copies, rate,
       md5(key || ':order:' || CAST(copy AS VARCHAR)) AS mix_key
FROM copied
"""

_OP9 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS n_stutters,
         length(t) - length(regexp_replace(t, '[@UNSPACED@]', '', 'g')) AS n_unspaced
  FROM d LEFT JOIN repeats r ON d.doc_id = r.doc_id),
f AS (
  SELECT *, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, len(l) AS n_text_lines FROM m),
b AS (
  SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
          + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
          + CASE WHEN 100 * n_dup_lines > 50 * n_text_lines THEN 8 ELSE 0 END
          + CASE WHEN 100 * n_stutters > 30 * n_words THEN 16 ELSE 0 END
          + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars - n_unspaced > 20 * n_words) THEN 32 ELSE 0 END AS bits FROM f),
alone AS (SELECT bits, rule, (SELECT count(*) FROM b WHERE b.bits = a.bits) AS n FROM (VALUES (1, 'few_words'), (2, 'repeats'),
  (4, 'symbols'), (8, 'dup_lines'), (16, 'stutters'), (32, 'word_length')) a(bits, rule))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (b.bits & 3) <> 0 AS base_failed, b.bits = 0 AS kept, (b.bits & 31) = 0 AS kept_v1, CAST(b.bits AS BIGINT) AS failed_rules,
       rule AS only_rule, n AS n_only_this_rule FROM b LEFT JOIN alone ON b.bits = alone.bits
""".replace("@UNSPACED@", "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in quality.UNSPACED_RANGES))

ORACLE_SQL = {"op1_line_dedup": _OP1, "op6_chat_rotation": _OP6, "op8_source_mixing": _OP8, "op9_quality_rules": _OP9}
