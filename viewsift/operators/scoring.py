"""Batch scoring through a pluggable filter (L1–L8, J5), re-aimed from a local LLM loop.

Plan: candidate rows → ``assign_batches`` (row numbers by a
range-partitioned sort, written once; no oversized bucket in one task) →
``build_prompts`` (one bounded ``collect_list`` per batch) → ``score_batches``
(``mapInPandas``: the only Python hop; one scorer call per batch, errors caught
per batch) → ``reply_status`` / ``reply_rows`` (built-in JSON functions) →
``accepted_rows`` (left-semi join back to the source rows, so company and counts
come from the source, D9) → ``batch_stats`` / ``llm_stats`` (one-row aggregates).

Replies of an external model must be persisted before reuse (``persist_replies``
writes them to a table under ``spark.checkpoint.dir``) so a model is never called
twice; speculation stays off for the scoring stage.
"""

from __future__ import annotations

import csv
import io
import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewsift.functions import rules
from viewsift.functions.numeric import exact_round_pct
from viewsift.operators.ranking import sorted_row_number
from viewsift.session import delete_path, filesystem, materialize, ship_package
from viewsift.sources.files import QUOTING, csv_text_column

DEFAULT_BATCH_SIZE = 50
SECONDS_PER_BATCH = 30        # cost estimate per batch (L8)
LARGE_INPUT_ROWS = 10_000     # warn above this many input rows (L8)
RECORD_FIELDS = ["domain", "page_title", "count_views"]

# Written from the verdict categories of ``rules.VERDICT_RULES``.
PROMPT_TEMPLATE = (
    "You are given {n} pageview records as a JSON array. A record stays when its title names a product,\n"
    "service, device, application, game or platform of one of the tracked companies. A record goes when its\n"
    "title is about a person or role, a legal form or case, a list or history, a building, an event, a film,\n"
    "book or show, a technical format, a web address, a typeface, a year, or money matters. If unsure, it stays.\n"
    "Copy records unchanged and add no record of your own.\n"
    "RECORDS:\n{records}\n"
    'Reply with one JSON object: {{"json_output": [kept records], "csv_output": "the same as CSV with a header"}}\n'
)


# --------------------------------------------------------------------------- L1 batches

def rows_bucket(cols: Sequence[str], n_buckets: int) -> Column:
    """Bucket of a row from a hash of its columns."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(int(n_buckets)))


#: Bits of a row's hash that buckets are named by, and the levels below a date's least depth that are counted.
HASH_BITS = 60
LEVELS = 14
#: A date's least depth leaves nodes of about 64 to 128 batches: far more rows than any node has by chance alone.
LEAST_NODE_BATCHES = 64


def row_hash(cols: Sequence[str]) -> Column:
    """The first ``HASH_BITS`` bits of the MD5 of a row's columns as text."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def sticky_buckets(df: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, day: str = "processing_date",
                   cols: Sequence[str] = ("domain", "page_title", "count_views", "source_file")) -> DataFrame:
    """L1: ``df`` plus ``depth``, ``prefix`` and ``bucket``: extendible hashing per date.

    A row's hash, bit by bit, is its path in the binary tree of its date; its bucket
    is the first node on the path with at most ``batch_size`` rows. So a date's buckets
    depend on its own rows alone, and one more row changes one bucket or splits it in
    two: the prompts of all others stay as they were.

    Rows are first counted per cell, a node ``LEVELS`` below the date's least depth (a
    power of two of its rows), which folds equal rows before any shuffle; the tree is
    summed over the cells. Equal rows that no depth can part share a bucket larger than
    a batch (``assign_batches`` cuts it).
    """
    rows = df.withColumn("_hash", row_hash(cols))
    n_batches = F.greatest(F.col("_n") / (batch_size * LEAST_NODE_BATCHES), F.lit(1.0))
    days = rows.groupBy(day).agg(F.count(F.lit(1)).alias("_n")).select(day, F.floor(F.log2(n_batches)).cast("int").alias("_least"))

    def node(depth: str) -> Column:
        return F.expr(f"shiftright(_hash, {HASH_BITS} - ({depth}))")
    rows = rows.join(days, rows[day].eqNullSafe(days[day]), "left").drop(days[day])
    rows = rows.withColumn("_cell", node(f"_least + {LEVELS}"))
    cells = rows.groupBy(day, "_least", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    top, depth = F.expr(f"shiftright(_cell, {LEVELS})"), F.col("_least") + LEVELS
    # A top node's cells (at most 2 ** LEVELS) stay in one partition over all levels: one shuffle, not one a level.
    cells = cells.withColumn("_top", top).repartition(day, "_top")
    for k in reversed(range(LEVELS)):  # the least depth that is small enough is set last
        path = F.expr(f"shiftright(_cell, {LEVELS - k})")
        own = F.sum("_n").over(Window.partitionBy(day, "_top", path))
        depth = F.when(own <= batch_size, F.col("_least") + k).otherwise(depth)
    cells = cells.select(day, "_cell", depth.alias("depth"))
    out = rows.join(cells.withColumnRenamed(day, "_day"), F.col(day).eqNullSafe(F.col("_day")) & (rows["_cell"] == cells["_cell"]))
    out = out.withColumn("prefix", node("depth"))
    return out.select(*df.columns, "depth", "prefix", F.xxhash64(day, "depth", "prefix").alias("bucket"))


def assign_batches(df: DataFrame, batch_size: int = DEFAULT_BATCH_SIZE, n_buckets: int = 1,
                   bucket: Column | None = None, order: Sequence[Column | str] | None = None) -> DataFrame:
    """L1: ``bucket``, ``batch_no`` and ``row_in_batch`` for every row (materialised once).

    Rows are numbered inside each bucket in ``order`` (default: views descending,
    as the prefilter orders them, then every other column) and cut into batches
    of ``batch_size``. The default single bucket is exactly the sequential
    batching of the original. The numbering is ``sorted_row_number``, a
    range-partitioned sort, so neither one bucket nor a group of identical rows
    lands whole in one task; ``n_buckets`` hash buckets or a given ``bucket`` expression only change
    which rows share a batch. The sorted rows are written as a table, so prompts,
    the join back and the statistics all read the same batches.
    """
    if bucket is None:
        bucket = rows_bucket(df.columns, n_buckets) if n_buckets > 1 else F.lit(0)
    order = list(order) if order else [F.col("count_views").desc(), *[F.col(c) for c in df.columns
                                                                     if c != "count_views"]]
    numbered = sorted_row_number(df.withColumn("bucket", bucket.cast("long")), ["bucket"], order, "_rn")
    rn = F.col("_rn") - 1
    return (numbered.withColumn("batch_no", F.floor(rn / int(batch_size)).cast("long"))
            .withColumn("row_in_batch", (rn % int(batch_size)).cast("long"))
            .drop("_rn"))


BATCH_KEY = ["bucket", "batch_no"]


# --------------------------------------------------------------------------- L2 prompts

def build_prompts(batched: DataFrame, template: str = PROMPT_TEMPLATE,
                  fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """L2: one prompt per batch: the records as a JSON array, in batch order.

    ``collect_list`` runs per batch, so its size is bounded by the batch size.
    """
    rec = F.struct(F.col("row_in_batch").alias("_i"), *[F.col(c) for c in fields])
    agg = batched.groupBy(*BATCH_KEY).agg(F.sort_array(F.collect_list(rec)).alias("_recs"))
    records = F.to_json(F.transform("_recs", lambda r: r.dropFields("_i")))
    head, tail = template.split("{records}")
    n = F.size("_recs").cast("string")
    h1, h2 = head.split("{n}")
    prompt = F.concat(F.lit(h1.replace("{{", "{").replace("}}", "}")), n,
                      F.lit(h2.replace("{{", "{").replace("}}", "}")), records,
                      F.lit(tail.replace("{{", "{").replace("}}", "}")))
    return agg.select(*BATCH_KEY, F.size("_recs").cast("long").alias("n_records"), prompt.alias("prompt"))


def prompt_records(prompt: str) -> list[dict]:
    """The records block of a prompt made by ``build_prompts``."""
    m = re.search(r"RECORDS:\n(\[.*?\])\n", prompt, flags=re.S)
    return json.loads(m.group(1)) if m else []


# --------------------------------------------------------------------------- L3 scoring

Scorer = Callable[[str], str]


class RuleScorer:
    """The rule verdict (L4) as a callable over a prompt: the shape of any external scorer.

    Same rule table as the native ``verdict_expr``; returns the reply JSON the
    reply validation expects. ``score_batches`` needs it only to try the callable
    path; its default answers natively.
    """

    def __init__(self) -> None:
        self._rules = [(label, re.compile(rules.portable(p))) for label, p in rules.VERDICT_RULES]

    def verdict(self, title: str) -> str:
        n = title.lower().replace("_", " ")
        for label, pat in self._rules:
            if pat.search(n):
                return label
        return rules.DEFAULT_VERDICT

    def __call__(self, prompt: str) -> str:
        kept = [r for r in prompt_records(prompt) if self.verdict(str(r.get("page_title", ""))).startswith("keep:")]
        text = io.StringIO()
        if kept:
            csv.writer(text, lineterminator="\n").writerows([RECORD_FIELDS, *([r[f] for f in RECORD_FIELDS] for r in kept)])
        return json.dumps({"json_output": kept, "csv_output": text.getvalue()})


def _scoring_fn(scorer: Scorer):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies, status, errors = [], [], []
            for prompt in pdf["prompt"]:
                try:
                    replies.append(scorer(prompt))
                    status.append("ok")
                    errors.append(None)
                except Exception as e:  # any failure → empty result for this batch, not a job error
                    replies.append(None)
                    status.append("error")
                    errors.append(f"{type(e).__name__}: {e}")
            yield pdf[BATCH_KEY].assign(reply=replies, call_status=status, call_error=errors)
    return run


def native_replies(prompts: DataFrame) -> DataFrame:
    """L3 with the rule verdict (L4) as built-in expressions: what ``RuleScorer`` answers, without Python.

    The prompt's records are parsed back from its JSON block, the kept ones are
    written as the reply's ``json_output`` and, as quoted CSV lines, ``csv_output``.
    """
    head, tail = PROMPT_TEMPLATE.replace("{{", "{").replace("}}", "}").split("{records}")
    start = F.locate("RECORDS:\n", F.col("prompt")) + len("RECORDS:\n")
    block = F.expr(f"substring(prompt, _start, length(prompt) - _start + 1 - {len(tail)})")
    record = "array<struct<domain: string, page_title: string, count_views: bigint>>"
    rows = prompts.withColumn("_start", start).withColumn("_records", F.from_json(block, record))
    flat = rows.select(*BATCH_KEY, F.posexplode_outer("_records").alias("_i", "_r"))
    flat = flat.withColumn("page_title", F.coalesce(F.col("_r.page_title"), F.lit("")))
    # Columns of their own, each read more than once: the rules run in generated code, not inside the aggregate.
    flat = flat.withColumn("_norm", rules.normalised_title("page_title"))
    flat = flat.withColumn("_keep", rules.verdict_expr(normalised=F.col("_norm")).startswith("keep:") & F.col("_r").isNotNull())
    line = F.to_csv(F.struct(*[F.col(f"_r.{f}").alias(f) for f in RECORD_FIELDS]), QUOTING)
    own = flat.groupBy(*BATCH_KEY).agg(F.sort_array(F.collect_list(
        F.when(F.col("_keep"), F.struct("_i", F.col("_r").alias("r"), line.alias("line"))))).alias("_kept"),  # a batch at most
        F.count_if("_keep").alias("_n_kept"))
    lines = F.when(F.col("_n_kept") == 0, "").otherwise(F.concat(
        F.lit(",".join(RECORD_FIELDS) + "\n"), F.array_join(F.transform("_kept", lambda k: k["line"]), "\n"), F.lit("\n")))
    reply = F.to_json(F.struct(F.transform("_kept", lambda k: k["r"]).alias("json_output"), lines.alias("csv_output")))
    return own.select(*BATCH_KEY, reply.alias("reply"), F.lit("ok").alias("call_status"),
                      F.lit(None).cast("string").alias("call_error"))


def score_batches(prompts: DataFrame, scorer: Scorer | None = None, parallelism: int | None = None) -> DataFrame:
    """L3: one reply per batch.

    Without a ``scorer`` the rules answer natively (``native_replies``). A given
    ``scorer(prompt) -> reply`` is called once per batch inside ``mapInPandas``;
    ``parallelism`` sets how many tasks (concurrent calls) run.
    """
    if scorer is None:
        return native_replies(prompts)
    ship_package(prompts.sparkSession)
    df = prompts.select(*BATCH_KEY, "prompt")
    if parallelism:
        df = df.repartition(int(parallelism), *BATCH_KEY)
    return df.mapInPandas(_scoring_fn(scorer),
                          "bucket long, batch_no long, reply string, call_status string, call_error string")


STORED = "prompt_md5 string, reply string, call_status string, call_error string"


def replies_in_flight(store_path: str) -> str:
    return store_path.rstrip("/") + "_inflight"


def stored_replies(spark: SparkSession, store_path: str) -> DataFrame:
    """All replies known: the store's, and those of a run that has not ended (or broke off)."""
    out = spark.createDataFrame([], STORED)
    for read, path in ((spark.read.schema(STORED).parquet, store_path), (spark.read.schema(STORED).json, replies_in_flight(store_path))):
        try:
            out = out.unionByName(read(path))
        except AnalysisException:  # none yet
            pass
    return out.dropDuplicates(["prompt_md5"])


def _committing_fn(scorer: Scorer, target: str):
    """Task: asks for each prompt and writes its reply, before the next one, as a file named by the prompt."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = filesystem(target)
        fs.create_dir(root, recursive=True)
        for pdf in batches:
            errors = []
            for md5, prompt in zip(pdf["prompt_md5"], pdf["prompt"]):
                path, error = f"{root}/{md5}.json", None
                if not fs.get_file_info(path).is_file:  # else a task that this one repeats has asked
                    try:
                        reply = scorer(prompt)
                    except Exception as e:  # any failure → no reply for this batch, not a job error
                        error = f"{type(e).__name__}: {e}"
                    else:
                        record = {"prompt_md5": md5, "reply": reply, "call_status": "ok"}
                        hidden = f"{root}/.{md5}.{uuid.uuid4().hex}.tmp"
                        with fs.open_output_stream(hidden, compression=None) as f:
                            f.write((json.dumps(record) + "\n").encode())
                        fs.move(hidden, path)
                errors.append(error)
            yield pdf[["prompt_md5"]].assign(call_error=errors)
    return run


def score_batches_stored(prompts: DataFrame, store_path: str, scorer: Scorer | None = None,
                         parallelism: int | None = None) -> DataFrame:
    """L3, idempotent and resumable: replies are kept in a table keyed by ``md5(prompt)``.

    Only distinct prompts without a reply reach the scorer. Every reply is written as
    soon as it comes, beside the store, so a job that is killed (or a task that is
    repeated after losing its executor) asks only for the rest. When all are there they
    are moved into the store as one append. Failed calls are not stored, so they are
    retried next time. One job at a time uses a store.
    """
    spark = prompts.sparkSession
    keyed = prompts.withColumn("prompt_md5", F.md5("prompt"))
    todo = keyed.select("prompt_md5", "prompt").dropDuplicates(["prompt_md5"]) \
        .join(stored_replies(spark, store_path).select("prompt_md5"), "prompt_md5", "left_anti")
    if parallelism:
        todo = todo.repartition(int(parallelism), "prompt_md5")
    ship_package(spark)
    # written: later readers must not run the scorer again
    failed = materialize(todo.mapInPandas(_committing_fn(scorer or RuleScorer(), replies_in_flight(store_path)),
                                          "prompt_md5 string, call_error string").where("call_error IS NOT NULL"), "failed-calls")
    try:
        spark.read.schema(STORED).json(replies_in_flight(store_path)).dropDuplicates(["prompt_md5"]) \
            .write.mode("append").parquet(store_path)
    except AnalysisException:  # no reply came
        pass
    delete_path(spark, replies_in_flight(store_path))
    known = stored_replies(spark, store_path).select("prompt_md5", "reply", "call_status")
    return keyed.join(known, "prompt_md5", "left").join(failed, "prompt_md5", "left").select(
        *BATCH_KEY, "reply", F.coalesce("call_status", F.lit("error")).alias("call_status"), "call_error")


def persist_replies(replies: DataFrame) -> DataFrame:
    """Cut lineage after scoring: the replies become a table under ``spark.checkpoint.dir``.

    One job writes them (an eager ``checkpoint()`` would run the scorer twice), and
    later actions read the table, so they never call the model again.
    """
    return materialize(replies, "scorer-replies")


# --------------------------------------------------------------------------- L5 reply validation

def reply_status_expr(reply: Column) -> Column:
    """``ok`` / ``empty`` / ``null`` / ``bad_json`` / ``not_object`` / ``missing_key`` /
    ``not_list`` / ``bad_record`` for a raw reply string.

    ``[]`` is ``empty``; a first record lacking a required key (presence, not
    value) is ``bad_record``, as the original checks only the first record.
    """
    out = F.get_json_object(reply, "$.json_output")
    n = F.json_array_length(out)
    first_keys = F.json_object_keys(F.get_json_object(reply, "$.json_output[0]"))
    has_fields = F.coalesce(
        F.forall(F.array(*[F.lit(f) for f in RECORD_FIELDS]), lambda f: F.array_contains(first_keys, f)),
        F.lit(False))
    return (F.when(reply.isNull(), F.lit("null"))
            .when(F.try_parse_json(reply).isNull(), F.lit("bad_json"))
            .when(F.json_object_keys(reply).isNull(), F.lit("not_object"))
            .when(out.isNull(), F.lit("missing_key"))
            .when(n.isNull(), F.lit("not_list"))
            .when(n == 0, F.lit("empty"))
            .when(~has_fields, F.lit("bad_record"))
            .otherwise(F.lit("ok")))


def reply_status(replies: DataFrame, reply_col: str = "reply") -> DataFrame:
    return replies.withColumn("status", reply_status_expr(F.col(reply_col)))


def reply_rows(replies: DataFrame, reply_col: str = "reply", status_col: str | None = None) -> DataFrame:
    """Records of the ``ok`` replies, one row each, with their position; ``status_col`` holds statuses known already."""
    ok = replies.where(F.col(status_col) == "ok") if status_col else \
        reply_status(replies, reply_col).where(F.col("status") == "ok")
    elems = F.from_json(F.col(reply_col), "struct<json_output: array<string>>")["json_output"]
    ex = ok.select(*BATCH_KEY, F.posexplode(elems).alias("pos", "_rec"))
    return ex.select(*BATCH_KEY, F.col("pos").cast("long").alias("pos"),
                     F.get_json_object("_rec", "$.domain").alias("domain"),
                     F.get_json_object("_rec", "$.page_title").alias("page_title"),
                     F.get_json_object("_rec", "$.count_views").try_cast("long").alias("count_views"))


def csv_fallback(rows: DataFrame) -> DataFrame:
    """CSV text per batch from reply records (when a reply lacks ``csv_output``)."""
    return csv_text_column(rows, BATCH_KEY, RECORD_FIELDS, order_cols=["pos"])


# --------------------------------------------------------------------------- J5 accepted / invented

def accepted_rows(batched: DataFrame, rows: DataFrame) -> DataFrame:
    """Source rows whose key a reply kept (left semi join; right side de-duplicated first)."""
    keys = rows.select(*BATCH_KEY, "domain", "page_title").distinct()
    return batched.join(keys, [*BATCH_KEY, "domain", "page_title"], "left_semi")


def invented_rows(batched: DataFrame, rows: DataFrame) -> DataFrame:
    """Reply records that match no row of their batch (left anti join)."""
    keys = batched.select(*BATCH_KEY, "domain", "page_title").distinct()
    return rows.join(keys, [*BATCH_KEY, "domain", "page_title"], "left_anti")


# --------------------------------------------------------------------------- L6–L8 statistics

def batch_stats(statuses: DataFrame) -> DataFrame:
    """Batch counts; an empty list counts as failed, as the original counts it."""
    s = F.col("status")
    return statuses.agg(
        F.count(F.lit(1)).alias("total_batches"),
        F.count_if(s == "ok").alias("successful_batches"),
        F.count_if(s != "ok").alias("failed_batches"),
        F.count_if(s == "empty").alias("empty_batches"),
        F.count_if(~s.isin("ok", "empty")).alias("invalid_batches"))


def llm_stats(batched: DataFrame, statuses: DataFrame, rows: DataFrame,
              batch_size: int = DEFAULT_BATCH_SIZE) -> DataFrame:
    """L7 + L8: one row of filter statistics; every column present even with no output.

    ``filter_rate_pct`` here is the share *removed* (D13), unlike the view's kept share.
    """
    st = batch_stats(statuses)
    # The two other counts enter as scalar subqueries of one-row aggregates.
    i = batched.agg(F.count(F.lit(1))).scalar()
    o = rows.agg(F.count(F.lit(1))).scalar()
    est_batches = F.ceil(i / int(batch_size)).cast("long")
    return st.select(
        i.alias("input_records"), o.alias("output_records"), (i - o).alias("removed_records"),
        F.when(o == 0, F.lit(100.0)).otherwise(F.coalesce(exact_round_pct(i - o, i), F.lit(0.0)))
        .alias("filter_rate_pct"),
        F.when(o == 0, F.lit(0.0)).otherwise(F.coalesce(exact_round_pct(o, i), F.lit(0.0))).alias("kept_rate_pct"),
        "total_batches", "successful_batches", "failed_batches",
        (est_batches * SECONDS_PER_BATCH).alias("estimated_seconds"),
        (i > LARGE_INPUT_ROWS).alias("large_input"))
