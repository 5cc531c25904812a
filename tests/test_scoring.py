"""Reply validation modes (L5), batching (L1), scorer failures (L3), stats (L6–L8), CSV text."""

import json

from pyspark.sql import functions as F

from viewsift.operators import scoring as S
from viewsift.sources import files

REC = {"domain": "en", "page_title": "iPhone", "count_views": 5}
REPLIES = {
    0: json.dumps({"json_output": [REC], "csv_output": ""}),
    1: "not json",
    2: json.dumps([REC]),
    3: json.dumps({"other": 1}),
    4: json.dumps({"json_output": None}),
    5: json.dumps({"json_output": "text"}),
    6: json.dumps({"json_output": {"a": 1}}),
    7: json.dumps({"json_output": []}),
    8: json.dumps({"json_output": [{"page_title": "x", "count_views": 1}, REC]}),
    9: json.dumps({"json_output": [{"domain": None, "page_title": "x", "count_views": 1}]}),
    10: None,
}
EXPECTED = {0: "ok", 1: "bad_json", 2: "not_object", 3: "missing_key", 4: "missing_key", 5: "not_list",
            6: "not_list", 7: "empty", 8: "bad_record", 9: "ok", 10: "null"}


def replies_df(spark):
    return spark.createDataFrame([(0, k, v) for k, v in REPLIES.items()], "bucket long, batch_no long, reply string")


def test_reply_status_modes(spark):
    got = {r.batch_no: r.status for r in S.reply_status(replies_df(spark)).collect()}
    assert got == EXPECTED


def test_reply_rows_and_stats(spark):
    rows = S.reply_rows(replies_df(spark))
    assert sorted((r.batch_no, r.page_title) for r in rows.collect()) == [(0, "iPhone"), (9, "x")]
    st = S.batch_stats(S.reply_status(replies_df(spark))).first()
    assert (st.total_batches, st.successful_batches, st.failed_batches, st.empty_batches) == (11, 2, 9, 1)


def test_batches_of_fifty(spark):
    df = spark.range(130).select(F.col("id").cast("int").alias("count_views"), F.lit("en").alias("domain"),
                                 F.col("id").cast("string").alias("page_title"))
    b = S.assign_batches(df, 50, n_buckets=1)
    sizes = sorted(r["count"] for r in b.groupBy("batch_no").count().collect())
    assert sizes == [30, 50, 50]
    first = b.where("batch_no = 0").agg(F.min("count_views")).first()[0]
    assert first == 80  # views descending: the top 50 go first
    many = S.assign_batches(df, 50, n_buckets=4)
    assert many.count() == 130 and many.groupBy("bucket", "batch_no").count().where("count > 50").count() == 0


def test_scorer_failure_is_caught_per_batch(spark):
    df = spark.range(120).select(F.lit(1000).alias("count_views"), F.lit("en").alias("domain"),
                                 F.concat(F.lit("Apple_"), F.col("id").cast("string")).alias("page_title"))
    prompts = S.build_prompts(S.assign_batches(df, 50, n_buckets=1))
    assert sorted(r.n_records for r in prompts.collect()) == [20, 50, 50]

    def flaky(prompt: str) -> str:
        if '"Apple_0"' in prompt:
            raise TimeoutError("model timed out")
        return S.RuleScorer()(prompt)

    out = S.reply_status(S.score_batches(prompts, flaky)).collect()
    assert sorted(r.call_status for r in out) == ["error", "ok", "ok"]
    assert sorted(r.status for r in out) == ["null", "ok", "ok"]


def test_llm_stats_zero_output(spark):
    b = spark.createDataFrame([(0, 0, "en", "X", 1)], "bucket long, batch_no long, domain string, page_title string, count_views int")
    replies = spark.createDataFrame([(0, 0, json.dumps({"json_output": []}))], "bucket long, batch_no long, reply string")
    st = S.llm_stats(b, S.reply_status(replies), S.reply_rows(replies)).first()
    assert (st.input_records, st.output_records, st.removed_records, st.filter_rate_pct, st.kept_rate_pct) == \
        (1, 0, 1, 100.0, 0.0)
    assert st.failed_batches == 1


def test_accepted_and_invented(spark):
    b = spark.createDataFrame([(0, 0, "en", "iPhone", 5, "Apple"), (0, 0, "en", "Kindle", 7, "Amazon")],
                              "bucket long, batch_no long, domain string, page_title string, count_views int, company string")
    rep = spark.createDataFrame([(0, 0, json.dumps({"json_output": [
        {"domain": "en", "page_title": "iPhone", "count_views": 999},
        {"domain": "en", "page_title": "Made_up", "count_views": 1}]}))], "bucket long, batch_no long, reply string")
    rows = S.reply_rows(rep)
    acc = S.accepted_rows(b, rows).collect()
    assert [(r.page_title, r.count_views, r.company) for r in acc] == [("iPhone", 5, "Apple")]  # source counts (D9)
    assert [r.page_title for r in S.invented_rows(b, rows).collect()] == ["Made_up"]


def test_csv_text_parse_and_empty(spark):
    df = spark.createDataFrame([(1, "domain,page_title,count_views\nen,\"A,b\",3\nen.m,C,4\n"), (2, "")],
                               "id long, txt string")
    out = files.parse_csv_text(df, "txt", "domain string, page_title string, count_views long")
    assert sorted((r.id, r.page_title, r.count_views) for r in out.collect()) == [(1, "A,b", 3), (1, "C", 4)]


def test_register_views(spark):
    import datetime as dt

    from viewsift.plans import analytics as A
    from viewsift.sources import testbed as tb
    sf = "/root/testdata/sf0.001"
    names = A.register_views(tb.raw_pageviews(spark, sf, with_event_id=False), tb.filtered_pageviews(spark, sf),
                             tb.sentiment_results(spark, sf), tb.AS_OF)
    assert names == A.VIEW_NAMES
    assert spark.sql("SELECT count(*) FROM v_data_quality_metrics").first()[0] == 30


def test_stored_replies_call_each_prompt_once(spark, tmp_path):
    df = spark.range(120).select(F.lit(1000).alias("count_views"), F.lit("en").alias("domain"),
                                 F.concat(F.lit("Apple_"), F.col("id").cast("string")).alias("page_title"))
    prompts = S.build_prompts(S.assign_batches(df, 50, n_buckets=1))
    calls = spark.sparkContext.accumulator(0)

    def counting(prompt: str) -> str:
        calls.add(1)
        return S.RuleScorer()(prompt)

    store = str(tmp_path / "replies")
    first = S.score_batches_stored(prompts, store, counting).collect()
    assert calls.value == 3 and sorted(r.call_status for r in first) == ["ok"] * 3
    again = S.score_batches_stored(prompts, store, counting).collect()
    assert calls.value == 3  # nothing re-scored
    assert sorted((r.batch_no, r.reply) for r in again) == sorted((r.batch_no, r.reply) for r in first)


def test_batches_of_empty_input_are_empty(spark):
    from viewsift.operators.ranking import sorted_row_number

    df = spark.createDataFrame([], "count_views int, domain string, page_title string")
    assert S.assign_batches(df, 50).count() == 0
    assert sorted_row_number(df, ["domain"], ["page_title"], "rn").count() == 0


ODD_TITLES = ["Amazon,_Inc", '"Apple"_Pay', "Google\\Maps", "Caf\u00e9_Android", "Apple_cup\u00e9", "Pixel_(device)", "Google_CEO"]


def test_native_replies_equal_the_rule_scorer(spark):
    import json

    rows = [(1000 - i, "en", t) for i, t in enumerate(ODD_TITLES)] + [(5, "en", "Apple_Campus")] * 2
    df = spark.createDataFrame(rows, "count_views int, domain string, page_title string")
    prompts = S.build_prompts(S.assign_batches(df, 4)).cache()
    native = {r.batch_no: r for r in S.score_batches(prompts).collect()}
    called = {r.batch_no: r for r in S.score_batches(prompts, S.RuleScorer()).collect()}
    assert set(native) == set(called) == {0, 1, 2}
    for k in native:
        assert json.loads(native[k].reply) == json.loads(called[k].reply) and native[k].call_status == "ok"
    plan = S.score_batches(prompts)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_csv_of_odd_titles_reads_back(spark, tmp_path):
    import glob

    import pandas as pd

    from viewsift.sources import files

    schema = "domain string, page_title string, count_views int"
    df = spark.createDataFrame([("en", t, i) for i, t in enumerate(ODD_TITLES)], schema).coalesce(1)
    files.write_csv(df, str(tmp_path / "csv"))
    assert sorted(files.read_csv(spark, str(tmp_path / "csv"), schema).collect()) == sorted(df.collect())
    back = pd.read_csv(glob.glob(str(tmp_path / "csv" / "part-*.csv"))[0])
    assert sorted(back.page_title) == sorted(ODD_TITLES)
    text = files.csv_text_column(df.withColumn("g", F.lit(1)), ["g"], ["domain", "page_title", "count_views"])
    parsed = files.parse_csv_text(text, "csv_text", schema).select("domain", "page_title", "count_views")
    assert sorted(parsed.collect()) == sorted(df.collect())


def test_malformed_csv_text_fails(spark):
    import pytest

    from viewsift.sources import files

    df = spark.createDataFrame([("a,b\nx,notanumber\n",)], "t string")
    with pytest.raises(Exception, match="notanumber"):
        files.parse_csv_text(df, "t", "a string, b int").collect()


def test_one_new_row_sends_one_prompt(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counting(prompt: str) -> str:
        calls.add(1)
        return S.RuleScorer()(prompt)

    def frame(n):
        return spark.range(n).select((F.col("id") + 1000).cast("int").alias("count_views"), F.lit("en").alias("domain"),
                                     F.concat(F.lit("Apple_"), F.col("id").cast("string")).alias("page_title"),
                                     F.lit("2024-01-30").cast("date").alias("processing_date"))

    def send(df):
        before = calls.value
        rows = S.sticky_buckets(df, 50, cols=["domain", "page_title", "count_views"]).drop("depth", "prefix")
        prompts = S.build_prompts(S.assign_batches(rows, 50, bucket=F.col("bucket")))
        S.score_batches_stored(prompts, str(tmp_path / "store"), counting).count()
        return calls.value - before
    assert send(frame(500)) >= 10
    assert send(frame(501)) == 1


def candidates(spark, day, n, start=0):
    return spark.range(start, start + n).select(
        F.lit("en").alias("domain"), F.concat(F.lit(f"Apple_{day}_"), F.col("id").cast("string")).alias("page_title"),
        (F.col("id") % 977).cast("int").alias("count_views"), F.lit("f").alias("source_file"),
        F.lit(f"2024-01-{day:02d}").cast("date").alias("processing_date"))


def prompt_texts(df):
    rows = S.sticky_buckets(df).drop("depth", "prefix")
    return {r.prompt for r in S.build_prompts(S.assign_batches(rows, bucket=F.col("bucket"))).collect()}


def test_other_dates_leave_a_dates_prompts_as_they_were(spark):
    one = prompt_texts(candidates(spark, 1, 200))
    assert 4 <= len(one) <= 16
    both = prompt_texts(candidates(spark, 1, 200).unionByName(candidates(spark, 2, 9000)))
    assert one < both


def test_one_more_row_changes_two_prompts_at_most(spark):
    df = candidates(spark, 3, 1500)
    before = prompt_texts(df)
    for extra in range(4):
        after = prompt_texts(df.unionByName(candidates(spark, 3, 1, 5000 + extra)))
        assert 1 <= len(after - before) <= 2 and len(before - after) <= 1


def test_buckets_are_the_first_small_nodes(spark):
    rows = S.sticky_buckets(candidates(spark, 4, 3000).withColumn("_h", S.row_hash(["domain", "page_title", "count_views", "source_file"]))).collect()
    sizes = {}
    for d in range(15):
        for r in rows:
            key = (d, r._h >> (60 - d))
            sizes[key] = sizes.get(key, 0) + 1
    for r in rows:
        assert r.depth == next(d for d in range(15) if sizes[d, r._h >> (60 - d)] <= 50) and r.prefix == r._h >> (60 - r.depth)


def test_equal_rows_and_empty_input_and_many_rows(spark):
    same = candidates(spark, 5, 1).crossJoin(spark.range(400).select(F.col("id").alias("x"))).drop("x")
    out = S.sticky_buckets(same.unionByName(candidates(spark, 5, 100, 10)))
    assert out.count() == 500 and out.groupBy("bucket").count().where("count > 50").count() == 1
    assert S.build_prompts(S.assign_batches(out.drop("depth", "prefix"), bucket=F.col("bucket"))).agg(F.max("n_records")).first()[0] == 50
    assert S.sticky_buckets(same.where("false")).count() == 0
    big = S.sticky_buckets(candidates(spark, 6, 20_000))  # its least depth is above the root
    assert big.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 50 and big.count() == 20_000


def test_a_killed_job_asks_only_for_the_rest(spark, tmp_path):
    """Each call leaves a line in a file, so calls of the killed workers count too."""
    import os

    import pytest

    prompts = S.build_prompts(S.assign_batches(candidates(spark, 7, 600), 50)).select("bucket", "batch_no", "n_records", "prompt")
    prompts = prompts.unionByName(prompts.withColumn("bucket", F.lit(9).cast("long")))  # equal prompts of one run
    calls, store = str(tmp_path / "calls"), str(tmp_path / "store")

    def scorer(die_at):
        def ask(prompt):
            with open(calls, "a+") as f:
                f.seek(0)
                if len(f.readlines()) == die_at:
                    os._exit(1)
                f.write("x\n")
            return S.RuleScorer()(prompt)
        return ask

    def asked():
        with open(calls) as f:
            return len(f.readlines())
    with pytest.raises(Exception):
        S.score_batches_stored(prompts, store, scorer(5), parallelism=1).count()
    assert asked() == 5
    assert S.stored_replies(spark, store).count() == 5
    out = S.score_batches_stored(prompts, store, scorer(-1), parallelism=1).collect()
    assert asked() == 12 and len(out) == 24 and {r.call_status for r in out} == {"ok"}
    assert not os.path.exists(S.replies_in_flight(store))
    S.score_batches_stored(prompts, store, scorer(-1)).count()
    assert asked() == 12


def test_failed_calls_are_told_and_tried_again(spark, tmp_path):
    prompts = S.build_prompts(S.assign_batches(candidates(spark, 8, 120), 50))

    def flaky(prompt):
        raise TimeoutError("model timed out")
    out = S.score_batches_stored(prompts, str(tmp_path / "s"), flaky).collect()
    assert {(r.call_status, r.call_error) for r in out} == {("error", "TimeoutError: model timed out")}
    assert {r.call_status for r in S.score_batches_stored(prompts, str(tmp_path / "s"), S.RuleScorer()).collect()} == {"ok"}


def test_buckets_and_replies_do_their_work_once(spark):
    rows = spark.range(300).select(
        F.lit("en").alias("domain"), F.concat(F.lit("Google_Maps_"), "id").alias("page_title"), F.col("id").cast("int").alias("count_views"),
        F.lit("f").alias("source_file"), F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("id") % 2).cast("int")).alias("processing_date"))
    buckets = S.sticky_buckets(rows, 10)
    plan = buckets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") >= S.LEVELS > plan.count("Exchange")  # all levels of the tree share one shuffle
    batched = buckets.select("bucket", F.lit(0).cast("long").alias("batch_no"), F.col("count_views").cast("long").alias("row_in_batch"),
                             "domain", "page_title", "count_views")
    prompts = S.build_prompts(batched)
    plan = S.native_replies(prompts)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("RLIKE" in line for line in plan.splitlines() if "Aggregate" in line)  # the rules run before the aggregate
    statuses = S.persist_replies(S.reply_status(S.native_replies(prompts)))
    known = S.reply_rows(statuses, status_col="status")
    assert "try_parse_json" not in known.select("pos")._jdf.queryExecution().logical().toString()
    assert sorted(map(tuple, known.collect())) == sorted(map(tuple, S.reply_rows(statuses).collect()))
