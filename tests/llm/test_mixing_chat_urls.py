"""Mixing, chat rotation and URL filter on hand-made rows; their SQL on given tables is in tests/test_oracle.py."""

import math
import os
import re
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from viewsift.llm import chat, mixing, registry, urls  # noqa: E402


@pytest.mark.parametrize("mean", [0.0, 0.3, 1.0, 7.5, 16.0])
def test_poisson_inverse(spark, mean):
    us = [1e-12, 0.01, 0.2, 0.5, 0.9, 0.999, 1 - 1e-12]

    def brute(u):
        k, p = 0, math.exp(-mean)
        c = p
        while c < u and k < mixing.STEP_TERMS:
            k += 1
            p = p * mean / k
            c += p
        return k
    df = spark.createDataFrame([(u,) for u in us], "u double")
    got = df.select("u", mixing.poisson_inverse(F.col("u"), F.lit(mean)).alias("k")).collect()
    assert [r.k for r in got] == [brute(r.u) for r in got]


def test_copies_have_the_target_mean(spark):
    for rate in (0.4, 3.0, 100.0):
        df = spark.range(6000).select(mixing.poisson_copies(F.col("id").cast("string"), F.lit(rate)).alias("n"))
        mean, var = df.agg(F.avg("n"), F.variance("n")).first()
        assert mean == pytest.approx(rate, rel=0.05) and var == pytest.approx(rate, rel=0.12)


def test_mix_replicates_whole_rows_to_the_weights(spark):
    data = [(i, f"text {i}", "en", "src0" if i < 3000 else "src1" if i < 3900 else None, 1) for i in range(4000)]
    docs = cases.frame(spark, data)
    out = mixing.mix(docs, weights={"src0": 1.0, "src1": 2.0, None: 1.0}, total=8000).cache()
    n = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert n["src0"] == pytest.approx(2000, rel=0.1) and n["src1"] == pytest.approx(4000, rel=0.1)
    assert n[None] == pytest.approx(2000, rel=0.1)
    assert out.groupBy("doc_id").agg(F.count("*").alias("c"), F.max("n_copies").alias("n"), F.max("copy").alias("m")) \
        .where("c <> n OR m <> n").count() == 0
    again = mixing.mix(docs.repartition(3), weights={"src0": 1.0, "src1": 2.0, None: 1.0}, total=8000)
    keys = [[r.mix_key for r in part] for part in out.select("mix_key").rdd.glom().collect()]
    assert all(k == sorted(k) for k in keys)
    assert sorted(k for part in keys for k in part) == sorted(r.mix_key for r in again.select("mix_key").collect())
    # a global shuffle: the first rows of a partition come from all over the table
    first = [r.doc_id for r in out.limit(50).collect()]
    assert min(first) < 1000 and max(first) > 3000


def test_mix_on_hand_made_rows(spark):
    data = cases.rows()
    docs = cases.frame(spark, data).withColumn("rate", F.lit("clash")).withColumn("_of", F.lit(1))
    out = mixing.mix(docs, total=len(data) * 4)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_of", "copy", "n_copies", "rate", "mix_key"]
    given = {(r[0], r[1], r[2], r[3], r[4]) for r in data}
    assert {tuple(r)[:5] for r in out.collect()} <= given
    assert mixing.mix(cases.frame(spark, [])).count() == 0
    assert mixing.mix(docs, weights={"nowhere": 1.0}).count() == 0


CONV = "conv_id long, turn long, role string, text string"


def test_rotation_renders_every_participant(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hello, Ann"), (1, 3, "ann", ""),
            (2, None, "eve", None), (2, 1, None, "who?"), (2, 1, None, "who?"), (3, 0, "system", "alone"), (None, 0, "zoe", "no id")]
    out = chat.rotate(spark.createDataFrame(rows, CONV).withColumn("speaker", F.lit("clash")).withColumn("seq", F.lit(0)))
    got = {(r.conv_id, r.speaker): r for r in out.collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (2, "eve"), (None, "zoe")}
    r = got[1, "ann"]
    assert r.text == ("<|system|>\nBe kind.<|end|>\n<|assistant|>\nHi<|end|>\n<|user name=bob|>\nHello, Ann<|end|>\n"
                      "<|assistant|>\n<|end|>\n")
    spans = [tuple(map(int, s.split(":"))) for s in r["mask"].split(",")]
    assert [r.text[a:b] for a, b in spans] == ["Hi", ""] and (r.n_turns, r.n_trained) == (4, 2)
    assert got[2, "eve"].text.count("<|user name=unknown|>\nwho?<|end|>\n") == 2
    assert chat.rotate(spark.createDataFrame([], CONV)).count() == 0


@pytest.mark.parametrize("stretch", [chat.STRETCH_BLOCKS, 3])
def test_blocks_join_to_the_whole_dialogue(spark, monkeypatch, stretch):
    """1,000 turns in blocks equal the rendering in one block: text, places and mask."""
    monkeypatch.setattr(chat, "STRETCH_BLOCKS", stretch)
    rows = [(1, 0, "system", "Be kind.")] + [(1, 1 + i // 2, "a" if i % 3 else "b", f"turn {i}" * (i % 4)) for i in range(999)]
    rows += [(None, i, "c", f"no id {i}") for i in range(250)] + [(2, 0, "a", "short")]
    docs = spark.createDataFrame(rows, CONV)
    whole = {(r.conv_id, r.speaker): r for r in chat.rotate(docs, block_turns=10_000).collect()}
    found = {}
    for r in sorted(chat.rotate(docs, block_turns=100).collect(), key=lambda r: r.block):
        found.setdefault((r.conv_id, r.speaker), []).append(r)
    assert set(found) == set(whole) and len(found[1, "a"]) == 10
    for key, parts in found.items():
        one = whole[key]
        assert "".join(p.text for p in parts) == one.text and ",".join(p["mask"] for p in parts if p["mask"]) == one["mask"]
        assert [p.offset for p in parts] == [sum(len(q.text) for q in parts[:i]) for i in range(len(parts))]
        assert sum(p.n_turns for p in parts) == one.n_turns and sum(p.n_trained for p in parts) == one.n_trained
        for span in one["mask"].split(","):
            a, b = map(int, span.split(":"))
            assert one.text[:a].endswith("<|assistant|>\n") and one.text[b:].startswith("<|end|>")


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(r), r, a) for a, r in urls.RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [None, "", "no scheme", "http://", "http://A.Example.ORG/en/1x?q#f", "https://example.org/es/1", "https://notexample.org/es/1",
        "http://x.com/fr/", "http://x.com/fr", "http://xcom/de/1", "http://com/de/1?a=://b.org/", "ftp://a.org?x=/", "http://a.org",
        "HTTP://a.b.ORG:80/#x", "http://exa://mple.org/a", "http://é.com/de/ü?ä&b", "http://q.example.org/en/1" + "9" * 3000, "http://net.net/x\ny"]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit(7)).withColumn("tld", F.lit(1))
    out = urls.url_filter(df.unionAll(df))
    assert out.columns == ["page_id", "url", "tld", "host", "path", "rule", "verdict"]
    rows = out.collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path, rule, action = brute_url(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == action if action else r.verdict in ("allow", "block")


def test_query_on_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.page_id: r for r in registry.QUERIES["op7_url_filter"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()
    assert len(rows) == len(pages)
    for p in pages:
        host, path, rule, action = brute_url(p.url)
        r = rows[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (action or r.verdict)


def test_model_learns_a_lexical_rule(spark):
    """Labels that follow the number of parameters are learned from half of the URLs."""
    rows = [(i, f"http://h{i % 7}.{'org' if i % 2 else 'net'}/{'p' if i % 4 < 2 else 'q'}/{i}" + "?a=1&b=2&c=3" * (i % 4 < 2)) for i in range(400)]
    rules = [("block", "org/p"), ("allow", "org/q")]
    out = urls.url_filter(spark.createDataFrame(rows, "page_id long, url string"), rules).where("rule IS NULL").collect()
    right = sum(r.verdict == ("block" if r.page_id % 4 < 2 else "allow") for r in out)
    assert right >= 0.95 * len(out)


def test_suffix_shares_leave_out_a_urls_own_label(spark):
    """One labelled URL of its own suffix, on many rows: its share is the prior, not its label."""
    rows = [(i, f"http://h{i}.org/p") for i in range(40)] + [(100 + i, "http://only.biz/p") for i in range(50)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.featured(df, [("allow", "org/"), ("block", "biz/")])
    share = got.agg(F.avg("label")).first()[0]
    assert {round(r[0], 9) for r in got.where("url LIKE '%biz%'").select("f_tld_blocked").collect()} == {round(share, 9)}
    asked = urls.featured(df.unionAll(spark.createDataFrame([(7, "http://new.biz/q")], df.schema)), [("allow", "org/"), ("block", "only.biz/p")])
    r = asked.where("label IS NULL").first()
    assert r.f_tld_blocked > 0.8  # a URL without rule sees all labels of its suffix


def test_held_out_urls_are_judged_better_than_by_the_majority(spark):
    """Given pages; the rule that decides a URL is hidden from half of the hosts."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    rules = [("block", "example.org/en/"), ("allow", "example.org/"), ("block", "example.com/en/"), ("allow", "example.com/")]
    host = urls.host_of(F.col("url"))
    hidden = F.pmod(F.xxhash64(host), F.lit(2)) == 0
    known = pages.withColumn("url", F.when(hidden, F.regexp_replace("url", r"\.example\.(org|com)", ".example-$1.x")).otherwise(F.col("url")))
    out = urls.url_filter(known, rules).where("rule IS NULL").join(
        urls.featured(pages, rules).select("page_id", "label"), "page_id").where("label IS NOT NULL")
    right, blocked = out.agg(F.avg(((F.col("verdict") == "block") == (F.col("label") == 1)).cast("int")), F.avg("label")).first()
    print("held-out", right, "majority", max(blocked, 1 - blocked))
    assert right >= max(blocked, 1 - blocked) - 0.02


def test_labels_of_one_kind_or_none(spark):
    one = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.net/")], "page_id long, url string")
    assert {r.verdict for r in urls.url_filter(one).collect()} == {"allow"}
    assert {r.verdict for r in urls.url_filter(one, [("block", "org/")]).collect()} == {"block"}
    assert urls.url_filter(one, []).where("verdict = 'allow'").count() == 2
    assert urls.url_filter(one.limit(0)).count() == 0


def test_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("",), ("abcd",), ("aaaa",)], "t string").select(urls.entropy(F.col("t"))).collect()
    assert [round(r[0], 9) for r in got] == [1.0, 0.0, 2.0, 0.0]


def test_training_urls_are_bounded_and_of_both_classes(spark):
    """A URL with most of the rows counts once, and a rare class is drawn whole."""
    hot = [(0, "http://hot.org/")] * 5000
    allow = [(i, f"http://h{i % 50}.org/{i}") for i in range(4000)]
    block = [(i, f"http://b.com/de/{i}") for i in range(5)]
    known = urls.featured(spark.createDataFrame(hot + allow + block, "page_id long, url string")).persist()
    got = urls.training_urls(known, {0.0: 4001, 1.0: 5}, 400).collect()
    assert [r.weight for r in got if r.label == 1.0] == [1.0] * 5
    rest = [r.weight for r in got if r.label == 0.0]
    assert 300 < len(rest) < 500 and len(got) == len(rest) + 5
    out = urls.url_filter(spark.createDataFrame(hot + block, "page_id long, url string"), train_rows=4)
    assert out.where("verdict = 'block'").count() == 5
