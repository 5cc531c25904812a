"""LM scoring against counts in dictionaries."""

import math
import os
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from viewsift.llm import lm, registry  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = object()


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [END]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def brute(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base, score) per row, counts kept exactly."""
    one, two = Counter(), Counter()
    for d, t in rows:
        if not held(d):
            w = tokens(t)
            one.update(w)
            two.update(zip([None, *w], w))
    n, v = sum(one.values()), len(one)

    def about(c):
        return lm.LEVEL_COUNT[int(lm.level_of(np.array([c]))[0])]
    out = []
    for d, t in rows:
        w = tokens(t)
        base = sum(math.log10((one[x] + 1) / (n + v + 1)) for x in w)
        score = 0.0
        for a, b in zip([None, *w], w):
            pair = about(two[a, b])
            history = max(about(one[END if a is None else a]), pair)
            score += math.log10((pair + lm.DIRICHLET * (about(one[b]) + 1) / (n + v + 1)) / (history + lm.DIRICHLET))
        out.append((d, held(d), len(w), sum(one[x] > 0 for x in w), n, base, score))
    return out


def compare(got, want):
    got, want = (sorted(x, key=lambda r: (str(r[0]), r[2], round(r[5], 6))) for x in (got, want))
    assert [tuple(r[:5]) for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-9)
    off = [abs(a[6] - b[6]) / b[2] for a, b in zip(got, want)]  # the filter errs rarely
    assert np.median(off) < 0.02 and max(r for r, b in zip(off, want) if b[2] > 20) < 0.3


def as_rows(df):
    return [tuple(r) for r in df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]


@pytest.mark.parametrize("head", [lm.HEAD_WORDS, 16])
def test_scores_equal_counts_in_a_dictionary(spark, head):
    data = cases.rows()
    docs = cases.frame(spark, data).withColumn("score", F.lit("clash")).withColumn("word", F.lit(1))
    compare(as_rows(lm.score_texts(docs, head=head)), brute([(r[0], r[1]) for r in data]))


def test_query_on_a_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    compare(as_rows(registry.QUERIES["op5_lm_scoring"](spark, sf)), brute(rows))


def test_filter_counts_and_errors(spark):
    """Counted n-grams come back at their level; unknown ones rarely come back at all."""
    docs = spark.createDataFrame([(" ".join(f"w{i}" for i in range(400) for _ in range(1 + i % 40)),)], "text string")
    data, segments = lm.count_filter(docs, 60_000)
    f = lm.CountFilter(data, segments)
    words = [f"w{i}".encode() for i in range(400)]
    want = lm.LEVEL_COUNT[lm.level_of(np.array([1 + i % 40 for i in range(400)]))]
    assert (f.count(lm.word_hashes(words)) >= want).all()
    assert (f.count(lm.word_hashes(words)) == want).mean() > 0.97
    assert (f.count(lm.word_hashes([f"x{i}".encode() for i in range(5000)])) > 0).mean() < 0.02


def test_large_counts_survive_packing(spark):
    docs = spark.createDataFrame([("a b " * 700,)] * 3, "text string")
    data, segments = lm.count_filter(docs, 5000)
    f = lm.CountFilter(data, segments)
    assert f.count(lm.word_hashes([b"a"]))[0] == lm.LEVEL_COUNT[lm.level_of(np.array([2100]))[0]]


def test_empty_and_unlearned(spark):
    assert lm.score_texts(cases.frame(spark, [])).count() == 0
    only = next(i for i in range(100) if held(i))
    out = lm.score_texts(cases.frame(spark, [(only, "a b", "en", "s", 3)])).first()
    assert (out.held_out, out.n_tokens, out.n_known, out.train_tokens) == (True, 3, 0, 0)
    assert out.base_score == pytest.approx(0.0)


@pytest.mark.parametrize("group", [16, 2, 1])
def test_a_filter_too_large_for_the_workers_counts_alike(spark, monkeypatch, group):
    """The filter grows with the tokens; beyond the limit of the broadcast the n-grams go to its segments."""
    rnd = random.Random(3)
    words = [f"w{min(int(rnd.paretovariate(0.8)), 20_000)}" for _ in range(600_000)]
    data = [(i, " ".join(words[i * 1000:(i + 1) * 1000]) if i else None, "en", "s", 1) for i in range(600)]
    data += [(None, "", "en", "s", 0), data[7]]
    docs, by_exchange = cases.frame(spark, data), lm.scores_by_exchange
    monkeypatch.setattr(lm, "scores_by_exchange", lambda rows, segments: by_exchange(rows, segments, group))
    sent = as_rows(lm.score_texts(docs, max_filter_bits=1 << 20))
    assert lm.filter_segments(sent[0][4]) > 1  # more than 2^20 bits
    compare(sent, brute([(r[0], r[1]) for r in data]))
    whole = as_rows(lm.score_texts(docs))
    assert sorted(map(repr, sent)) == sorted(map(repr, whole))


def test_false_hits_do_not_grow_with_the_tokens(spark):
    rates = []
    for n in (100_000, 1_600_000):
        docs = spark.range(n // 1000).selectExpr("concat_ws(' ', transform(sequence(0, 999), i -> concat('w', xxhash64(id * 1000 + i)))) AS text")
        f = lm.CountFilter(*lm.count_filter(docs, n))
        rates.append((f.count(lm.word_hashes([f"x{i}".encode() for i in range(50_000)])) > 0).mean())
    assert max(rates) < 0.16  # every n-gram is new: six bits set per token, the worst case


def test_no_text_is_shuffled_by_the_exchange(spark):
    """What goes through the shuffles: hashes, counts, levels and word numbers."""
    docs = cases.frame(spark).selectExpr("doc_id", "text", "doc_id % 7 = 2 AS held_out")
    marked = docs.withColumn("text", F.lit("needle haystack needle"))
    for task, schema in ((lm._ask(1, 1), lm.QUESTIONS), (lm._number(1, 1), lm.SLICES)):
        for row in marked.mapInArrow(task, schema).collect():
            assert b"needle" not in b"".join(bytes(v) for v in row if isinstance(v, (bytes, bytearray)))


def test_rows_that_change_between_the_reads_are_told(spark):
    @F.udf("string")
    def other_each_time(i):
        return " ".join(f"w{b}" for b in os.urandom(40 + os.urandom(1)[0]))
    docs = spark.range(50).select(F.col("id").alias("doc_id"), other_each_time.asNondeterministic()("id").alias("text"),
                                  F.lit(False).alias("held_out"))
    with pytest.raises(Exception, match="changed between two reads"):
        lm.scores_by_exchange(docs, 1).collect()


def test_packed_counts_and_numbers():
    n = np.array([0, 1, 254, 255, 256, 10 ** 12])
    assert lm._unpacked(lm._packed(n), len(n)).tolist() == n.tolist() and lm._unpacked(lm._packed(n[:0]), 0).tolist() == []
    assert lm._loosened(lm._squeezed(n[:5], 4), 5, 4).tolist() == n[:5].tolist()
