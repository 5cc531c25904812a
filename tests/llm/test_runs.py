"""Periodic runs: against a check of every period and place."""

import hashlib
import os
import random
import sys
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from viewsift.llm import registry, runs  # noqa: E402


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if all(a == b for a, b in zip(words, words[q:])))


def brute(words):
    """(start, length, period) of every run, period by period."""
    out, n = [], len(words)
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if length >= max(24, 3 * q) and smallest_period(words[at:at + length]) == q:
                out.append((at, length, q))
            at = end
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def best(found):
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def found_in(texts):
    """Runs per list of words, all texts in one call."""
    flat = [w for t in texts for w in t]
    place = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    bounds = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    rows = runs.find_runs(np.array([place[w] for w in flat], np.int64), bounds)
    out = [[] for _ in texts]
    for start, length, period in rows.tolist():
        i = max(k for k in range(len(texts)) if bounds[k] <= start and len(texts[k]))
        out[i].append((start - int(bounds[i]), length, period))
    return out


def periodic_text(rnd):
    """Nested repetitions over few words: runs inside runs, runs that touch, almost-runs."""
    words = []
    for _ in range(rnd.randint(1, 5)):
        block = [rnd.choice("ab") for _ in range(rnd.randint(1, 6))]
        block = (block * rnd.randint(1, 12) + [rnd.choice("abc") for _ in range(rnd.randint(0, 3))]) * rnd.randint(1, 6)
        words += block
        if rnd.random() < 0.5 and words:
            words[rnd.randrange(len(words))] = rnd.choice("abcd")
    return words[:400]


def test_nested_repetitions():
    rnd = random.Random(4)
    texts = [periodic_text(rnd) for _ in range(150)]
    assert sum(len(brute(t)) for t in texts) > 150
    assert found_in(texts) == [brute(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=90), st.integers(1, 9))
def test_any_words(words, times):
    assert found_in([words * times]) == [brute(words * times)]


@pytest.mark.parametrize("period", [1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 100, 128, 129])
@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_least_length_at_every_window_border(period, extra):
    rnd = random.Random(period)
    block = [f"w{i}" for i in range(period)]
    length = max(24, 3 * period) + extra
    words = [f"l{rnd.random()}"] + (block * (length // period + 1))[:length] + ["end"]
    assert found_in([words]) == [[(1, length, period)] if extra >= 0 else []]


def test_period_block_whose_windows_all_return_inside_it():
    """Each window of 16 words stands twice in the block, so no short window is unique to its period."""
    a, b = [f"a{i}" for i in range(20)], [f"b{i}" for i in range(20)]
    block = sum((a if c == "a" else b for c in "aaabbbabab"), [])
    words = block * 3 + ["x"]
    assert found_in([words]) == [brute(words)]


def test_one_word_for_long():
    assert found_in([["a"] * 100_000, ["a"] * 24, [], ["a"] * 23]) == [[(0, 100_000, 1)], [(0, 24, 1)], [], []]


def planted(doc_id, text):
    """The input rule of the query, word by word."""
    words = (text or b"").split()
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_query_on_a_given_table(spark):
    sf = "/root/testdata/sf0.001"
    out = {r.doc_id: r for r in registry.QUERIES["op11_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").cast("binary")).collect()
    assert len(docs) == len(out)
    hits = 0
    for doc_id, text in docs:
        words = planted(doc_id, text and bytes(text))
        if len(words) > 4000:  # the check of all periods is quadratic
            continue
        found, r = brute(words), out[doc_id]
        hits += bool(found)
        top = best(found)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *(top or (None,) * 3))
        assert r.exponent_milli == (1000 * top[1] // top[2] if top else None)
        assert r.runs_sha256 == sha("".join(f"{a},{b},{c}\n" for a, b, c in found).encode())
        assert r.collapsed_sha256 == sha(collapsed(words, found))
    assert hits > 5


def test_hand_made_rows(spark):
    loop = "go on\tand\non  " * 20
    data = cases.rows() + [(200, loop, "en", "s", 1), (201, loop + "end", "en", "s", 1), (200, loop, "en", "s", 1)]
    docs = cases.frame(spark, data).withColumn("RUNS", F.lit("clash")).withColumn("_x", F.lit(1))
    out = runs.periodic_runs(docs)
    assert set(docs.columns) - {"RUNS"} < set(out.columns)
    rows = out.select("doc_id", F.col("text").cast("binary").alias("t"), "runs", "best", F.col("collapsed").cast("binary").alias("c")).collect()
    assert len(rows) == len(data)
    for r in rows:
        words = bytes(r.t or b"").split()
        if len(words) > 4000:
            continue
        found = brute(words)
        assert [tuple(x) for x in r.runs] == found and (tuple(r.best) if r.best else None) == best(found)
        assert bytes(r.c) == collapsed(words, found)
    assert [len(r.runs) for r in rows if r.doc_id == 200] == [1, 1]
    assert runs.periodic_runs(cases.frame(spark, [])).count() == 0


def test_bytes_that_are_no_utf8(spark):
    docs = spark.createDataFrame([(1, bytearray(b"\xff \xfe" * 30))], "doc_id long, b binary").selectExpr("doc_id", "cast(b as string) as text")
    r = runs.periodic_runs(docs).selectExpr("best", "cast(collapsed as binary) as c").first()
    words = (b"\xff \xfe" * 30).split()
    assert tuple(r.best) == best(brute(words)) and bytes(r.c) == collapsed(words, brute(words))
