"""Language ID: exact code lengths and held-out accuracy."""

import math
import os
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from viewsift.llm import langid, registry  # noqa: E402


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


def brute_bits(train, text):
    """Code length of a text after the training texts of one language, context by context."""
    counts = Counter()
    for t in train:
        data = b"\n\n\n" + t
        for i in range(3, len(data)):
            for k in range(4):
                counts[data[i - k:i], data[i]] += 1
    followers = {}
    for (context, byte), n in counts.items():
        followers.setdefault(context, []).append(n)
    data, bits = b"\n\n\n" + text, 0.0
    for i in range(3, len(data)):
        for k in (3, 2, 1, 0):
            context = data[i - k:i]
            n = followers.get(context)
            if n is None:
                continue
            if (context, data[i]) in counts:
                bits += math.log2((sum(n) + len(n)) / counts[context, data[i]])
                break
            bits += math.log2((sum(n) + len(n)) / len(n))
        else:
            bits += 8
    return bits


TRAIN = {"aa": [b"the quick brown fox", b"then there"], "bb": ["der schnelle braune Füchs".encode(), b"dann da"]}


@pytest.fixture(scope="module")
def model(spark):
    ids = [i for i in range(100) if not held(i)]
    rows = [(ids.pop(), t.decode(), lang) for lang, ts in TRAIN.items() for t in ts]
    return langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


@pytest.mark.parametrize("text", ["the fox", "Füchse", "zzz \x00", "t", "quick brown " * 50])
def test_code_lengths_are_exact(model, text):
    got = model.text_bits([text.encode()])[0]
    assert got == pytest.approx([brute_bits(TRAIN[lang], text.encode()) for lang in model.langs], rel=1e-5)


def test_long_texts_carry_their_context(model, monkeypatch):
    text = ("the quick Füchs und then da " * 40).encode()
    whole = model.text_bits([text, b"", text[:7]])
    monkeypatch.setattr(langid, "SLICE_BYTES", 50)
    assert model.text_bits([text, b"", text[:7]]) == pytest.approx(whole, rel=1e-6)


def test_sample_is_bounded_and_takes_whole_documents(spark):
    docs = spark.createDataFrame([(i, "ab" * (10 + i % 90), "xx" if i % 3 else "yy") for i in range(600)], "doc_id long, text string, lang string")
    got = langid.training_sample(docs, 8000).collect()
    for lang in ("xx", "yy"):
        size = sum(len(r.text) for r in got if r.lang == lang)
        assert 2000 < size <= 4000
    assert {r.text for r in got} <= {"ab" * (10 + i) for i in range(90)}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = registry.QUERIES["op10_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98


def test_hand_made_rows(spark):
    data = cases.rows()
    out = langid.identify(cases.frame(spark, data).withColumn("score", F.lit("clash")))
    rows = out.select("doc_id", "text", "held_out", "lang_pred", "score").collect()
    assert len(rows) == len(data)
    for r in rows:
        assert r.held_out == held(r.doc_id) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, r.text or "")))
        assert r.lang_pred in ("de", "en", "fr", "und")
    assert langid.identify(cases.frame(spark, [])).count() == 0
    unlearned = langid.identify(cases.frame(spark, [(1, "some text", None, "s", 1)])).first()
    assert (unlearned.lang_pred, unlearned.score) == ("und", 0.0)


def test_hash_table_finds_all_keys(model):
    for length in range(1, 5):
        keys = model.keys[length]
        assert (model._find("keys", length, keys) == np.arange(len(keys))).all()


def test_pieces_make_up_the_text_and_carry_their_context():
    text = "naïve Füchse 狐🦊 ".encode() * 50
    got = list(langid.pieces(text, 64))
    assert b"".join(p for p, _ in got) == text and max(len(p) for p, _ in got) <= 64
    assert all(p.decode() for p, _ in got)
    at = 0
    for piece, before in got:
        assert before == (b"\n\n\n" + text)[at:at + 3]
        at += len(piece)


def test_no_language_is_lost(spark):
    """Long texts only, short texts beside one very long one, and texts without doc_id."""
    ids = [i for i in range(400) if not held(i)]
    rows = [(ids.pop(), f"kurz {i} " * 2, "short") for i in range(29)] + [(ids.pop(), "lang und länger " * 60_000, "short")]
    rows += [(ids.pop(), "tout est long " * 2000, "long")]
    rows += [(None, f"no id {i} " * 5, "none") for i in range(300)] + [(ids.pop(), f"plain {i} " * 5, "plain") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.training_sample(docs, 32_000).collect()
    size = {o: sum(len(r.text.encode()) for r in got if r.lang == o) for o in ("short", "long", "none", "plain")}
    assert all(4000 < n <= 8000 for o, n in size.items() if o != "plain") and size["plain"] > 3000
    assert {r[1] for r in rows[:29]} <= {r.text for r in got}  # all that fit
    model = langid.train(docs, 32_000)
    assert model.langs == ["long", "none", "plain", "short"]


def test_many_languages_are_all_learned(spark):
    docs = spark.createDataFrame([(None, f"text of language {i} " * 20, f"l{i:04}") for i in range(300)],
                                 "doc_id long, text string, lang string")
    got = langid.training_sample(docs, 30_000)
    assert got.select("lang").distinct().count() == 300


def test_one_repeated_row_or_id_does_not_fill_the_sample(spark):
    ids = [i for i in range(400) if not held(i)]
    hot = [(ids[0], "always the same text " * 10, "en")] * 3000
    same_id = [(ids[1], f"another text {i} of one id " * 5, "en") for i in range(300)]
    rest = [(i, f"some text {i} of many " * 5, "en") for i in ids[2:102]]
    got = [r.text for r in langid.training_sample(spark.createDataFrame(hot + same_id + rest, "doc_id long, text string, lang string"), 20_000).collect()]
    assert len(got) == len(set(got)) and 10_000 < sum(map(len, got)) <= 20_000
    assert sum("of one id" in t for t in got) > 40 and sum("of many" in t for t in got) > 10
    long = [(ids[0], "lang und sehr lang " * 5000, "de")] * 50
    got = langid.training_sample(spark.createDataFrame(long, "doc_id long, text string, lang string"), 20_000).collect()
    assert 5_000 < sum(len(r.text) for r in got) <= 20_000 and len({r.text + str(r.before) for r in got}) <= len(got)
