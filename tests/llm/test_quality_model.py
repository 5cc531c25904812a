"""Quality classifier: word vectors and pooling by brute force, held-out accuracy, calibration."""

import os
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from viewsift.llm import quality_model as qm, registry  # noqa: E402


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4 == 2


def brute_words(text):
    words = qm.WORD.findall(text or b"")
    return [qm.REPEAT if i and w == words[i - 1] else w for i, w in enumerate(words)]


def index_vector(word):
    h, out = xxhash.xxh3_64_intdigest(word), np.zeros(qm.DIM)
    for k in range(qm.SIGNS):
        part = h >> (8 * k)
        out[part % qm.DIM] += -1 if (part >> 7) & 1 else 1
    return out


def bucket(word):
    return xxhash.xxh3_64_intdigest(word) >> (64 - 13)


def brute_table(texts):
    table = np.zeros((qm.BUCKETS, qm.WIDTH), np.int64)
    for t in texts:
        words = brute_words(t)
        for i, w in enumerate(words):
            table[bucket(w), qm.DIM] += 1
            for j in range(max(0, i - qm.REACH), min(len(words), i + qm.REACH + 1)):
                if j != i:
                    table[bucket(w), :qm.DIM] += index_vector(words[j]).astype(np.int64)
    return table


TEXTS = [b"One two, two two three!\nfour four ***", b"", b"a", b"x y", "Größe naïve 狐 狐".encode(), b"--- ---\n\n--- a\tb\x0bc", b"\xff\xfe a"]


def test_words():
    assert qm.WORD.findall(b"It's 3,5 a|b \n c") == [b"It", b"'", b"s", b"3", b",", b"5", b"a", b"|", b"b", b"\n", b"c"]
    assert brute_words(b"a a a b a") == [b"a", qm.REPEAT, qm.REPEAT, b"b", b"a"]


def test_contexts_by_brute_force(monkeypatch):
    table = np.zeros((qm.BUCKETS, qm.WIDTH), np.int64)
    qm.add_contexts(table, *qm.word_hashes(TEXTS))
    assert (table == brute_table(TEXTS)).all()
    monkeypatch.setattr(qm, "SLICE_BYTES", 5)  # long texts in pieces
    cut = np.zeros_like(table)
    qm.add_contexts(cut, *qm.word_hashes(TEXTS))
    assert (cut == table).all()


def test_pooling_by_brute_force():
    vectors = qm.WordVectors.of(brute_table(TEXTS))
    got = vectors.describe(TEXTS)
    for text, x in zip(TEXTS, got):
        v = [vectors.vectors[bucket(w)].astype(float) for w in brute_words(text)]
        n = len(v) + qm.PRIOR_WORDS
        mean = (sum(v, np.zeros(qm.DIM)) + qm.PRIOR_WORDS * vectors.mean) / n
        square = (sum((u * u for u in v), np.zeros(qm.DIM)) + qm.PRIOR_WORDS * vectors.square) / n
        assert x == pytest.approx(np.r_[mean, np.sqrt(np.maximum(square - mean * mean, 0))], abs=1e-9)


def test_word_vectors_cover_all_texts_in_any_partitioning(spark):
    data = [(i, t.decode("utf-8", "replace")) for i, t in enumerate(TEXTS * 5)] + [(99, None)]
    want = qm.WordVectors.of(brute_table([t.encode() for _, t in data if t is not None]))
    for parts in (1, 7):
        got = qm.word_vectors(spark.createDataFrame(data, "doc_id long, text string").repartition(parts))
        assert (got.vectors == want.vectors).all() and (got.mean == want.mean).all()


def test_temperature_calibrates():
    rnd = np.random.default_rng(5)
    x = rnd.standard_normal((4000, 4))
    y = (rnd.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    apart = np.arange(4000) % 5 == 0
    model = qm.fit(x, y, np.ones(4000), apart)
    fresh = rnd.standard_normal((4000, 4))
    p = model.score(fresh)
    truth = 1 / (1 + np.exp(-2 * fresh[:, 0]))
    assert np.abs(p - truth).mean() < 0.08 and model.temperature != 1.0
    for low in np.arange(0, 1, 0.2):
        at = (p >= low) & (p < low + 0.2)
        assert abs(p[at].mean() - truth[at].mean()) < 0.1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = registry.QUERIES["op13_quality_classifier"](spark, sf)
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = out.collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    kept, right = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if r.held_out and r.doc_id in labels:
            kept[labels[r.doc_id]] += 1
            right[labels[r.doc_id]] += r.predicted == labels[r.doc_id]
    assert right[1] / kept[1] >= 0.95 and right[0] / kept[0] >= 0.8


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs = cases.frame(spark)
    rows = [(i, i % 2, 0) for i in range(60)] + [(3, 0, 1), (3, 0, 0), (None, 1, 0), (5, None, 0), (7777, 1, 0), (8, 5, 0)]
    base = qm.score_quality(docs, labelled(spark, rows))
    want = sorted((r.doc_id or -1, r.text or "", r.score) for r in base.collect())
    flipped = [(d, 1 - q if held(d) and q in (0, 1) else q, t) for d, q, t in rows]
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy")).withColumn("SCORE", F.lit("clash"))
    got = qm.score_quality(other, labelled(spark, flipped))
    assert "source" in got.columns and got.columns.count("score") == 1
    assert sorted((r.doc_id or -1, r.text or "", r.score) for r in got.collect()) == want
    assert len(want) == len(cases.rows()) and all(0 <= s <= 1 for *_, s in want)


def test_sample_is_bounded_and_takes_each_id_once(spark):
    docs = spark.createDataFrame([(i % 300, f"text {i} of words") for i in range(900)], "doc_id long, text string")
    vectors = spark.sparkContext.broadcast(qm.word_vectors(docs))
    x, y, weight, apart = qm.training_rows(docs, labelled(spark, [(i, int(i % 10 > 0), 0) for i in range(300)] * 2), vectors, most=40)
    n = [sum(1 for i in range(300) if not held(i) and int(i % 10 > 0) == q) for q in (0, 1)]
    assert [(y == 0).sum(), (y == 1).sum()] == [min(20, n[0]), 20] and apart.any() and not apart.all()
    assert weight[y == 1].sum() == pytest.approx(n[1]) and weight[y == 0].sum() == pytest.approx(n[0])


def test_labels_of_one_kind_or_none(spark):
    docs = cases.frame(spark)
    none = qm.score_quality(docs, labelled(spark, []))
    assert {r.score for r in none.collect()} == {0.5}
    ids = [i for i in range(60) if not held(i)][:8]
    one = qm.score_quality(docs, labelled(spark, [(i, 1, 0) for i in ids]))
    assert {round(r.score, 9) for r in one.collect()} == {0.9}
    assert qm.score_quality(cases.frame(spark, []), labelled(spark, [(1, 1, 0), (2, 0, 0)])).count() == 0
