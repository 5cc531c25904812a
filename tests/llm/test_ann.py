"""Nearest neighbours against brute force: recall, exact scores, ties and rows that take no part."""

import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from viewsift.llm import ann, registry  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, vectors, nearest=5, step=50):
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    out = {}
    for q in sorted(set(ids[ids % step == 0].tolist())):
        own = vectors[np.flatnonzero(ids == q)[0]]
        score = (vectors * own).sum(axis=1) / (norm * np.sqrt((own * own).sum()))
        at = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:nearest]
        out[q] = [(int(ids[i]), float(score[i])) for i in at]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for rows in out.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
    return {q: [r[1:] for r in rows] for q, rows in out.items()}


def test_recall_on_a_given_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = brute(np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64))
    got = found(registry.QUERIES["op3_nearest_neighbours"](spark, sf))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {q: dict(w) for q, w in want.items()}
    for q, rows in got.items():
        assert [s for _, s in rows] == sorted((s for _, s in rows), reverse=True)
        for i, s in rows:
            assert abs(exact[q].get(i, s) - s) < 1e-12


def test_small_tables_are_searched_whole_with_ties_by_id(spark):
    """Copies of one vector (a third of all rows) tie; the smaller ids win."""
    rnd = np.random.default_rng(1)
    vectors = rnd.standard_normal((200, 8)).astype(np.float32)
    vectors[::3] = vectors[0]
    ids = np.arange(200) * 5
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    got = found(ann.nearest_neighbours(spark.createDataFrame(rows + rows[:9], SCHEMA).withColumn("size", F.lit("clash"))))
    want = brute(ids, vectors.astype(np.float64))
    assert {q: [i for i, _ in w] for q, w in want.items()} == {q: [i for i, _ in g] for q, g in got.items()}


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    rnd = np.random.default_rng(2)
    vectors, ids = rnd.standard_normal((600, 6)).astype(np.float32), np.arange(600)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    got = found(ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), shard_rows=150, share=1.0))
    want = brute(ids, vectors.astype(np.float64))
    assert {q: [i for i, _ in w] for q, w in want.items()} == {q: [i for i, _ in g] for q, g in got.items()}


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 1.0]),
            (None, [1.0, 0.0]), (50, [0.0, 0.0]), (100, [1.0, 0.0, 0.0]), (8, [2.0, 0.0]), (0, [1.0, 0.0])]
    got = found(ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA)))
    assert {q: [i for i, _ in g] for q, g in got.items()} == {0: [8, 7]}
    assert ann.nearest_neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


def test_forest_ascends_to_the_wanted_number():
    rnd = np.random.default_rng(3)
    vectors = rnd.standard_normal((500, 5))
    forest = ann.PrefixForest(vectors, trees=4)
    for rows, query in zip(forest.candidates(vectors[:20], 60), range(20)):
        assert len(rows) >= 60 and query in rows
    assert all(len(r) == 500 for r in forest.candidates(vectors[:3], 500))


def test_an_id_on_several_vectors_is_listed_once(spark):
    rnd = np.random.default_rng(8)
    rows = [(i, rnd.standard_normal(6).tolist()) for i in range(1, 40)] + [(2, rnd.standard_normal(6).tolist()) for _ in range(30)]
    rows += [(100, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (100, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0])]
    out = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), query_step=50, shard_rows=20)
    got = [(r["rank"], r.vec_id, r.score) for r in out.orderBy("rank").collect()]
    best = {}
    for q in rows[-2:]:
        for i, v in rows:
            if i != 100:
                s = float(np.dot(q[1], v) / np.linalg.norm(q[1]) / np.linalg.norm(v))
                best[i] = max(best.get(i, -2), s)
    want = sorted((-s, i) for i, s in best.items())[:5]
    assert [(i, pytest.approx(-s)) for s, i in want] == [(i, s) for _, i, s in got] and [r for r, *_ in got] == [1, 2, 3, 4, 5]


def test_huge_and_tiny_components(spark):
    rows = [(50, [1e200, 1e200]), (1, [1e-200, 0.0]), (2, [1e300, -1e300]), (3, [3.0, 3.0]), (4, [5e-324, 5e-324])]
    out = ann.nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [r.vec_id for r in out] == [3, 4, 1, 2]
    assert [round(r.score, 9) for r in out] == [1.0, 1.0, round(0.5 ** 0.5, 9), 0.0]


@pytest.mark.parametrize("share", [0.35, 0.5])
def test_recall_over_several_shards(spark, share):
    """Below a full share, shards of 2,500 vectors, against brute force."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").limit(10_000).collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.nearest_neighbours(df, share=share, shard_rows=2_500).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    unit, hits, total = x / np.linalg.norm(x, axis=1, keepdims=True), 0, 0
    for q in np.flatnonzero(ids % 50 == 0):
        s = unit @ unit[q]
        s[ids == ids[q]] = -2
        top = set(ids[np.argsort(-s, kind="stable")[:5]].tolist())
        hits, total = hits + len(top & found[ids[q]]), total + 5
    print("recall", share, hits / total)
    assert total and hits / total >= 0.9
