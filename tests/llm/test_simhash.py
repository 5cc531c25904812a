"""SimHash near-dedup against brute force."""

import re
import sys
import os

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from viewsift.llm import components, registry, simhash  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """doc rows [(id, fp)] → component id per row."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    fps = np.array([p for _, p in prints], np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2):
            a, b = root(i), root(int(j))
            up[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(prints))]


def key(rows):
    return sorted(rows, key=str)


def test_rows_equal_brute_force(spark):
    data = cases.rows()
    docs = cases.frame(spark, data).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    got = simhash.simhash_components(docs).select("doc_id", simhash.hex_of(F.col("fp")), "component_id").collect()
    prints = [(r[0], brute_fingerprint(r[1])) for r in data]
    want = [(d, f"{p:016x}", c) for (d, p), c in zip(prints, brute_components(prints))]
    assert key(map(tuple, got)) == key(want)


def test_query_equals_brute_force_on_a_given_table(spark):
    sf = "/root/testdata/sf0.001"
    got = registry.QUERIES["op2_simhash_near_dedup"](spark, sf).collect()
    data = [(r.doc_id, brute_fingerprint(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = [(d, f"{p:016x}", c) for (d, p), c in zip(data, brute_components(data))]
    assert key(map(tuple, got)) == key(want)


@pytest.mark.parametrize("piece", [simhash.PIECE, 40])
def test_links_of_crowded_fingerprints(spark, piece):
    """Clusters of near fingerprints, one large enough that its buckets are cut into pieces."""
    rnd = np.random.default_rng(3)
    seeds = rnd.integers(0, 2**63, 12)
    fps = {int(s) for s in rnd.integers(0, 2**63, 400)}
    for n, s in zip([300, 60, *[5] * 10], seeds):
        for _ in range(n):
            fps.add(int(s) ^ sum(1 << int(b) for b in rnd.integers(0, 63, 2)))
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.fingerprint_links(df, piece=piece)
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    want = brute_components([(f, f) for f in fps])
    assert [roots.get(f, f) for f in fps] == want


def test_tiles_find_every_link():
    rnd = np.random.default_rng(5)
    base = rnd.integers(0, 2**63, 30, dtype=np.int64).astype(np.uint64)
    fp = np.concatenate([base ^ np.uint64(1 << int(b)) for b in rnd.integers(0, 20, 40)])
    fp = fp[np.argsort(np.bitwise_count(fp), kind="stable")]
    root = simhash.link_tiles(np.zeros(len(fp), np.int64), fp, tile=64)
    want = brute_components([(i, int(p)) for i, p in enumerate(fp)])
    assert root.tolist() == want


def brute_near_dedup(data):
    """(doc_id, text) of the row that stays of each component: least id, rows without one last, then least text hash."""
    import hashlib

    prints = [(i, brute_fingerprint(t)) for i, (_, t) in enumerate(data)]  # components over row numbers
    groups = {}
    for (d, t), c in zip(data, brute_components(prints)):
        groups.setdefault(c, []).append((d is None, d or 0, "" if t is None else hashlib.md5(t.encode()).hexdigest(), d, t))
    return sorted(((d, t) for *_, d, t in map(min, groups.values())), key=str)


def deduped(spark, data):
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    return sorted(((r.doc_id, r.text) for r in simhash.near_dedup(docs).collect()), key=str)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    data = cases.rows()
    out = simhash.near_dedup(cases.frame(spark, data).withColumn("fp", F.lit(1)).withColumn("_N", F.lit(2)))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp", "_N"]
    want = brute_near_dedup([(r[0], r[1]) for r in data])
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == want


A, B = "one text about many things of the world that is long enough", "another story which has nothing in common with any other"


@pytest.mark.parametrize("data, want", [
    ([(1, A), (1, B)], [(1, A), (1, B)]),  # an id on two unlike texts
    ([(1, A), (2, A), (2, B), (3, B)], [(1, A), (2, B)]),
    ([(None, A)] * 5, [(None, A)]),
    ([(None, A), (7, A), (None, B)], [(7, A), (None, B)]),
    ([(5, A)] * 4 + [(None, None), (None, "")], [(5, A), (None, "")])])
def test_near_dedup_of_repeated_and_missing_ids(spark, data, want):
    got = deduped(spark, data)
    if None in [t for _, t in data]:  # a null and an empty text have one fingerprint; which of the two stays is not fixed
        got = [(d, t or "") for d, t in got]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    empty = cases.frame(spark, [])
    assert simhash.simhash_components(empty).count() == 0
    assert simhash.near_dedup(empty).count() == 0


def test_chain_of_components(spark):
    """A long path settles to its smallest node."""
    links = spark.createDataFrame([(i + 1, i) for i in range(200)], "hi long, lo long")
    got = components.connected_components(links).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(201)}
