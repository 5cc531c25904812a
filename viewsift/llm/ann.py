"""Approximate nearest neighbours by cosine: a hash-prefix forest searched in blocks.

Each tree gives a vector a long string of random-hyperplane bits; sorted, the
strings are the leaves of a prefix tree, and the vectors that share a prefix with
a query are one range of the sorted array. A query descends every tree to its
longest matching prefix, then all trees ascend together, one bit at a time, until
``SHARE`` of the shard's vectors are candidates; these are compared exactly.

Equal vectors are one class with its K + 1 smallest ids, so copies crowd nothing
out and ties stay exact. Classes are dealt into shards of about ``SHARD_ROWS`` and
queries into blocks; every query meets every shard (a stated query set against
all rows, in blocks), a task holds one shard and one block, and the best of the
shards are merged per query.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite
component takes part neither as a query nor as a candidate, nor does a row without
vec_id; vectors are compared within their length only; repeated rows count once; a
vec_id on several vectors is listed once, with the nearest of them, and as a query
asks with each; components of any finite size are compared (vectors are scaled by
powers of two, which leaves cosines as they are);
with fewer candidates than K all are returned; an empty table gives an empty
result; input columns beside vec_id and embedding are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from viewsift.session import materialize

NEAREST = 5
QUERY_STEP = 50
TREES = 64
BITS = 32
#: Share of a shard's vectors that a query compares exactly, at least.
SHARE = 0.35
LEAST_CANDIDATES = 1_024
SHARD_ROWS = 16_384
#: Queries of a block: a shard's forest is built once per block.
BLOCK_QUERIES = 65_536
QUERIES_AT_ONCE = 512
SEED = 17


class PrefixForest:
    """Sorted arrays of hash strings over the rows of a matrix."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = SEED):
        rnd = np.random.default_rng(seed)
        self.planes = [rnd.standard_normal((vectors.shape[1], BITS)) for _ in range(trees)]
        self.order, self.codes = [], []
        for plane in self.planes:
            codes = self._strings(vectors, plane)
            order = np.argsort(codes, kind="stable")
            self.order.append(order)
            self.codes.append(codes[order])

    @staticmethod
    def _strings(vectors: np.ndarray, plane: np.ndarray) -> np.ndarray:
        bits = np.packbits(vectors @ plane > 0, axis=1)
        return bits.view(">u4").ravel().astype(np.uint32)

    def candidates(self, queries: np.ndarray, wanted: int):
        """Per query the rows found when all trees have ascended to the deepest level with ``wanted`` rows."""
        rows = len(self.order[0])
        strings = [self._strings(queries, p) for p in self.planes]
        low = np.zeros((BITS + 1, len(self.planes), len(queries)), np.int32)
        high = np.zeros_like(low)
        for t, (codes, own) in enumerate(zip(self.codes, strings)):
            for level in range(BITS + 1):
                rest = np.uint32((1 << (BITS - level)) - 1)
                low[level, t] = np.searchsorted(codes, own & ~rest, "left")
                high[level, t] = np.searchsorted(codes, own | rest, "right")
        found = (high - low).sum(axis=1)  # with repeats between trees: an upper bound of what a level yields
        for q in range(len(queries)):
            level = int(np.flatnonzero(found[:, q] >= wanted)[-1]) if rows >= wanted else 0
            while True:
                mark = np.zeros(rows, bool)
                for t, order in enumerate(self.order):
                    mark[order[low[level, t, q]:high[level, t, q]]] = True
                hit = np.flatnonzero(mark)
                if len(hit) >= wanted or level == 0:
                    break
                level -= 1
            yield hit


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The rows times powers of two that bring their largest component near 1: same cosines, but no square overflows."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, initial=0.0, keepdims=True))[1])


def cosine(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query in double precision, the same for equal rows."""
    return (vectors * query).sum(axis=1) / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


def _best(unit: np.ndarray, vectors: np.ndarray, ids: list[list[int]], rows: np.ndarray, query: np.ndarray,
          nearest: int) -> list[tuple[float, int]]:
    """The (score, id) of the ``nearest`` distinct ids among the candidate rows, best first; an id counts with its nearest vector."""
    rough = unit[rows] @ (query / np.sqrt((query * query).sum()))
    most = nearest
    while True:
        own = rows
        if len(rows) > most:  # the rough scores err by less than the margin
            own = rows[rough >= np.partition(rough, len(rows) - most)[len(rows) - most] - 1e-9]
        found: dict[int, float] = {}
        for score, i in sorted((-s, i) for s, r in zip(cosine(vectors[own], query).tolist(), own.tolist()) for i in ids[r]):
            found.setdefault(i, -score)
        if len(found) >= nearest or len(own) == len(rows):
            return [(s, i) for i, s in list(found.items())[:nearest]]
        most *= 4  # one id on many vectors


def search_shard(vectors: np.ndarray, ids: list[list[int]], queries: np.ndarray, nearest: int,
                 share: float = SHARE, trees: int = TREES) -> list[list[tuple[float, int]]]:
    """Per query the (score, id) of its best ``nearest`` ids among the classes of one shard, best first."""
    wanted = min(len(vectors), max(LEAST_CANDIDATES, int(np.ceil(share * len(vectors)))))
    vectors, queries = scaled(vectors), scaled(queries)
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    forest, out = PrefixForest(unit, trees), []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        some = queries[at:at + QUERIES_AT_ONCE]
        out += [_best(unit, vectors, ids, rows, query, nearest) for query, rows in zip(some, forest.candidates(some, wanted))]
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    values = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(rows), -1) if len(rows) else np.zeros((0, 1))


def _search(nearest: int, share: float, trees: int):
    def run(classes: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if classes.num_rows and queries.num_rows:
            found = search_shard(_matrix(classes["embedding"]), classes["ids"].to_pylist(), _matrix(queries["query"]),
                                 nearest, share, trees)
            out = [(q, i, s) for q, best in zip(queries["query_class"].to_pylist(), found) for s, i in best]
        return pa.table({"query_class": pa.array([o[0] for o in out], pa.int64()),
                         "vec_id": pa.array([o[1] for o in out], pa.int64()),
                         "score": pa.array([o[2] for o in out], pa.float64())})
    return run


def valid_vectors(rows: DataFrame) -> DataFrame:
    """Distinct (vec_id, embedding) that take part."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & v.isNotNull() & sound & F.exists(v, lambda x: x != 0)).distinct()


def nearest_neighbours(rows: DataFrame, query_step: int = QUERY_STEP, nearest: int = NEAREST, share: float = SHARE,
                       trees: int = TREES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the ``nearest`` found for every query (vec_id divisible by ``query_step``)."""
    vectors = materialize(valid_vectors(rows), "vectors")
    k = nearest + 1  # a query may find itself
    first = Window.partitionBy("embedding").orderBy("vec_id")
    classes = vectors.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k) \
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k ids at most
    classes = materialize(classes.withColumn("class_id", F.col("ids")[0]), "vector-classes")
    asked = vectors.where(F.col("vec_id") % query_step == 0)
    asked = materialize(asked.join(classes.select("embedding", "class_id"), "embedding")
                        .select(F.col("vec_id").alias("query_id"), "class_id"), "queries")
    wanted = classes.join(asked.select("class_id").distinct(), "class_id", "left_semi") \
        .select(F.col("class_id").alias("query_class"), "embedding")

    shards = max(1, -(-classes.count() // shard_rows))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    size = F.size("embedding").alias("size")

    def every(n: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    def own(key: str, n: int, name: str):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int").alias(name)
    left = classes.select("class_id", "embedding", "ids", size, own("class_id", shards, "shard"), every(blocks, "block"))
    right = wanted.select("query_class", F.col("embedding").alias("query"), size.alias("_size"), every(shards, "_shard"),
                          own("query_class", blocks, "_block"))
    found = left.groupBy("size", "shard", "block").cogroup(right.groupBy("_size", "_shard", "_block")).applyInArrow(
        _search(k, share, trees), "query_class long, vec_id long, score double")
    order = [F.col("score").desc(), F.col("vec_id")]
    found = found.groupBy("query_class", "vec_id").agg(F.max("score").alias("score"))  # an id may stand in several shards
    best = found.withColumn("_n", F.row_number().over(Window.partitionBy("query_class").orderBy(*order))) \
        .where(F.col("_n") <= k).select("query_class", "vec_id", "score")
    pairs = asked.join(best, F.col("class_id") == F.col("query_class")).where("vec_id <> query_id") \
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= nearest).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
