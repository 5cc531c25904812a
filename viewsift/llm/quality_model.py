"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

1. Random indexing. Every word has a sparse index vector (a few signs at places
   named by its hash). A word's vector is the sum of the index vectors of the
   words up to ``REACH`` places away, over all documents. Words are dealt into
   ``BUCKETS`` by their hash and a bucket's words share a vector, so the table has
   one size whatever the corpus: tasks add up their tables (integers, so in any
   order), Spark adds these per block, first per part and then whole.
2. Pooling. A document is described by the mean and the deviation of its words'
   vectors (centred and of unit length); ``PRIOR_WORDS`` words of the corpus's average
   are mixed in, so short texts are not judged by a word or two.
3. Network. Two layers in numpy, trained on a bounded sample of labelled rows
   (``TRAIN_ROWS``, half per label, weighted back to the labels' shares). A fifth
   of them is kept apart to fit the temperature that calibrates the probabilities.

A word is a run of letters and digits, a run of other signs, or a line break; one
that equals the word before it counts as the word ``REPEAT``. Labels are learned only from rows outside the held-out
fold; texts of all rows count for the word vectors. Only the text is an input of a score.

Defined cases: a null or empty text has no words and is described by the corpus's
average; an id with several labels is learned with each, an id of several rows
once; rows without doc_id have no label; without labels every score is 0.5, with labels of one kind it is their
smoothed share; repeated rows are scored each; an empty table gives an empty
result; input columns named like an output column are dropped.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewsift.llm.common import SLICE_BYTES, hold_out, slices, spans, text_bytes, without
from viewsift.llm.mixing import unit_hash

BUCKETS = 1 << 13
DIM = 32
#: Signs of an index vector.
SIGNS = 2
REACH = 2
#: Buckets of a block of the table, and its columns: the vector and the number of words.
BLOCK = 64
WIDTH = DIM + 1
#: Parts in which a block's tables are added up first.
PARTS = 16
PRIOR_WORDS = 4.0
TRAIN_ROWS = 20_000
FOLDS = 4
#: The calibration's share of the training rows is one in so many.
CALIBRATION = 5
THRESHOLD = 0.7
#: Beyond these decimals a matrix product depends on which rows share a batch.
SCORE_DIGITS = 10
HIDDEN = 32
EPOCHS = 60
BATCH = 128
RATE = 3e-3
DECAY = 1e-4
SEED = 23
WORD = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]+|\n")
SPACE = re.compile(rb"[\x20\x09-\x0d]")
REPEAT = b"\0"


def pieces(text: bytes, size: int) -> list[bytes]:
    """The text cut at the first white space after every ``size`` bytes."""
    out, at = [], 0
    while len(text) - at > size and (found := SPACE.search(text, at + size)):
        out.append(text[at:found.start()])
        at = found.start()
    return out + [text[at:]]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all texts' words, and where each text's begin (and the last ends)."""
    parts, owner = [], []
    for i, text in enumerate(texts):
        parts += (cut := pieces(text, SLICE_BYTES))
        owner += [i] * len(cut)
    found, n_words = [], np.zeros(len(texts) + 1, np.int64)
    for a, b in slices(parts):
        words = list(map(WORD.findall, parts[a:b]))
        place = {w: k for k, w in enumerate(dict.fromkeys(w for t in words for w in t))}
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, place), np.uint64, len(place))
        sizes = list(map(len, words))
        found.append(hashes[np.fromiter((place[w] for t in words for w in t), np.int64, sum(sizes))])
        np.add.at(n_words, np.array(owner[a:b]) + 1, sizes)
    own, bounds = np.concatenate(found) if found else np.zeros(0, np.uint64), np.cumsum(n_words)
    again = np.r_[False, own[1:] == own[:-1]][:len(own)]
    again[bounds[:-1][bounds[:-1] < len(own)]] = False
    own[again] = xxhash.xxh3_64_intdigest(REPEAT)
    return own, bounds


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def add_contexts(table: np.ndarray, hashes: np.ndarray, bounds: np.ndarray) -> None:
    """Adds the index vectors of each word's neighbours, and the word itself, to its bucket's row."""
    bucket = buckets(hashes)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    table[:, DIM] += np.bincount(bucket, minlength=BUCKETS)
    flat = np.zeros(BUCKETS * DIM)
    for k in range(SIGNS):
        part = hashes >> np.uint64(8 * k)
        place = (part % np.uint64(DIM)).astype(np.int64)
        sign = 1.0 - 2.0 * ((part >> np.uint64(7)) & np.uint64(1)).astype(np.float64)
        for step in range(1, REACH + 1):
            here = np.flatnonzero(doc[step:] == doc[:-step])
            for word, other in ((here, here + step), (here + step, here)):
                flat += np.bincount(bucket[word] * DIM + place[other], sign[other], BUCKETS * DIM)
    table[:, :DIM] += flat.astype(np.int64).reshape(BUCKETS, DIM)


def _tables(blocks: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int32()), pa.array([t.tobytes() for t in blocks.values()], pa.binary())],
                                      names=["block", "table"])


def _count(batches):
    """Task: the blocks of the table of its texts."""
    table = np.zeros((BUCKETS, WIDTH), np.int64)
    for batch in batches:
        texts = text_bytes(batch.column(0))
        for a, b in slices(texts):
            add_contexts(table, *word_hashes(texts[a:b]))
    parts = table.reshape(-1, BLOCK * WIDTH)
    yield _tables({i: parts[i] for i in np.flatnonzero(parts.any(axis=1)).tolist()})


def _add(batches):
    """Task: the sums of the tables of its blocks."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("table").to_pylist()):
            held[block] = held.get(block, 0) + np.frombuffer(data, np.int64)
    yield _tables(held)


@dataclass
class WordVectors:
    """A unit vector per bucket (zero where no word fell), and mean and mean square over the corpus's words."""

    vectors: np.ndarray
    mean: np.ndarray
    square: np.ndarray

    @classmethod
    def of(cls, table: np.ndarray) -> WordVectors:
        n = table[:, DIM:].astype(np.float64)
        total = max(1.0, n.sum())
        own = table[:, :DIM] - n * (table[:, :DIM].sum(axis=0) / total)
        own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-9)
        own = own.astype(np.float32).astype(np.float64)
        return cls(own.astype(np.float32), (n * own).sum(axis=0) / total, (n * own * own).sum(axis=0) / total)

    def pool(self, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Mean and deviation of each text's word vectors, ``PRIOR_WORDS`` average words mixed in."""
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        key, n = np.unique(doc * BUCKETS + buckets(hashes), return_counts=True)
        own, v = key // BUCKETS, self.vectors[key % BUCKETS].astype(np.float64)
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]][:len(own)])
        sums = np.zeros((2, len(bounds) - 1, DIM))
        if len(starts):
            sums[0, own[starts]] = np.add.reduceat(n[:, None] * v, starts)
            sums[1, own[starts]] = np.add.reduceat(n[:, None] * v * v, starts)
        total = np.diff(bounds)[:, None] + PRIOR_WORDS
        mean, square = (sums[0] + PRIOR_WORDS * self.mean) / total, (sums[1] + PRIOR_WORDS * self.square) / total
        return np.c_[mean, np.sqrt(np.maximum(square - mean * mean, 0.0))]

    def describe(self, texts: list[bytes]) -> np.ndarray:
        parts = [self.pool(*word_hashes(texts[a:b])) for a, b in slices(texts, SLICE_BYTES // 2)]
        return np.concatenate(parts) if parts else np.zeros((0, 2 * DIM))


def word_vectors(docs: DataFrame) -> WordVectors:
    """The vectors learned from all texts of ``docs`` (text)."""
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    found = docs.select("text").mapInArrow(_count, "block int, table binary").withColumn("part", part)
    found = found.repartition("block", "part").mapInArrow(_add, "block int, table binary")
    found = found.repartition("block").mapInArrow(_add, "block int, table binary")
    table = np.zeros((BUCKETS // BLOCK, BLOCK * WIDTH), np.int64)
    for row in found.toLocalIterator():  # BUCKETS / BLOCK rows, 2 MB
        table[row["block"]] = np.frombuffer(row["table"], np.int64)
    return WordVectors.of(table.reshape(BUCKETS, WIDTH))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Network:
    """Two layers over standardised inputs; ``logits`` are divided by ``temperature``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = SEED):
        rnd = np.random.default_rng(seed)
        self.mean, self.scale, self.temperature = x.mean(axis=0), x.std(axis=0) + 1e-6, 1.0
        self.layers = [rnd.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN),
                       rnd.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(())]
        x, weight = (x - self.mean) / self.scale, weight / weight.mean()
        (first, second), step = ([np.zeros_like(p) for p in self.layers] for _ in range(2)), 0
        for _ in range(EPOCHS):
            order = rnd.permutation(len(y))
            for at in range(0, len(y), BATCH):
                rows, step = order[at:at + BATCH], step + 1
                for k, g in enumerate(self._gradient(x[rows], y[rows], weight[rows])):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.layers[k] = self.layers[k] - RATE * (first[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)

    def _gradient(self, x, y, weight):
        w, b, out, bias = self.layers
        held = np.tanh(x @ w + b)
        off = weight * (_sigmoid(held @ out + bias) - y) / len(y)
        back = off[:, None] * out * (1.0 - held * held)
        return x.T @ back + DECAY * w, back.sum(axis=0), held.T @ off + DECAY * out, off.sum()

    def logits(self, x: np.ndarray) -> np.ndarray:
        w, b, out, bias = self.layers
        return (np.tanh((x - self.mean) / self.scale @ w + b) @ out + bias) / self.temperature

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """The temperature, of a fine grid, that makes rows the network has not seen most likely."""
        z, sign = self.logits(x), 2.0 * y - 1.0
        grid = np.exp(np.linspace(-2.0, 4.0, 241))
        self.temperature = float(grid[np.argmin([(weight * np.logaddexp(0.0, -sign * z / t)).sum() for t in grid])])

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x))


class Constant:
    """The score of every row when there is nothing to tell apart."""

    def __init__(self, share: float):
        self.share = share

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def _described(held, ids: list[str]):
    """Task: the columns ``ids`` and the features of the column ``text``."""
    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for a, b in spans(list(map(len, texts))):
                x = held.value.describe(texts[a:b])
                part = batch.slice(a, b - a)
                listed = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in ids), listed], names=[*ids, "x"])
    return run


def training_rows(docs: DataFrame, labels: DataFrame, held, most: int = TRAIN_ROWS, folds: int = FOLDS):
    """(features, label, weight, of calibration) of at most ``most`` labelled rows outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~hold_out(F.col("doc_id"), folds)).distinct()
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    u = unit_hash(F.concat(F.lit("quality:"), F.col("doc_id").cast("string")))
    drawn = None
    for y, n in sorted(sizes.items()):  # twice as many pass the hash, in expectation; the first of them are taken
        own = known.where((F.col("y") == y) & (u <= 2.0 * most / n)).orderBy(u, "doc_id").limit(most // 2)
        drawn = own if drawn is None else drawn.unionByName(own)
    if drawn is None:
        return np.zeros((0, 2 * DIM)), np.zeros(0), np.zeros(0), np.zeros(0, bool)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = own.join(F.broadcast(drawn), "doc_id")  # at most ``most`` ids
    rows = rows.select("doc_id", "y", "text").mapInArrow(_described(held, ["doc_id", "y"]), "doc_id long, y int, x array<double>")
    table = rows.groupBy("doc_id", "y").agg(F.min("x").alias("x")).orderBy("doc_id", "y").toArrow()
    x = np.array(table["x"].to_pylist(), np.float64).reshape(-1, 2 * DIM)
    y, ids = table["y"].to_numpy().astype(np.float64), table["doc_id"].to_pylist()
    share = {k: sizes[k] / max(1, int((y == k).sum())) for k in sizes}
    weight = np.array([share[int(k)] for k in y])
    apart = np.array([xxhash.xxh3_64_intdigest(str(i).encode()) % CALIBRATION == 0 for i in ids], bool)
    return x, y, weight, apart


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, apart: np.ndarray) -> Network | Constant:
    """The calibrated network, or a constant where one of the labels is missing."""
    if len(np.unique(y[~apart])) < 2:
        return Constant(float((weight @ y + 1.0) / (weight.sum() + 2.0)) if len(y) else 0.5)
    network = Network(x[~apart], y[~apart], weight[~apart])
    if apart.any():
        network.calibrate(x[apart], y[apart], weight[apart])
    return network


def score_of(text: Column, held) -> Column:
    """The score of a text; ``held`` broadcasts (word vectors, network)."""
    @F.arrow_udf(T.DoubleType())
    def run(texts: pa.Array) -> pa.Array:
        vectors, model = held.value
        found = model.score(vectors.describe(text_bytes(texts)))
        return pa.array(np.round(found, SCORE_DIGITS), pa.float64())
    return run(text)


def score_quality(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, folds: int = FOLDS) -> DataFrame:
    """``docs`` (doc_id, text, more columns) plus held_out, score and predicted, learned from ``labels`` (doc_id, quality)."""
    sc = docs.sparkSession.sparkContext
    docs = without(docs, "held_out", "score", "predicted")
    vectors = word_vectors(docs)
    model = fit(*training_rows(docs, labels, sc.broadcast(vectors), most, folds))
    held = sc.broadcast((vectors, model))  # 1 MB of vectors and a small network
    out = docs.withColumn("score", score_of(F.col("text"), held)).withColumn("held_out", hold_out(docs["doc_id"], folds))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
