"""SimHash near-dedup: 64-bit fingerprints of word shingles, compared exactly in tiles.

Distinct fingerprints are dealt by bit bands: with ``max_bits`` differing bits,
one of ``max_bits + 1`` bands is equal, so every link lies inside a bucket
(band, value) and no fingerprint is compared with all others. Inside the buckets,
rows sorted by (bucket, population count) are cut into tiles; two tiles are
compared as a whole by exclusive-or and bit counts, unless they share no bucket
or their population counts differ by more than ``max_bits``. A bucket too large
for one task is cut into pieces and every pair of pieces becomes a unit of its
own. Each unit reports a forest of its links (not all pairs); components are
found over these links.

Defined cases: a null or empty text, or one without words, has fingerprint zero,
and is linked like any other; fewer words than a shingle give one shingle of all
words; repeated rows and equal texts share a fingerprint and so a component; a
row without doc_id takes part but names no component (null if nobody else does);
an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewsift.llm.common import packed, text_bytes, unpacked, without
from viewsift.llm.components import connected_components
from viewsift.session import materialize

SHINGLE = 3
MAX_BITS = 2
#: Fingerprints of a tile: a pair of tiles is one 1024 x 1024 comparison (8 MB).
TILE = 1024
#: Fingerprints of a bucket piece; a larger bucket is cut.
PIECE = 16_384
HASH_SEED = 42
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of a text: a bit is set where over half of the shingles' hashes set it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, HASH_SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    h = np.array(hashes, np.uint64).view(np.uint8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 8 * SHINGLES_AT_ONCE):
        bits = np.unpackbits(h[at:at + 8 * SHINGLES_AT_ONCE].reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint_of(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a (signed) long."""
    @F.arrow_udf(T.LongType())
    def run(texts: pa.Array) -> pa.Array:
        found = np.fromiter((fingerprint(t, shingle) for t in text_bytes(texts)), np.uint64, len(texts))
        return pa.array(found.view(np.int64), pa.int64())
    return run(text)


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _bands(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of ``max_bits + 1`` bands over the 64 bits."""
    edges = [64 * i // (max_bits + 1) for i in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


class _Forest:
    """Union-find over row numbers; the root is the smallest row."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)


def link_tiles(unit: np.ndarray, fp: np.ndarray, max_bits: int = MAX_BITS, tile: int = TILE) -> np.ndarray:
    """Rows sorted by (unit, population count) → for each row the smallest row it is linked to.

    ``unit`` numbers the rows' units. A tile may hold several small units; links
    across units are links all the same.
    """
    n = len(fp)
    pops = np.bitwise_count(fp).astype(np.int16)
    forest = _Forest(n)
    starts = range(0, n, tile)
    span = [(int(pops[a:a + tile].min()), int(pops[a:a + tile].max())) for a in starts]
    for i, a in enumerate(starts):
        one = fp[a:a + tile]
        for j in range(i, len(span)):
            b = j * tile
            if j > i and unit[b] != unit[min(a + tile, n) - 1]:
                break  # tiles from here on share no unit with this one
            if span[j][0] - span[i][1] > max_bits or span[i][0] - span[j][1] > max_bits:
                continue
            near = np.bitwise_count(one[:, None] ^ fp[None, b:b + tile]) <= max_bits
            if i == j:
                near = np.triu(near, 1)
            forest.join(*_tile_links(near, a, b))
    return np.fromiter(map(forest.root, range(n)), np.int64, n)


def _tile_links(near: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows ``a + i`` and ``b + j`` of a tile pair; of many, one per row and column.

    Many links (a cluster of near copies) are replaced by links to the smallest
    column of each component, found by spreading minima over the matrix.
    """
    x, y = np.nonzero(near)
    if len(x) <= 4 * TILE:
        return x + a, y + b
    none = near.shape[1]
    columns = np.arange(none)
    label = columns
    while True:
        rows = np.where(near, label[None, :], none).min(axis=1)
        spread = np.minimum(label, np.where(near, rows[:, None], none).min(axis=0))
        if np.array_equal(spread, label):
            break
        label = spread
    r, c = np.flatnonzero(rows < none), np.flatnonzero(label != columns)
    return np.r_[r + a, c + b], np.r_[rows[r] + b, label[c] + b]


def _compare(max_bits: int):
    """Task: links (hi, lo) of the sorted rows (unit, fp) of its units."""
    def links(units: np.ndarray, fps: np.ndarray):
        unsigned = fps.view(np.uint64)
        root = link_tiles(units, unsigned, max_bits)
        at = np.flatnonzero(root != np.arange(len(fps)))
        a, b = fps[at], fps[root[at]]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["hi", "lo"])

    def run(batches):
        units, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            units = np.r_[units, batch.column(0).to_numpy()]
            fps = np.r_[fps, batch.column(1).to_numpy()]
            # rows of the last unit may go on in the next batch
            ready = int(np.searchsorted(units, units[-1], "left")) if len(units) else 0
            if ready >= TILE:
                yield links(units[:ready], fps[:ready])
                units, fps = units[ready:], fps[ready:]
        if len(fps):
            yield links(units, fps)
    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, piece: int = PIECE) -> DataFrame:
    """Links (hi, lo) between distinct fingerprints (``fp`` long) that differ in at most ``max_bits`` bits.

    Not every pair: a forest per unit, whose components are those of all pairs.
    """
    bands = F.array(*[F.struct(F.lit(k).alias("band"),
                               F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1).alias("value"))
                      for k, (shift, width) in enumerate(_bands(max_bits))])
    rows = fps.select("fp", F.explode(bands).alias("b")).select("fp", "b.band", "b.value")
    sizes = rows.groupBy("band", "value").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    rows = rows.join(sizes, ["band", "value"])  # a bucket of one has no partner
    pieces = F.ceil(F.col("_n") / piece).cast("int")
    own = F.pmod(F.xxhash64("fp"), pieces).cast("int")
    # Piece i meets every piece j in the unit (min, max): all pairs of pieces, each in one unit.
    other = F.explode(F.sequence(F.lit(0), pieces - 1)).alias("_other")
    units = rows.select("fp", "band", "value", own.alias("_own"), other).select(
        F.xxhash64("band", "value", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("unit"), "fp")
    pop = F.bit_count("fp")
    return (units.repartition("unit").sortWithinPartitions("unit", pop, "fp")
            .mapInArrow(_compare(max_bits), "hi long, lo long"))


def _roots(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fps`` (distinct ``fp``, more columns) plus ``root``, a fingerprint that names the component."""
    roots = connected_components(fingerprint_links(fps.select("fp"), max_bits))
    return fps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (long) and component_id of every row of ``docs`` (doc_id, text)."""
    prints = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_of(F.col("text"), shingle).alias("fp"))
    prints = materialize(prints, "fingerprints")
    classes = _roots(prints.groupBy("fp").agg(F.min("doc_id").alias("_least")), max_bits)
    least = classes.groupBy("root").agg(F.min("_least").alias("component_id"))
    classes = classes.join(least, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component stays: of the smallest doc_id (rows without one come last), then of the least text hash.

    The choice is made per component, not per doc_id: an id on several rows loses only
    the rows that are copies, and rows without doc_id are copies like any other. The
    rows are written with a number, and the numbers of those that go are joined back.
    """
    rows = packed(docs, _id=F.col("doc_id").cast("long"), _text_hash=F.md5(F.col("text").cast("binary")),
                  fp=fingerprint_of(F.col("text"), shingle)).withColumn("_n", F.monotonically_increasing_id())
    rows = materialize(rows, "near-dedup-rows")
    order = F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "_text_hash", "_n")
    classes = _roots(rows.groupBy("fp").agg(F.min(order).alias("_first")), max_bits)  # combined map-side
    first = classes.groupBy("root").agg(F.min("_first").getField("_n").alias("_stays"))
    classes = classes.join(first, "root").select("fp", "_stays")
    gone = rows.select("_n", "fp").join(classes, "fp").where("_n <> _stays").select("_n")
    return unpacked(rows.select("_n", "_row").join(gone, "_n", "left_anti"), docs.columns)
