"""Line dedup: two Bloom filters name the suspected repeats; only those shuffle for an exact check.

1. Tasks hash the keys of their lines; each segment of the once-seen and the
   twice-seen filter is built from the fragments that name it. A key whose bits
   are all in *once* already goes into *twice*.
2. The twice-seen filter goes to every worker (``filter_bits / 8`` bytes at most).
   A line whose key is not in it is no repeat and is never shuffled.
3. Suspects shuffle as (SHA-256 of the key, doc_id, hash of the text): counting distinct
   documents is exact, false suspects fall out, and a hot line is counted map-side first.
4. Documents receive the digests of the lines they lose, by doc_id and hash of the text:
   only those of their own lines, on however many rows an id (or none) stands.

Defined cases: a null or empty text is one empty line; a repeated row counts as
the same document (same doc_id); a row without doc_id is no document, so it does
not count towards a line's documents, and loses every line that was found in
``min_docs`` documents; an empty table gives an empty result; input columns
named like an output column are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewsift.llm import bloom
from viewsift.llm.common import packed, power_of_two, slices, text_bytes, unpacked, without
from viewsift.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3
#: Upper bound of one filter: 2^28 bits are 32 MiB on each worker.
MAX_FILTER_BITS = 1 << 28
#: Filter bits per document when the bound does not bind (some ten lines a document).
BITS_PER_DOC = 128
#: Hashes a task gathers before it writes fragments.
FLUSH_HASHES = 1 << 20


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, or None where it is too short to count."""
    key = line.strip()
    if len(key) < min_chars:
        return None
    if len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key.lower()


def keys_of(text: bytes, min_chars: int) -> set[bytes]:
    return {k for k in (line_key(line, min_chars) for line in text.split(b"\n")) if k is not None}


def _fragments(min_chars: int, segments: int):
    """Task: fragments (segment, sub-keys once seen, sub-keys seen again) of its documents' keys."""
    def flush(hashes: list[int]):
        h, n = np.unique(np.array(hashes, np.uint64), return_counts=True)
        seg, sub = bloom.segment_of(h, segments), bloom.sub_keys(h)
        starts = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
        ends = np.r_[starts[1:], len(seg)]
        return pa.RecordBatch.from_arrays(
            [pa.array(seg[starts], pa.int32()),
             pa.array([sub[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
             pa.array([sub[a:b][n[a:b] > 1].tobytes() for a, b in zip(starts, ends)], pa.binary())],
            names=["segment", "once", "again"])

    def run(batches):
        found: list[int] = []
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                found.extend(map(xxhash.xxh3_64_intdigest, keys_of(text, min_chars)))
                if len(found) >= FLUSH_HASHES:
                    yield flush(found)
                    found = []
        if found:
            yield flush(found)
    return run


def _build_twice(batches):
    """Task: the twice-seen filter of each segment; its fragments arrive one after the other."""
    current, once, twice = None, None, None

    def built():
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([bloom.pack(twice)], pa.binary())],
                                          names=["segment", "bits"])

    for batch in batches:
        for segment, keys, again in zip(*(c.to_pylist() for c in batch.columns)):
            if segment != current:
                if current is not None:
                    yield built()
                current = segment
                once, twice = np.zeros(bloom.SEGMENT_BITS, bool), np.zeros(bloom.SEGMENT_BITS, bool)
            sub = np.frombuffer(keys, np.uint32)
            p, q = bloom.positions(sub, 0), bloom.positions(sub, 1)
            seen = once[p] & once[q]
            twice[p[seen]] = twice[q[seen]] = True
            once[p] = once[q] = True
            sub = np.frombuffer(again, np.uint32)
            twice[bloom.positions(sub, 0)] = twice[bloom.positions(sub, 1)] = True
    if current is not None:
        yield built()


def twice_filter(docs: DataFrame, filter_bits: int, min_chars: int = MIN_CHARS) -> bytes:
    """The twice-seen Bloom filter over the line keys of ``docs.text``."""
    segments = bloom.n_segments(filter_bits)
    found = docs.select("text").mapInArrow(_fragments(min_chars, segments),
                                           "segment int, once binary, again binary")
    built = (found.repartition("segment").sortWithinPartitions("segment")
             .mapInArrow(_build_twice, "segment int, bits binary"))
    return bloom.collect_filter(built, segments)


def _suspects(held, min_chars: int, segments: int):
    """Task: (digest, doc_id, text hash) of each key that the twice-seen filter knows."""
    def run(batches):
        twice = bloom.as_array(held.value)
        for batch in batches:
            texts, ids, marks = text_bytes(batch.column(1)), batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for a, b in slices(texts):
                keys: list[bytes] = []
                owner: list = []
                for i in range(a, b):
                    own = keys_of(texts[i], min_chars)
                    keys.extend(own)
                    owner.extend([i] * len(own))
                h = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
                seg, sub = bloom.segment_of(h, segments), bloom.sub_keys(h)
                hit = bloom.test(twice, seg, bloom.positions(sub, 0)) & bloom.test(twice, seg, bloom.positions(sub, 1))
                at = np.flatnonzero(hit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([hashlib.sha256(keys[i]).digest() for i in at], pa.binary()),
                     pa.array([ids[owner[i]] for i in at], pa.int64()), pa.array([marks[owner[i]] for i in at], pa.int64())],
                    names=["key", "doc_id", "mark"])
    return run


def _drop_lines(min_chars: int):
    """Arrow UDF: (number of dropped lines, the kept text) given the digests of the lines to drop."""
    @F.arrow_udf("struct<n_dropped: bigint, kept: string>")
    def drop(text: pa.Array, digests: pa.Array) -> pa.Array:
        n_dropped, texts = [], []
        for t, gone in zip(text_bytes(text), digests.to_pylist()):
            lost, kept, lines = set(gone or ()), [], t.split(b"\n")
            for line in lines if lost else ():
                key = line_key(line, min_chars)
                if key is None or hashlib.sha256(key).digest() not in lost:
                    kept.append(line)
            n_dropped.append(len(lines) - len(kept))
            texts.append(b"\n".join(kept))
        return pa.StructArray.from_arrays([pa.array(n_dropped, pa.int64()), pa.array(texts, pa.binary()).view(pa.string())],
                                          names=["n_dropped", "kept"], mask=digests.is_null())
    return drop


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``docs`` (doc_id, text, more columns) with ``text`` deduplicated, plus n_lines and n_dropped."""
    spark = docs.sparkSession
    docs = without(docs, "n_lines", "n_dropped")
    bits = power_of_two(docs.count() * BITS_PER_DOC, bloom.SEGMENT_BITS, max_filter_bits)
    held = spark.sparkContext.broadcast(twice_filter(docs, bits, min_chars))  # bits / 8 bytes, bounded

    mark = F.xxhash64("text")
    suspects = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", mark.alias("mark")).mapInArrow(
        _suspects(held, min_chars, bloom.n_segments(bits)), "key binary, doc_id long, mark long")
    suspects = materialize(suspects, "line-suspects")
    repeats = (suspects.groupBy("key")
               .agg(F.count_distinct("doc_id").alias("_docs"), F.max("doc_id").alias("_last"))
               .where(F.col("_docs") >= min_docs).select("key", "_last"))
    repeats = materialize(repeats, "line-repeats")  # both join sides are plain scans, so a hot line can be split
    lost = (suspects.join(repeats, "key")
            .where(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("_last")))
            .groupBy(F.col("doc_id").alias("_lost_id"), F.col("mark").alias("_lost_mark"))
            .agg(F.collect_set("key").alias("_lost")))  # lines of one text

    text = F.coalesce(F.col("_text"), F.lit(""))
    joined = packed(docs, _id=F.col("doc_id").cast("long"), _text=F.col("text"), _mark=mark).join(
        lost, F.col("_id").eqNullSafe(F.col("_lost_id")) & (F.col("_mark") == F.col("_lost_mark")), "left")
    # Only documents that lose a line go through Python.
    cut = joined.withColumn("_cut", _drop_lines(min_chars)(
        F.when(F.col("_lost").isNotNull(), F.col("_text")), F.col("_lost")))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    cut = cut.select("_row", F.coalesce("_cut.kept", text).alias("_kept"), n_lines.cast("long").alias("n_lines"),
                     F.coalesce("_cut.n_dropped", F.lit(0)).cast("long").alias("n_dropped"))
    return unpacked(cut, docs.columns, "n_lines", "n_dropped", text=F.col("_kept"))
