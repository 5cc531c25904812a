"""Bloom filters in segments, built by Spark tasks and held by every worker.

A filter of ``2**k`` bits is cut into segments of 2^20 bits. A key (a 64-bit
hash) belongs to the segment named by its top bits and sets its bits there, so
each segment is built by one task from the fragments that name it, in bounded
memory, and the built filter is a small table (segment, bits). Its size is fixed
by a parameter, never by the data, which is what bounds the broadcast; too small
a filter only tells more falsehoods.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from viewsift.llm.common import mix32

SEGMENT_BITS = 1 << 20
_LOW = np.uint64(0xFFFFFFFF)


def n_segments(filter_bits: int) -> int:
    return max(1, filter_bits // SEGMENT_BITS)


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    """Segment of each uint64 hash: its top bits (``segments`` is a power of two)."""
    bits = segments.bit_length() - 1
    if not bits:
        return np.zeros(len(hashes), np.int32)
    return (hashes >> np.uint64(64 - bits)).astype(np.int32)


def sub_keys(hashes: np.ndarray) -> np.ndarray:
    """The 32 bits that name a hash inside its segment."""
    return (hashes & _LOW).astype(np.uint32)


def positions(sub: np.ndarray, probe: int) -> np.ndarray:
    """Bit positions inside the segment for one probe number."""
    salt = np.uint32((probe * 0x9E3779B9) & 0xFFFFFFFF)
    return mix32(sub ^ salt) >> np.uint32(12)


def pack(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


def collect_filter(segments_df: DataFrame, segments: int) -> bytes:
    """The whole filter on the driver: at most ``segments`` rows of 128 KiB, a size set by parameter."""
    size = SEGMENT_BITS // 8
    out = bytearray(segments * size)
    for row in segments_df.toLocalIterator():
        out[row["segment"] * size:(row["segment"] + 1) * size] = row["bits"]
    return bytes(out)


def as_array(filter_bytes: bytes) -> np.ndarray:
    return np.frombuffer(filter_bytes, np.uint8)


def test(filter_array: np.ndarray, segment: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Whether the bit at each (segment, position) is set."""
    at = (segment.astype(np.int64) << 17) + (position >> np.uint32(3))
    return (filter_array[at] >> (position & np.uint32(7)).astype(np.uint8)) & 1 == 1
