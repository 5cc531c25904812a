"""Helpers shared by the operators: text bytes out of Arrow, bounded slices, flat hashing.

White space means the six ASCII characters ``[\\x20\\x09-\\x0D]`` throughout;
``bytes.split()`` and ``bytes.strip()`` use exactly these, and ``bytes.lower()``
lower-cases exactly A-Z, so tasks work on UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text a Python task works on at once; one longer document is a slice of its own.
SLICE_BYTES = 2 << 20

WS_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD_BREAK = WS_CLASS + "+"


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def spans(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes add up to about ``limit`` each."""
    start = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= limit:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` that hold about ``limit`` bytes each; whole texts only."""
    return spans(list(map(len, texts)), limit)


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_text(col: Column) -> Column:
    """A document id as text; a missing id is the empty text."""
    return F.coalesce(col.cast("string"), F.lit(""))


def hold_out(doc_id: Column, folds: int, fold: int = 2) -> Column:
    """True where crc32 of the id as text falls in the held-out fold."""
    return F.crc32(id_text(doc_id).cast("binary")) % folds == fold


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """The whole row as one struct ``_row`` beside named keys: no input column can clash with them."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
                       *[c.alias(k) for k, c in keys.items()])


def unpacked(df: DataFrame, columns: list[str], *more: str, **replaced: Column) -> DataFrame:
    """The columns of ``_row`` again, some replaced, and ``more`` columns beside them."""
    row = F.col("_row")
    return df.select(*[(replaced[c] if c in replaced else row.getField(c)).alias(c) for c in columns], *more)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns named like an output column (in any case)."""
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in names])


def mix32(x: np.ndarray) -> np.ndarray:
    """A well-mixed 32-bit permutation of uint32 values."""
    x = x.astype(np.uint32, copy=True)
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    return x ^ (x >> np.uint32(16))


def power_of_two(n: float, least: int, most: int) -> int:
    """The smallest power of two that is at least ``n``, within ``least`` and ``most``."""
    return min(max(1 << max(0, int(np.ceil(np.log2(max(n, 1))))), least), most)
