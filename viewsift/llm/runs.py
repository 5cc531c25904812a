"""Periodic runs: stretches of words that repeat with a period, found by seeds extended along diagonals.

A run of period q is a maximal stretch whose words q apart are identical, so the
text equals itself, shifted by the lag q, along a stretch of a diagonal.

1. Index: the words of a text are numbered, and every window of k words gets an
   exact name by doubling (a window of 2k is named by the names of its halves).
   A run is at least ``max(LEAST_WORDS, LEAST_TIMES * q)`` long, so a run of q up
   to 16 matches itself over 16 words at least, one of q in (k/2, k] over 2q > k:
   k is the overlap that runs of these periods guarantee (k = 16, 32, 64, ...).
2. Seeds: of each named window only *neighbouring* occurrences in the same text
   are paired, so their number is linear. That loses no run: inside a run a window
   of k >= q words can't return sooner than after q words, or q would not be the
   smallest period; for the same reason a seed's lag is the smallest period.
3. Extension: a seed's diagonal is followed both ways to the first unequal words;
   per lag, the furthest position covered skips the seeds of the same stretch.
   Wider windows are only named in texts that still repeat one.

Defined cases: a null or empty text, or one without words, has no runs and
collapses to the empty text; texts without runs collapse to their words joined by
single spaces; runs of several periods may overlap and all are reported; repeated
rows are treated each; an empty table gives an empty result; input columns named
like an output column are dropped. Texts are compared as bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewsift.llm.common import spans, without

LEAST_WORDS = 24
LEAST_TIMES = 3
#: The overlap guaranteed by the shortest runs: min over q of max(24, 3q) - q.
FIRST_GRAM = 16
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
OUT = T.StructType([T.StructField("runs", T.ArrayType(RUN)), T.StructField("best", RUN), T.StructField("collapsed", T.StringType())])


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one array, and where each text's begin (and the last ends)."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = split.flatten()
    real = pc.binary_length(flat).to_numpy() > 0
    held = np.r_[0, np.cumsum(real)]
    offsets = split.offsets.to_numpy()
    return flat.filter(pa.array(real)), held[offsets - offsets[0]]


def _names(names: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Names of the windows of ``2 * width`` words at ``at``, from those of ``width`` words."""
    key = names[at] * (names.max(initial=0) + 1) + names[at + width]
    out = np.full(len(names), -1, np.int64)
    out[at] = np.unique(key, return_inverse=True)[1]
    return out


def _seeds(names: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring occurrences of one window in one text: (first position, lag)."""
    order = at[np.argsort(names[at], kind="stable")]
    here, after = order[:-1], order[1:]
    same = (names[here] == names[after]) & (doc[here] == doc[after])
    return here[same], (after - here)[same]


def _forward(codes: np.ndarray, at: int, lag: int, end: int) -> int:
    """The first position from ``at`` on whose word differs from that ``lag`` later (or the last one before ``end``)."""
    step = 64
    while at + lag < end:
        n = min(step, end - lag - at)
        unlike = np.flatnonzero(codes[at:at + n] != codes[at + lag:at + lag + n])
        if len(unlike):
            return at + int(unlike[0])
        at, step = at + n, 2 * step
    return at


def _backward(codes: np.ndarray, at: int, lag: int, begin: int) -> int:
    """The first position of the stretch of equal words that reaches ``at`` from the left."""
    step = 64
    while at > begin:
        n = min(step, at - begin)
        unlike = np.flatnonzero(codes[at - n:at] != codes[at - n + lag:at + lag])
        if len(unlike):
            return at - n + int(unlike[-1]) + 1
        at, step = at - n, 2 * step
    return at


def _extend(codes: np.ndarray, at: np.ndarray, lag: np.ndarray, begins: np.ndarray, ends: np.ndarray):
    """(start, length, period) of the runs that seeds lie in; ``begins`` and ``ends`` bound each seed's text."""
    order = np.lexsort((at, lag))
    at, lag, begins, ends = at[order], lag[order], begins[order], ends[order]
    edges = np.flatnonzero(np.r_[True, lag[1:] != lag[:-1], True]) if len(lag) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        d, i = int(lag[a]), a
        while i < b:
            covered = _forward(codes, int(at[i]), d, int(ends[i]))
            start = _backward(codes, int(at[i]), d, int(begins[i]))
            if covered + d - start >= max(LEAST_WORDS, LEAST_TIMES * d):
                yield start, covered + d - start, d
            i += int(np.searchsorted(at[i:b], covered))


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period; texts are ``codes[bounds[i]:bounds[i + 1]]``."""
    lengths = np.diff(bounds)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    begins, ends = bounds[:-1][doc], bounds[1:][doc]
    names, at, width = codes.astype(np.int64), np.arange(len(codes)), 1
    keep = lengths >= LEAST_WORDS
    found: list[tuple[int, int, int]] = []
    while keep.any():
        at = at[keep[doc[at]] & (at + 2 * width <= ends[at])]
        if not len(at):
            break
        names, width = _names(names, at, width), 2 * width
        if width < FIRST_GRAM:
            continue
        here, lag = _seeds(names, at, doc)
        own = (lag <= width) & ((lag > width // 2) | (width == FIRST_GRAM))
        found += _extend(codes, here[own], lag[own], begins[here[own]], ends[here[own]])
        # a longer period needs a longer window to return, and three times its length
        keep = np.zeros(len(lengths), bool)
        keep[doc[here]] = True
        keep &= lengths >= LEAST_TIMES * (width + 1)
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _best(runs: np.ndarray) -> int:
    """Place of the run with the greatest length / period, the first of several."""
    best = 0
    for i in range(1, len(runs)):
        if int(runs[i, 1]) * int(runs[best, 2]) > int(runs[best, 1]) * int(runs[i, 2]):
            best = i
    return best


def _struct(rows: np.ndarray, mask: np.ndarray | None = None) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(rows[:, i], pa.int64()) for i in range(3)], fields=[
        pa.field(n, pa.int64()) for n in RUN.names], mask=None if mask is None else pa.array(mask))


def _collapse(texts: pa.Array) -> pa.StructArray:
    flat, bounds = _words(texts)
    codes = flat.dictionary_encode().indices.to_numpy()
    runs = find_runs(codes, bounds)
    doc = np.searchsorted(bounds, runs[:, 0], "right") - 1
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edges)[:-1] == 0
    at = np.r_[0, np.cumsum(kept)][bounds]
    words = pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat.filter(pa.array(kept)))
    runs[:, 0] -= bounds[doc]
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    best = np.zeros((len(texts), 3), np.int64)
    for i in np.flatnonzero(np.diff(cut)).tolist():
        own = runs[cut[i]:cut[i + 1]]
        best[i] = own[_best(own)]
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), _struct(runs)), _struct(best, np.diff(cut) == 0),
         pc.binary_join(words, " ")], names=OUT.names)


def _run(batches, at: int, names: list[str]):
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        for a, b in spans(sizes):
            part = batch.slice(a, b - a)
            out = _collapse(part.column(at))
            yield pa.RecordBatch.from_arrays([*part.columns, *out.flatten()], names=names)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (text, more columns) plus ``runs`` (by start, then period), ``best`` and the ``collapsed`` text.

    Of every run its first period stays, all words after it go. ``best`` is the run
    with the greatest length / period (of several the first; null without runs).
    Word numbers count from 0.
    """
    docs = without(docs, *OUT.names)
    names = [*docs.columns, *OUT.names]
    at = names.index("text")
    return docs.mapInArrow(lambda batches: _run(batches, at, names), T.StructType([*docs.schema.fields, *OUT.fields]))


def run_lines(runs: Column) -> Column:
    """A run array as text: one line ``start,length,period`` each."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
