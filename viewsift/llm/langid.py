"""Language identification by prediction with partial matching (PPM) over bytes.

Per language, a tree of byte contexts of up to ``ORDER`` bytes counts which byte
follows. A byte is coded in the longest context that has seen it; each longer
context that has not costs its escape code (method C: a context with N sights of
D different bytes escapes with D / (N + D)); below order 0 all bytes are alike.
The statistics are frozen after training, so the code length of a text is exact:
the sum over its bytes. The language with the shortest code is predicted, and the
score is its share of the posterior with equal priors.

Training reads a bounded sample: per language distinct documents in the order of a
hash of doc_id and text while their bytes fit into the language's share, ``TRAIN_BYTES`` / number of
languages but at least ``LEAST_SHARE``. A text of more than about an eighth of the
share is learned from in pieces that carry their context: in the order of a hash
they fill what the whole documents leave, so every language with a text is
learned. Contexts are counted by Spark; the counts are bounded by the sample. Every document is scored whole, in pieces of bounded
size that carry their context.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as
is every text when nothing could be learned; ties go to the first language in
alphabetical order; rows without lang are never learned from, those without
doc_id hash like the empty text; repeated rows are scored each; an empty table
gives an empty result; input columns named like an output column are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from viewsift.llm.common import SLICE_BYTES, hold_out, id_text, text_bytes, without
from viewsift.llm.mixing import unit_hash

ORDER = 3
#: Bytes of text learned from, over all languages.
TRAIN_BYTES = 8 << 20
#: Bytes of text that each language may learn from, however many languages there are.
LEAST_SHARE = 2048
FOLDS = 4
UNDETERMINED = "und"
_START = b"\n" * ORDER
OUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """Every ``length`` bytes in a row as one number, the last byte lowest."""
    out = np.zeros(max(0, len(data) - length + 1), np.uint32)
    for i in range(length):
        out = (out << np.uint32(8)) | data[i:i + len(out)]
    return out


def _count(batches):
    """Task: (lang, length, gram, n) over the texts of its rows, each after its context."""
    for batch in batches:
        langs, texts, before = batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()
        for lang in sorted(set(langs)):
            data = [np.frombuffer(b + t, np.uint8) for o, t, b in zip(langs, texts, before) if o == lang]
            for length in range(1, ORDER + 2):
                # every gram ends on a byte of the text: shorter ones skip the part of the start they don't need
                own, n = np.unique(np.concatenate([grams(d[ORDER + 1 - length:], length) for d in data]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(own), pa.string()), pa.array([length] * len(own), pa.int32()),
                     pa.array(own.astype(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "length", "gram", "n"])


def pieces(text: bytes, size: int):
    """(piece, the ``ORDER`` bytes before it) of a text; pieces of at most ``size`` bytes end between characters."""
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        while at + 4 < end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        yield text[at:end], (_START + text[max(0, at - ORDER):at])[-ORDER:]
        at = end


def _draw_pieces(size: int, rates: dict[str, float]):
    """Task: (lang, text, before, _u, _bytes) of the long texts' pieces whose hash is below their language's rate."""
    def run(batches):
        for batch in batches:
            for lang, text, key in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()):
                seed = xxhash.xxh64_intdigest(key.encode())
                found = [(piece, before, u) for i, (piece, before) in enumerate(pieces(text, size))
                         if (u := xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed) / 2.0 ** 64) <= rates[lang]]
                part, before, u = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(part, pa.binary()).view(pa.string()),
                     pa.array(before, pa.binary()), pa.array(u, pa.float64()), pa.array(map(len, part), pa.int64())],
                    names=["lang", "text", "before", "_u", "_bytes"])
    return run


def training_sample(docs: DataFrame, train_bytes: int = TRAIN_BYTES, folds: int = FOLDS) -> DataFrame:
    """(lang, text, before) of what is learned from: bounded in bytes per language; ``before`` is a text's context."""
    own = docs.where(~hold_out(F.col("doc_id"), folds) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    # rows that share an id (or have none) do not share a draw; equal rows do, and are learned from once
    key = F.concat(F.lit("langid:"), id_text(F.col("doc_id")), F.lit(":"), F.md5(F.col("text").cast("binary")))
    own = own.select("lang", "text", key.alias("_key"), unit_hash(key).alias("_u"),
                     F.octet_length("text").cast("long").alias("_bytes"))
    # One row per language and bit length: the size from which a text is cut depends on the number of languages.
    width = F.length(F.bin("_bytes"))
    totals = own.select("lang", "_key", "_u", "_bytes").distinct().groupBy("lang", width.alias("width")) \
        .agg(F.sum("_bytes").alias("n"), F.min("_u").alias("least")).collect()
    langs = {r["lang"] for r in totals}
    if not langs:
        return own.select("lang", "text", F.lit(_START).alias("before")).limit(0)
    share = max(train_bytes // len(langs), LEAST_SHARE)
    longest = (share // 8).bit_length() - 1  # a document of up to so many bits is taken whole
    whole, cut, least = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
    for r in totals:
        if r["width"] > longest:
            cut[r["lang"]] += r["n"]
        else:
            least[r["lang"]] = min(least[r["lang"]], r["least"]) if whole[r["lang"]] else r["least"]
            whole[r["lang"]] += r["n"]

    def rate(size: int, total: int) -> float:
        # Twice the size passes the hash, in expectation; the running sum then holds the bound exactly.
        return 2.0 * size / max(total, 1)
    # the first document passes in any case
    limit = F.create_map(*[F.lit(x) for o in sorted(langs) for x in (o, max(least[o], rate(share, whole[o])))])
    drawn = own.where((width <= longest) & (F.col("_u") <= limit[F.col("lang")])).dropDuplicates(["lang", "_key"]) \
        .select("lang", "text", F.lit(_START).alias("before"), "_u", "_bytes", F.lit(0).alias("_rank"))
    if any(cut.values()):
        rates = {o: rate(max(0, share - whole[o]), cut[o]) for o in langs}
        parts = own.where(width > longest).select("lang", "text", "_key").mapInArrow(
            _draw_pieces(1 << longest, rates), "lang string, text string, before binary, _u double, _bytes long") \
            .dropDuplicates(["lang", "_u", "text"])
        drawn = drawn.unionByName(parts.withColumn("_rank", F.lit(1)))
    order = Window.partitionBy("lang").orderBy("_rank", "_u", F.md5(F.col("text").cast("binary"))) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return drawn.withColumn("_sum", F.sum("_bytes").over(order)).where(F.col("_sum") <= share).select("lang", "text", "before")


class PpmModel:
    """Frozen code lengths: per order, the known grams and contexts of any language, one column per language."""

    def __init__(self, langs: list[str], counts: dict[int, tuple[np.ndarray, np.ndarray]]):
        """``counts``: gram length → (sorted grams, their counts per language)."""
        self.langs = langs
        self.keys: dict[int, np.ndarray] = {}
        self.bits: dict[int, np.ndarray] = {}
        self.contexts: dict[int, np.ndarray] = {}
        self.escape: dict[int, np.ndarray] = {}
        self.slots: dict[tuple[str, int], np.ndarray] = {}
        for length in range(1, ORDER + 2):
            keys, n = counts[length]
            contexts, inverse = np.unique(keys >> np.uint32(8), return_inverse=True)
            total, kinds = np.zeros((2, len(contexts), len(langs)))
            np.add.at(total, inverse, n)
            np.add.at(kinds, inverse, n > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
                seen = np.log2((total + kinds)[inverse] / n)
            lower = self._lower(keys, length)
            self.contexts[length], self.escape[length] = contexts, escape.astype(np.float32)
            self.keys[length] = keys
            self.bits[length] = np.where(n > 0, seen, escape[inverse] + lower).astype(np.float32)
            self._index("keys", length, keys)
            self._index("contexts", length, contexts)

    def _index(self, what: str, length: int, keys: np.ndarray) -> None:
        """An open hash table of the rows of ``keys``."""
        size = 1 << max(8, int(np.ceil(np.log2(4 * max(1, len(keys))))))
        table = np.full(size, -1, np.int32)
        at, rest = self._slot(keys, size), np.arange(len(keys), dtype=np.int32)
        while len(rest):
            free = table[at] < 0
            table[at[free]] = rest[free]  # of several rows for one slot, the last stays
            lost = table[at] != rest
            at, rest = (at[lost] + 1) & (size - 1), rest[lost]
        self.slots[what, length] = table

    @staticmethod
    def _slot(keys: np.ndarray, size: int) -> np.ndarray:
        return ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - (size.bit_length() - 1))).astype(np.int64)

    def _find(self, what: str, length: int, wanted: np.ndarray) -> np.ndarray:
        """Row of each wanted key, -1 where there is none."""
        table, keys = self.slots[what, length], getattr(self, what)[length]
        row = np.full(len(wanted), -1, np.int32)
        if not len(keys):
            return row
        at, rest = self._slot(wanted, len(table)), None
        found = table[at]
        hit = (found >= 0) & (keys[found] == wanted)
        row[hit] = found[hit]
        rest = np.flatnonzero((found >= 0) & ~hit)
        while len(rest):
            at[rest] = (at[rest] + 1) & (len(table) - 1)
            found = table[at[rest]]
            hit = (found >= 0) & (keys[found] == wanted[rest])
            row[rest[hit]] = found[hit]
            rest = rest[(found >= 0) & ~hit]
        return row

    def _lower(self, wanted: np.ndarray, length: int) -> np.ndarray:
        """Code lengths of the last byte in the context shorter by one byte."""
        if length == 1:
            return np.full((len(wanted), len(self.langs)), 8.0)
        return self.code_lengths(wanted & np.uint32((1 << (8 * (length - 1))) - 1), length - 1)

    def code_lengths(self, wanted: np.ndarray, length: int = ORDER + 1) -> np.ndarray:
        """Bits of the last byte of each gram after the bytes before it, per language."""
        row = self._find("keys", length, wanted)
        out = self.bits[length][np.maximum(row, 0)] if len(self.keys[length]) else \
            np.zeros((len(wanted), len(self.langs)), np.float32)
        new = np.flatnonzero(row < 0)
        if len(new):
            rest = wanted[new]
            context = self._find("contexts", length, rest >> np.uint32(8))
            escape = self.escape[length][np.maximum(context, 0)] * (context >= 0)[:, None] \
                if len(self.contexts[length]) else 0.0
            out[new] = escape + self._lower(rest, length)
        return out

    def text_bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each whole text per language."""
        out = np.zeros((len(texts), len(self.langs)))
        parts, owners, size = [], [], 0
        for i, text in enumerate(texts):
            data = _START + text
            for at in range(0, len(text), SLICE_BYTES):  # the next piece starts with its context
                parts.append(data[at:at + SLICE_BYTES + ORDER])
                owners.append(i)
                size += len(parts[-1])
                if size >= SLICE_BYTES:
                    self._add(out, parts, owners)
                    parts, owners, size = [], [], 0
        if parts:
            self._add(out, parts, owners)
        return out

    def _add(self, out: np.ndarray, parts: list[bytes], owners: list[int]) -> None:
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(lengths)
        bits = self.code_lengths(grams(np.frombuffer(b"".join(parts), np.uint8), ORDER + 1))
        for back in range(1, ORDER + 1):  # grams that run into the next part
            at = ends - back
            bits[at[at < len(bits)]] = 0
        np.add.at(out, owners, np.add.reduceat(bits, ends - lengths, axis=0, dtype=np.float64))


def train(docs: DataFrame, train_bytes: int = TRAIN_BYTES, folds: int = FOLDS) -> PpmModel | None:
    """The model learned from ``docs`` (doc_id, text, lang), or None without anything to learn from."""
    found = training_sample(docs, train_bytes, folds).mapInArrow(_count, "lang string, length int, gram long, n long")
    table = found.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")).toArrow()  # bounded by the sample
    langs = sorted(set(table["lang"].to_pylist()))
    if not langs:
        return None
    lang = np.searchsorted(langs, np.array(table["lang"].to_pylist()))
    length, gram, n = (table[c].to_numpy() for c in ("length", "gram", "n"))
    counts = {}
    for k in range(1, ORDER + 2):
        at = length == k
        keys, row = np.unique(gram[at].astype(np.uint32), return_inverse=True)
        own = np.zeros((len(keys), len(langs)))
        own[row, lang[at]] = n[at]
        counts[k] = keys, own
    return PpmModel(langs, counts)


def _letters(text: bytes) -> bool:
    return any(map(str.isalpha, text.decode("utf-8", "replace")))


def predict(text: Column, held) -> Column:
    """Struct of ``lang_pred`` and ``score``; ``held`` broadcasts the model."""
    @F.arrow_udf(OUT)
    def run(texts: pa.Array) -> pa.Array:
        model, data = held.value, text_bytes(texts)
        known = [model is not None and _letters(t) for t in data]
        lang, score = [UNDETERMINED] * len(data), [0.0] * len(data)
        rows = [i for i, k in enumerate(known) if k]
        if rows:
            bits = model.text_bits([data[i] for i in rows])
            best = bits.argmin(axis=1)
            share = 1.0 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
            for i, b, s in zip(rows, best.tolist(), share.tolist()):
                lang[i], score[i] = model.langs[b], s
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                          names=["lang_pred", "score"])
    return run(text)


def identify(docs: DataFrame, train_bytes: int = TRAIN_BYTES, folds: int = FOLDS) -> DataFrame:
    """``docs`` (doc_id, text, lang, more columns) plus held_out, lang_pred and score."""
    docs = without(docs, "held_out", "lang_pred", "score", "_p")
    held = docs.sparkSession.sparkContext.broadcast(train(docs, train_bytes, folds))  # bounded by the sample
    out = docs.withColumn("_p", predict(F.col("text"), held))
    return out.select(*[docs[f"`{c}`"] for c in docs.columns], hold_out(F.col("doc_id"), folds).alias("held_out"),
                      "_p.lang_pred", "_p.score")
