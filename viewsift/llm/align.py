"""Alignment of two tokenizers' tokens over the same text, and the corpus counts of the links.

A text, with a space before it, is encoded by a byte-level BPE (A) and by a
sentencepiece model (B, which adds the space itself). Each library tells the
spans of its tokens: A in characters, B in bytes. They are the coarse cuts: a
token whose span has as many bytes as the token ends where its span does. The
others (parts of a character, byte fallback) are refined: they end where their
decoded bytes, added up from the last sure cut, end. Where tokens of A and B end
together, the text is cut into groups; two tokens are linked if their bytes overlap.

Neither tokenizer joins characters across a space that follows a non-space, so
the text from one such space to the next is encoded, aligned and linked on its
own, and each distinct one only once while a task keeps it (``KNOWN_BYTES``). A
model whose pieces do cross such spaces is run over whole texts.

``link_counts`` counts in how many documents each pair of ids is linked (combined
per task, then by Spark). ``judge`` compares a document's links with these counts:
the most frequent pairs (at most ``HEAD_PAIRS``) are known to every task, all
others are joined by Spark, so no broadcast grows with the data and no pair that
nearly every document holds is a join key.

Defined cases: a null or empty text has no tokens, nor has a text whose tokens'
bytes differ from the space and the text (for instance one with U+2581, which B
reads as a space, or with bytes that are no UTF-8): all its counts are zero and its groups empty;
special tokens in a text are plain text; repeated rows count each; an empty table
gives an empty result; input columns named like an output column are dropped.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from viewsift.llm.common import spans, text_bytes, without
from viewsift.session import materialize

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
#: Bytes of text given to the tokenizers in one call; a longer stretch without spaces is one call.
CALL_BYTES = 1 << 17
#: Bytes of distinct words whose alignment a task keeps from one slice of texts to the next.
KNOWN_BYTES = 1 << 22
#: Pairs known to every task: 24 MiB at most.
HEAD_PAIRS = 1 << 20
#: Distinct pairs a task counts before it hands them on.
FLUSH_PAIRS = 1 << 21
SPACE = "▁"
#: A space that follows a character which is no white space.
BREAK = re.compile(r"(?<=\S)(?= )")
#: Texts without these are cut at every space.
ODD_SPACE = re.compile(r"\s |^ | $")
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
LINKS = ["link_a", "link_b", "link_n"]


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves; the other bytes, in their
    order, are the characters from U+0100 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)).difference(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def refine(begin: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes, from the library's spans and the tokens' decoded sizes."""
    total = np.cumsum(size)
    sure = np.where(end - begin == size, np.arange(len(size)), -1)
    last = np.maximum.accumulate(sure)
    return total + np.where(last >= 0, end[last] - total[last], 0)


class _Side:
    """One tokenizer's tokens: their bytes, and their ids as text with what follows them."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        ids = list(map(str, range(len(tokens))))
        self.text = {end: np.array([i + end for i in ids], object) for end in ",|;\n"}

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class TokenizerPair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_json: bytes, b_model: bytes):
        self.a_model = Tokenizer.from_str(a_json.decode())
        self.a_model.encode_special_tokens = True
        self.b_model = SentencePieceProcessor(model_proto=b_model)
        byte = byte_of_symbol()
        tokens = [b""] * self.a_model.get_vocab_size()
        for token, i in self.a_model.get_vocab().items():
            tokens[i] = bytes(map(byte.__getitem__, token)) if all(c in byte for c in token) else token.encode()
        self.a = _Side(tokens)
        pieces = [self.b_model.id_to_piece(i) for i in range(self.b_model.get_piece_size())]
        self.b = _Side([bytes((int(p[3:5], 16),)) if self.b_model.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)])
        #: Whether no piece goes on over a space, so that stretches between spaces are encoded alike alone.
        self.by_words = not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def _cuts(self, text: str, data: bytes) -> tuple[np.ndarray, ...] | None:
        """(ids, ends in bytes) of A and of B over ``data``, the bytes of ``text``; None if their bytes differ from it."""
        found = self.a_model.encode(text, add_special_tokens=False)
        a = np.array(found.ids, np.int64)
        span = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        pieces = list(self.b_model.encode(text[1:], return_type="proto").pieces)
        b = np.array([p.id for p in pieces], np.int64)
        if self.a.joined(a) != data or self.b.joined(b) != data:
            return None
        if len(text) < len(data):
            point = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            span = np.r_[0, np.cumsum(1 + (point > 0x7F).astype(np.int64) + (point > 0x7FF) + (point > 0xFFFF))][span]
        begin, end = (np.array([getattr(p, edge) for p in pieces], np.int64) + 1 for edge in ("begin", "end"))
        begin[:1] = 0  # B was given the text without the space that it adds
        return a, refine(span[:, 0], span[:, 1], self.a.size[a]), b, refine(begin, end, self.b.size[b])

    def align(self, words: list[str]) -> list[tuple]:
        """Parts of the words' alignment, each for some words in a row: see ``_part``. Words with other bytes are alone."""
        text = " " + " ".join(words)
        data = text.encode()
        found = self._cuts(text, data)
        if found is not None:
            sizes = np.fromiter((len(w.encode()) for w in words), np.int64, len(words)) + 1
            ends = np.cumsum(sizes)
            if np.isin(ends, found[1]).all() and np.isin(ends, found[3]).all():
                return [self._part(ends, *found)]
        if len(words) == 1:
            none = np.zeros(1, np.int64)
            return [(np.ones(1, bool), none, none, none, none, [""], none[:0], none[:0])]
        return self.align(words[:len(words) // 2]) + self.align(words[len(words) // 2:])

    def _part(self, words: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> tuple:
        """(bad, n_a, n_b, n_groups, n_links, groups) per word, and the ids of A and B of all links in order."""
        common = np.intersect1d(a_end, b_end, assume_unique=True)

        def per_word(ends: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(ends, words, "right"), prepend=0)
        first = np.searchsorted(b_end, np.r_[0, a_end[:-1]], "right")
        n = np.searchsorted(np.r_[0, b_end[:-1]], a_end, "left") - first
        which = np.repeat(np.arange(len(a)), n)
        other = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(len(which))
        n_links = np.diff(np.r_[0, np.cumsum(n)][np.searchsorted(a_end, words, "right")], prepend=0)
        # tokens of A, then those of B, group after group
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        line = np.empty(len(a) + len(b), object)
        line[np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")] = np.where(
            np.diff(a_group, append=-1) != 0, self.a.text["|"][a], self.a.text[","][a])
        last = np.where(np.isin(common, words)[b_group], self.b.text["\n"][b], self.b.text[";"][b])
        line[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = np.where(
            np.diff(b_group, append=-1) != 0, last, self.b.text[","][b])
        return (np.zeros(len(words), bool), per_word(a_end), per_word(b_end), per_word(common), n_links,
                "".join(line.tolist()).split("\n")[:-1], a[which], b[other])

    def words_of(self, text: str) -> list[str]:
        """The text cut before every space that follows a non-space; each word is meant with one space before it."""
        if not self.by_words:
            return [text] if text else []
        if not text:
            return []
        return [w[1:] for w in BREAK.split(" " + text)] if ODD_SPACE.search(text) else text.split(" ")


class _Words:
    """The alignment of the distinct words met so far."""

    def __init__(self, pair: TokenizerPair):
        self.pair, self.rows, self.parts, self.size = pair, {}, [], 0

    def add(self, words) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        self.rows |= zip(new, range(len(self.rows), len(self.rows) + len(new)))
        sizes = [len(w.encode()) for w in new]
        self.size += sum(sizes)
        for a, b in spans(sizes, CALL_BYTES):
            self.parts += self.pair.align(new[a:b])

    def column(self, i: int) -> np.ndarray:
        return np.concatenate([p[i] for p in self.parts]) if self.parts else np.zeros(0, np.int64)

    def codes(self, texts: list[list[str]]) -> np.ndarray:
        flat = [w for t in texts for w in t]
        return np.fromiter(map(self.rows.__getitem__, flat), np.int64, len(flat))


def _decoded(data: bytes) -> str:
    """The text; empty if the bytes are no UTF-8, as no token sequence has these bytes."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return ""


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(values)][bounds])


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))


def align_texts(pair: TokenizerPair, data: list[bytes], known: _Words | None = None) -> list[pa.Array]:
    """The columns of ``COUNTS``, ``groups`` and ``LINKS`` of some texts; ``known`` holds words met before."""
    texts = list(map(_decoded, data))
    words, known = list(map(pair.words_of, texts)), known or _Words(pair)
    known.add(w for t in words for w in t)

    def place() -> tuple[np.ndarray, np.ndarray]:
        return known.codes(words), np.r_[0, np.cumsum(list(map(len, words)))].astype(np.int64)
    codes, bounds = place()
    unlike = np.flatnonzero(_sums(known.column(0).astype(np.int64)[codes], bounds)).tolist()
    if unlike:  # what differs in a word might be made up for by another: the text is judged whole
        known.add(texts[i] for i in unlike)
        bad = known.column(0)
        for i in unlike:
            words[i] = [] if bad[known.rows[texts[i]]] else [texts[i]]
        codes, bounds = place()
    counts = [pa.array(_sums(known.column(1 + i)[codes], bounds), pa.int64()) for i in range(len(COUNTS))]
    groups = pa.array([g for p in known.parts for g in p[5]], pa.string()).take(pa.array(codes))
    groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), groups), ";")
    n = known.column(4)
    starts, n, at = (np.cumsum(n) - n)[codes], n[codes], np.zeros(0, np.int64)
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    owner = np.repeat(np.repeat(np.arange(len(texts)), np.diff(bounds)), n)
    # one number per (text, id of A, id of B)
    b_size = len(pair.b.tokens)
    ids = known.column(6)[at] * b_size + known.column(7)[at]
    all_ids = len(pair.a.tokens) * b_size
    link, times = np.unique(owner * all_ids + ids, return_counts=True)
    cut = np.searchsorted(link, np.arange(len(texts) + 1) * all_ids)
    link %= all_ids
    return [*counts, groups, _lists(link // b_size, cut), _lists(link % b_size, cut), _lists(times, cut)]


_PAIRS: dict[str, TokenizerPair] = {}


def _pair(files: tuple[bytes, bytes]) -> TokenizerPair:
    """The worker's tokenizers: built once, kept between tasks."""
    name = hashlib.md5(b"".join(files)).hexdigest()
    if name not in _PAIRS:
        _PAIRS[name] = TokenizerPair(*files)
    return _PAIRS[name]


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``docs`` (text, more columns) plus the counts, ``groups`` and the links of each text.

    ``groups`` is text: ``a1,a2|b1;a3|b2,b3`` (ids of A, then of B, per group).
    ``link_a``, ``link_b`` and ``link_n`` list the distinct linked pairs and how often each occurs.
    """
    docs = without(docs, *COUNTS, "groups", *LINKS)
    files = []
    for path in (a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)):
        with open(path, "rb") as f:
            files.append(f.read())
    held = docs.sparkSession.sparkContext.broadcast(tuple(files))  # two vocabulary files, some 2 MB
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, T.LongType()) for n in COUNTS),
                           T.StructField("groups", T.StringType()), *(T.StructField(n, ints) for n in LINKS)])
    names, at = schema.names, docs.columns.index("text")

    def run(batches):
        pair = _pair(held.value)
        known = _Words(pair)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
            for a, b in spans(sizes):
                part = batch.slice(a, b - a)
                found = align_texts(pair, text_bytes(part.column(at)), known)
                yield pa.RecordBatch.from_arrays([*part.columns, *found], names=names)
                if known.size > KNOWN_BYTES:
                    known = _Words(pair)
    return docs.mapInArrow(run, schema)


def _keys(a: pa.Array, b: pa.Array) -> np.ndarray:
    """One number per pair of ids."""
    return (a.to_numpy().astype(np.int64) << 32) | b.to_numpy().astype(np.int64)


def _count_pairs(batches):
    """Task: (a, b, n) of the links of its rows, handed on whenever there are many."""
    def merged(keys, counts):
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)

    def table(key, n):
        return pa.RecordBatch.from_arrays([pa.array(key >> 32, pa.int32()), pa.array(key & 0xFFFFFFFF, pa.int32()), pa.array(n)],
                                          names=["a", "b", "n"])
    keys, counts, size = [], [], 0
    for batch in batches:
        key, n = np.unique(_keys(*(batch.column(i).flatten() for i in range(2))), return_counts=True)
        keys.append(key)
        counts.append(n)
        size += len(key)
        if size >= FLUSH_PAIRS:
            key, n = merged(keys, counts)
            keys, counts, size = [key], [n], len(key)
            if size >= FLUSH_PAIRS // 2:
                yield table(key, n)
                keys, counts, size = [], [], 0
    if size:
        yield table(*merged(keys, counts))


def link_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, n, best): in how many rows of ``aligned`` two ids are linked, and whether no other id has more with ``a``."""
    found = aligned.select("link_a", "link_b").mapInArrow(_count_pairs, "a int, b int, n long")
    counts = materialize(found.groupBy("a", "b").agg(F.sum("n").alias("n")), "link-counts")
    top = counts.groupBy("a").agg(F.max("n").alias("_top"))
    return counts.join(top, "a").select("a", "b", "n", (F.col("n") == F.col("_top")).alias("best"))


def head_pairs(counts: DataFrame, most: int = HEAD_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, counts and ``best`` of the pairs seen at least 2^k times, for the least k that leaves ``most`` pairs."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = counts.groupBy(level.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = 64, 0
    for k, n in sorted(((r["k"], r["n"]) for r in sizes), reverse=True):
        total += n
        if total > most:
            break
        least = k
    found = counts.where(level >= least).select("a", "b", "n", "best").toArrow().combine_chunks()  # at most ``most`` rows
    key = _keys(found["a"], found["b"])
    order = np.argsort(key)
    return key[order], found["n"].to_numpy()[order], found["best"].to_numpy(zero_copy_only=False)[order].astype(np.int64)


def _judge(held, keep: list[str]):
    """Task: the kept columns, a row number, the head pairs' sums, and the links of all other pairs."""
    def run(batches):
        head, head_n, head_best = held.value
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            a, b, n = (batch.column(name) for name in LINKS)
            bounds = a.offsets.to_numpy().astype(np.int64)
            bounds -= bounds[0]
            key, times = _keys(a.flatten(), b.flatten()), n.flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(head, key), max(0, len(head) - 1))
            known = head[at] == key if len(head) else np.zeros(len(key), bool)
            value = np.where(known, head_n[at], 0) * times if len(head) else np.zeros(len(key), np.int64)
            best = np.where(known, head_best[at], 0) * times if len(head) else value
            cut = np.r_[0, np.cumsum(~known)][bounds]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(row + np.arange(batch.num_rows)),
                 pa.array(_sums(best, bounds)), pa.array(_sums(value, bounds)),
                 *(_lists(x[~known], cut) for x in (key >> 32, key & 0xFFFFFFFF, times))],
                names=[*keep, "_link_row", "_best", "_sum", *LINKS])
            row += batch.num_rows
    return run


def judge(aligned: DataFrame, counts: DataFrame, head: int = HEAD_PAIRS) -> DataFrame:
    """``aligned`` (a written table) without its links plus ``n_best`` and ``count_sum``.

    ``n_best``: link occurrences whose pair is one of the most frequent of its id of
    A; ``count_sum``: the pairs' counts (from ``link_counts``) over all link occurrences.
    """
    aligned = without(aligned, "n_best", "count_sum", "_link_row", "_best", "_sum")
    counts = materialize(counts, "link-judged")
    held = aligned.sparkSession.sparkContext.broadcast(head_pairs(counts, head))
    keep = [c for c in aligned.columns if c not in LINKS]
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([*(aligned.schema[c] for c in keep), *(T.StructField(n, T.LongType()) for n in ("_link_row", "_best", "_sum")),
                           *(T.StructField(n, ints) for n in LINKS)])
    judged = materialize(aligned.mapInArrow(_judge(held, keep), schema), "links")
    rest = judged.select("_link_row", F.explode(F.arrays_zip(*LINKS)).alias("t")).select(
        "_link_row", F.col("t.link_a").alias("a"), F.col("t.link_b").alias("b"), F.col("t.link_n").alias("_n"))
    met = rest.join(counts, ["a", "b"]).groupBy("_link_row").agg(
        F.sum(F.when(F.col("best"), F.col("_n")).otherwise(0)).alias("_more_best"), F.sum(F.col("_n") * F.col("n")).alias("_more"))
    return judged.join(met, "_link_row", "left").select(
        *[judged[f"`{c}`"] for c in keep], (F.col("_best") + F.coalesce("_more_best", F.lit(0))).alias("n_best"),
        (F.col("_sum") + F.coalesce("_more", F.lit(0))).alias("count_sum"))
