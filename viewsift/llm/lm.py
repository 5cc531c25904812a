"""LM scoring with a log-frequency Bloom filter of n-gram counts.

A count c is quantised to level q = 1 + floor(log_base c), and the filter holds
the keys (n-gram, 1) .. (n-gram, q): probing levels upwards until one is missing
gives q, and with it the expected count. Levels share one bit array; an n-gram
that was never counted fails its first probe but for the filter's error rate.

1. Training documents' words are counted (combined per task, then by Spark).
2. Unigrams and bigrams are hashed, counted per task, and shuffled as packed
   fragments (segment, slice, keys, counts); one task after the other merges a
   slice's counts exactly and sets the bits of its filter segment.
3. The filter's bits grow with the training tokens (``BITS_PER_TOKEN``, no
   ceiling), so its error rate does not rise with the input. Up to
   ``MAX_FILTER_BITS``, the size of one part, it goes to every worker.
4. Every text is scored whole with Dirichlet-smoothed bigrams over add-one
   unigrams, all counts by repeated probes, a slice of texts at a time.

The add-one base score uses exact counts: the most frequent words (at most
``HEAD_WORDS``) are looked up by hash in each task, all others are joined with
the counted words by Spark.

A larger filter stays dealt out in parts of ``PART_SEGMENTS`` segments, and the
n-grams go to it (``scores_by_exchange``): each slice of texts sends every part its
distinct n-grams, once, with their training counts. The part's task merges the
counts, sets its bits, probes them, and answers with the levels (and, for words, the
exact counts of the base score). The slices then meet their answers as word numbers;
no text is shuffled. A part holds the same number of tokens at every size. Both
ways give the same filter, and so the same scores.

Defined cases: a null text is the empty text, of one token (its end); a row
without doc_id hashes like the empty text and is learned from; repeated rows
count each; without any training row every score uses empty counts; an empty
table gives an empty result; input columns beside doc_id and text are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewsift.llm import bloom
from viewsift.llm.common import hold_out, mix32, power_of_two, slices, text_bytes
from viewsift.session import materialize

FOLDS = 7
#: Log base of the quantised counts.
BASE = 1.5
LEVELS = 64
#: Bits a key sets per level.
PROBES = 3
BITS_PER_TOKEN = 8
#: Segments of a part of a filter that stays dealt out (2 MiB; at most 16, as a key names its segment by four bits).
PART_SEGMENTS = 16
#: The largest filter held by every worker: one part; n-grams are sent to a larger one.
MAX_FILTER_BITS = PART_SEGMENTS * bloom.SEGMENT_BITS
#: Bits of a hash that name an n-gram inside its segment.
SUB_BITS = 28
#: Words known to every task by hash: 16 MiB at most.
HEAD_WORDS = 1 << 20
#: Weight of the unigram distribution against a history's count.
DIRICHLET = 4.0
#: Words a task counts before it hands them on.
FLUSH_WORDS = 300_000
FLUSH_GRAMS = 1 << 21
#: Training tokens of a slice, whose n-grams one task counts at once.
SLICE_TOKENS = 1 << 18
#: No UTF-8 text holds this byte, so no word equals the end of a text.
END = b"\xff"


def tokens_of(texts: list[bytes]) -> list[bytes]:
    """Words of lower-cased texts, each text's followed by ``END``."""
    return (b" \xff ".join(texts).lower() + b" \xff").split() if texts else []


def vocabulary(tokens: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct tokens and the place of each token among them."""
    place = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
    return list(place), np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def bigram_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit key of two words' hashes, unlike that of either word."""
    with np.errstate(over="ignore"):
        h = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (right + np.uint64(0x632BE59BD9B4E019))
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def sub_keys(hashes: np.ndarray) -> np.ndarray:
    """The bits that name a hash inside its segment."""
    return (hashes & np.uint64((1 << SUB_BITS) - 1)).astype(np.uint32)


def level_of(counts: np.ndarray) -> np.ndarray:
    """Quantised counts (a count of 0 is level 0)."""
    return np.where(counts > 0, 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9), 0).astype(np.int64)


#: The count a level stands for: the middle of the counts that share it.
LEVEL_COUNT = np.array([0.0] + [(BASE ** (q - 1) + BASE ** q - 1) / 2 for q in range(1, LEVELS + 1)])


def _bit(sub: np.ndarray, level: int, probe: int) -> np.ndarray:
    return bloom.positions(mix32(sub + np.uint32(level)), probe)


def probe_levels(bits: np.ndarray, segment: np.ndarray, sub: np.ndarray) -> np.ndarray:
    """Level of each n-gram: that of the last probe that holds (0: never counted)."""
    level, left = np.zeros(len(sub), np.uint8), np.arange(len(sub))
    for q in range(1, LEVELS + 1):
        held = np.ones(len(left), bool)
        for probe in range(PROBES):
            held &= bloom.test(bits, segment, _bit(sub, q, probe))
        left, segment, sub = left[held], segment[held], sub[held]
        if not len(left):
            break
        level[left] = q
    return level


class CountFilter:
    """The built filter, read by probes."""

    def __init__(self, data: bytes, segments: int):
        self.bits, self.segments = bloom.as_array(data), segments

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """Expected count of each n-gram."""
        return LEVEL_COUNT[probe_levels(self.bits, bloom.segment_of(hashes, self.segments), sub_keys(hashes))]


def _count_words(batches):
    """Task: (word, n) of its texts, handed on whenever the table has grown large."""
    def table(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])
    counts: dict[bytes, int] = {}
    for batch in batches:
        texts = text_bytes(batch.column(0))
        for a, b in slices(texts):
            words, at = vocabulary(tokens_of(texts[a:b]))
            for w, n in zip(words, np.bincount(at).tolist()):
                counts[w] = counts.get(w, 0) + n
            if len(counts) >= FLUSH_WORDS:
                yield table(counts)
                counts = {}
    if counts:
        yield table(counts)


def _fragments(segments: int, parts: int):
    """Task: fragments (segment, slice, keys, counts) of the unigrams and bigrams of its texts."""
    def flush(keys: list[np.ndarray]):
        h, n = np.unique(np.concatenate(keys), return_counts=True)
        segment = bloom.segment_of(h, segments)
        part = ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
        order = np.lexsort((part, segment))
        segment, part, n, sub = segment[order], part[order], n[order].astype(np.uint32), sub_keys(h)[order]
        starts = np.flatnonzero(np.r_[True, (segment[1:] != segment[:-1]) | (part[1:] != part[:-1])])
        ends = np.r_[starts[1:], len(segment)]
        few = [np.minimum(n[a:b], 255).astype(np.uint8).tobytes() for a, b in zip(starts, ends)]
        # counts of 255 and more follow the one-byte counts in full
        many = [n[a:b][n[a:b] >= 255].tobytes() for a, b in zip(starts, ends)]
        return pa.RecordBatch.from_arrays(
            [pa.array(segment[starts], pa.int32()), pa.array(part[starts], pa.int32()),
             pa.array([sub[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
             pa.array(few, pa.binary()), pa.array(many, pa.binary())], names=["segment", "slice", "keys", "few", "many"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            texts = text_bytes(batch.column(0))
            for a, b in slices(texts):
                words, at = vocabulary(tokens_of(texts[a:b]))
                h = word_hashes(words)[at]
                last = np.flatnonzero(at == words.index(END))
                left = np.r_[np.uint64(0), h[:-1]]
                left[last[:-1] + 1] = 0  # a text's first word follows nothing
                held += [h, bigram_hashes(left, h)]
                size += 2 * len(h)
                if size >= FLUSH_GRAMS:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)
    return run


def _build_counts(batches):
    """Task: filter bits of each segment; its slices arrive one after the other."""
    bits, segment, part, keys, counts = None, None, None, [], []

    def close_slice():
        if not keys:
            return
        sub, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        level = level_of(np.bincount(inverse, weights=np.concatenate(counts)))
        for q in range(1, int(level.max()) + 1):
            sub, level = sub[level >= q], level[level >= q]
            for probe in range(PROBES):
                bits[_bit(sub, q, probe)] = True

    def built():
        return pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([bloom.pack(bits)], pa.binary())],
                                          names=["segment", "bits"])
    for batch in batches:
        for s, p, k, few, many in zip(*(c.to_pylist() for c in batch.columns)):
            if (s, p) != (segment, part):
                close_slice()
                if s != segment:
                    if segment is not None:
                        yield built()
                    bits = np.zeros(bloom.SEGMENT_BITS, bool)
                segment, part, keys, counts = s, p, [], []
            n = np.frombuffer(few, np.uint8).astype(np.int64)
            n[n == 255] = np.frombuffer(many, np.uint32)
            keys.append(np.frombuffer(k, np.uint32))
            counts.append(n)
    close_slice()
    if segment is not None:
        yield built()


def filter_segments(n_tokens: int) -> int:
    """Segments of the filter: a power of two, as large as the training tokens ask for."""
    bits = n_tokens * BITS_PER_TOKEN
    return bloom.n_segments(power_of_two(bits, bloom.SEGMENT_BITS, max(bloom.SEGMENT_BITS, 2 * bits)))


def built_segments(texts: DataFrame, n_tokens: int) -> DataFrame:
    """The filter over the n-grams of ``texts`` (text): (segment, bits) of the segments that hold any."""
    segments = filter_segments(n_tokens)
    parts = max(1, -(-n_tokens // (SLICE_TOKENS * segments)))
    found = texts.select("text").mapInArrow(_fragments(segments, parts),
                                            "segment int, slice int, keys binary, few binary, many binary")
    return (found.repartition("segment").sortWithinPartitions("segment", "slice")
            .mapInArrow(_build_counts, "segment int, bits binary"))


def count_filter(texts: DataFrame, n_tokens: int) -> tuple[bytes, int]:
    """The whole filter over the n-grams of ``texts`` (text), on the driver, and its number of segments."""
    segments = filter_segments(n_tokens)
    return bloom.collect_filter(built_segments(texts, n_tokens), segments), segments


def head_words(counts: DataFrame, most: int = HEAD_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the words seen at least 2^k times, for the least k that leaves ``most`` words."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, total = 64, 0
    for k, n in sorted(((r["k"], r["n"]) for r in sizes), reverse=True):
        total += n
        if total > most:
            break
        least = k

    def hashed(batches):
        for batch in batches:
            h = word_hashes(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(1)], names=["h", "n"])
    found = counts.where(F.floor(F.log2("n")) >= least).select("word", "n").mapInArrow(hashed, "h long, n long")
    table = found.toArrow()  # at most ``most`` rows of 16 bytes
    h = table["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], table["n"].to_numpy()[order]


class Slice:
    """The tokens of some whole texts: distinct words in the order of their hashes, and distinct pairs."""

    def __init__(self, texts: list[bytes]):
        words, at = vocabulary(tokens_of(texts))
        hashes = word_hashes(words)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        self.words, self.hashes, self.at = [words[i] for i in order], hashes[order], place[at]
        self.codes, self.left, self.last, self.pair_at = token_pairs(self.at, len(words), int(place[words.index(END)]))
        left = np.r_[self.hashes, np.uint64(0)][self.codes // (len(words) + 1)]  # nothing stands before a text's first word
        self.pairs = bigram_hashes(left, self.hashes[self.codes % (len(words) + 1)])


def token_pairs(at: np.ndarray, n_words: int, end: int) -> tuple[np.ndarray, ...]:
    """(distinct pairs as numbers, word before each token or ``n_words``, ends of the texts, pair of each token)."""
    last = np.flatnonzero(at == end)
    left = np.r_[n_words, at[:-1]]
    left[last[:-1] + 1] = n_words
    codes, pair_at = np.unique(left * (n_words + 1) + at, return_inverse=True)
    return codes, left, last, pair_at


def token_scores(seen: np.ndarray, pair: np.ndarray, at: np.ndarray, left: np.ndarray, end: int, floor: int) -> np.ndarray:
    """log10 of each token's smoothed probability from the counts of the words and of each token's pair."""
    unigram = np.minimum((seen + 1.0) / floor, 1.0)  # the filter's errors can't make p exceed 1
    # a text's start has been seen as often as its end
    history = np.maximum(np.r_[seen, seen[end]][left], pair)
    return np.log10((pair + DIRICHLET * unigram[at]) / (history + DIRICHLET))


SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, head_known long, head_base double, score double, "
          "tail array<binary>, tail_n array<long>")


def _scored(ids: list, out_flags: list, first: int, own: Slice, counts: CountFilter, head: np.ndarray, head_n: np.ndarray,
            floor: int) -> pa.RecordBatch:
    """Per text of a slice its row number, id, counts, model score, the head words' share of the base score, and its other words."""
    words, at, h, last = own.words, own.at, own.hashes, own.last
    # exact counts of head words
    place = np.minimum(np.searchsorted(head, h), max(0, len(head) - 1))
    known = head[place] == h if len(head) else np.zeros(len(h), bool)
    exact = np.where(known, head_n[place], 0) if len(head) else np.zeros(len(h), np.int64)
    base = np.where(known, np.log10(exact + 1.0), 0.0)
    score = token_scores(counts.count(h), counts.count(own.pairs)[own.pair_at], at, own.left, int(at[last[0]]), floor)
    begins = np.r_[0, last[:-1] + 1]
    doc = np.repeat(np.arange(len(last)), last - begins + 1)
    rest = np.flatnonzero(~known[at])
    tail, n = np.unique(doc[rest] * len(words) + at[rest], return_counts=True)
    cut = np.searchsorted(tail // len(words), np.arange(len(last) + 1))
    listed = pa.array([words[i] for i in tail % len(words)], pa.binary())
    return pa.RecordBatch.from_arrays([
        pa.array(first + np.arange(len(last)), pa.int64()), pa.array(ids, pa.int64()), pa.array(out_flags, pa.bool_()),
        pa.array(last - begins + 1, pa.int64()),
        pa.array(np.add.reduceat(known[at].astype(np.int64), begins)),
        pa.array(np.add.reduceat(base[at], begins)), pa.array(np.add.reduceat(score, begins)),
        pa.ListArray.from_arrays(pa.array(cut, pa.int32()), listed),
        pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(n, pa.int64()))],
        names=["row", "doc_id", "held_out", "n_tokens", "head_known", "head_base", "score", "tail", "tail_n"])


def _numbered_slices(batches):
    """(number of the first text, ids, flags, texts) of each slice of a task's rows."""
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        ids, texts, out_flags = batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()
        for a, b in slices(texts):
            yield row, ids[a:b], out_flags[a:b], texts[a:b]
            row += b - a


def _score(held, floor: int):
    """Task: scores its texts with the filter held by the worker."""
    def run(batches):
        data, segments, head, head_n = held.value
        counts = CountFilter(data, segments)
        for first, ids, out_flags, texts in _numbered_slices(batches):
            yield _scored(ids, out_flags, first, Slice(texts), counts, head, head_n, floor)
    return run


def _packed(counts: np.ndarray) -> bytes:
    """Counts in one byte each; those of 255 and more follow in full."""
    many = counts[counts >= 255].astype(np.uint64)
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + many.tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, np.uint64, offset=n).astype(np.int64)
    return counts


def _squeezed(values: np.ndarray, width: int) -> bytes:
    """Numbers of ``width`` bytes, byte planes one after the other, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _loosened(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    out[:, :width] = np.frombuffer(pa.Codec("zstd").decompress(data, width * n, asbytes=True), np.uint8).reshape(width, n).T
    return out.view("<u4").ravel().astype(np.int64)


def _parts(segment: np.ndarray, group: int) -> np.ndarray:
    return segment // group


QUESTIONS = "part int, slice long, words binary, words_n binary, pairs binary, pairs_n binary"
ANSWERS = "part int, slice long, words_n binary, word_levels binary, pair_levels binary, n_tokens long, n_words long"


def _ask(segments: int, group: int):
    """Task: per slice and part of the filter the distinct words and pairs that belong there, with their training counts."""
    def run(batches):
        for first, _, out_flags, texts in _numbered_slices(batches):
            own = Slice(texts)
            begins = np.r_[0, own.last[:-1] + 1]
            learned = np.repeat(~np.array(out_flags, bool), own.last - begins + 1)
            words_n = np.bincount(own.at[learned], minlength=len(own.words))
            pairs_n = np.bincount(own.pair_at[learned], minlength=len(own.codes))
            word_part = _parts(bloom.segment_of(own.hashes, segments), group)
            segment = bloom.segment_of(own.pairs, segments)
            key = ((segment % group).astype(np.uint32) << np.uint32(SUB_BITS)) | sub_keys(own.pairs)
            order = np.argsort(_parts(segment, group), kind="stable")
            pair_part, key, pairs_n = _parts(segment, group)[order], key[order], pairs_n[order]
            parts = np.unique(np.r_[word_part, pair_part])
            w, p = (np.searchsorted(x, np.r_[parts, parts[-1] + 1]) for x in (word_part, pair_part))
            rows = list(zip(w[:-1].tolist(), w[1:].tolist(), p[:-1].tolist(), p[1:].tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array([first] * len(parts), pa.int64()),
                 pa.array([own.hashes[a:b].tobytes() for a, b, _, _ in rows], pa.binary()),
                 pa.array([_packed(words_n[a:b]) for a, b, _, _ in rows], pa.binary()),
                 pa.array([key[a:b].tobytes() for _, _, a, b in rows], pa.binary()),
                 pa.array([_packed(pairs_n[a:b]) for _, _, a, b in rows], pa.binary())],
                names=["part", "slice", "words", "words_n", "pairs", "pairs_n"])
    return run


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, their counts, place of each key among them)."""
    own, place = np.unique(np.concatenate(keys), return_inverse=True)
    return own, np.bincount(place, np.concatenate(counts), len(own)).astype(np.int64), place


def _answer_part(part: int, slices_: list[int], words: list, words_n: list, pairs: list, pairs_n: list,
                 segments: int, group: int) -> pa.RecordBatch:
    """Builds one part of the filter from all its n-grams and probes it for them."""
    word, word_n, word_at = _merged(words, words_n)
    key, key_n, key_at = _merged(pairs, pairs_n)
    segment = np.r_[bloom.segment_of(word, segments) % group, (key >> np.uint32(SUB_BITS)).astype(np.int64)].astype(np.int32)
    sub = np.r_[sub_keys(word), key & np.uint32((1 << SUB_BITS) - 1)]
    bits = np.zeros(group * bloom.SEGMENT_BITS, bool)
    level, at = level_of(np.r_[word_n, key_n]), np.arange(len(sub))
    for q in range(1, int(level.max(initial=0)) + 1):
        at = at[level[at] >= q]
        for probe in range(PROBES):
            bits[segment[at].astype(np.int64) * bloom.SEGMENT_BITS + _bit(sub[at], q, probe)] = True
    found = probe_levels(bloom.as_array(bloom.pack(bits)), segment, sub)
    w, p = (np.r_[0, np.cumsum(list(map(len, x)))] for x in (words, pairs))
    word_n_at, word_level, pair_level = word_n[word_at], found[:len(word)][word_at], found[len(word):][key_at]
    some = len(slices_) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array([part] * len(slices_), pa.int32()), pa.array(slices_, pa.int64()),
         pa.array([_packed(word_n_at[a:b]) for a, b in zip(w[:-1], w[1:])], pa.binary()),
         pa.array([word_level[a:b].tobytes() for a, b in zip(w[:-1], w[1:])], pa.binary()),
         pa.array([pair_level[a:b].tobytes() for a, b in zip(p[:-1], p[1:])], pa.binary()),
         pa.array([int(word_n.sum())] + [0] * some, pa.int64()), pa.array([int((word_n > 0).sum())] + [0] * some, pa.int64())],
        names=["part", "slice", "words_n", "word_levels", "pair_levels", "n_tokens", "n_words"])


def _answer(segments: int, group: int):
    """Task: the answers of its parts, whose questions arrive one part after the other (a bounded number of tokens each)."""
    def run(batches):
        part, held = None, ([], [], [], [], [])
        for batch in batches:
            for p, number, words, words_n, pairs, pairs_n in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part:
                    if part is not None:
                        yield _answer_part(part, *held, segments, group)
                    part, held = p, ([], [], [], [], [])
                w, k = np.frombuffer(words, np.uint64), np.frombuffer(pairs, np.uint32)
                for x, own in zip(held, (number, w, _unpacked(words_n, len(w)), k, _unpacked(pairs_n, len(k)))):
                    x.append(own)
        if part is not None:
            yield _answer_part(part, *held, segments, group)
    return run


SLICES = "slice long, ids array<long>, flags array<boolean>, shape array<long>, tokens binary, pair_parts binary"


def _number(segments: int, group: int):
    """Task: its slices as word numbers (in the order of the words' hashes) and the part of the filter that each pair belongs to."""
    def run(batches):
        for first, ids, out_flags, texts in _numbered_slices(batches):
            own = Slice(texts)
            parts = _parts(bloom.segment_of(own.pairs, segments), group)
            shape = [len(own.at), len(own.words), len(own.codes), int(own.at[own.last[0]])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([out_flags], pa.list_(pa.bool_())),
                 pa.array([shape], pa.list_(pa.int64())), pa.array([_squeezed(own.at, 4)], pa.binary()),
                 pa.array([_squeezed(parts, 4)], pa.binary())],
                names=["slice", "ids", "flags", "shape", "tokens", "pair_parts"])
    return run


FINAL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score_answered(n_tokens: int, n_words: int):
    """Task: scores of its slices, each followed by the answers of the filter's parts in their order."""
    floor = n_tokens + n_words + 1

    def close(ids, out_flags, shape, tokens, pair_parts, answers) -> pa.RecordBatch:
        size, words, pairs, end = shape
        at = _loosened(tokens, size, 4)
        codes, left, last, pair_at = token_pairs(at, words, end)
        levels = np.frombuffer(b"".join(a[1] for a in answers), np.uint8)
        found = np.frombuffer(b"".join(a[2] for a in answers), np.uint8)
        if len(codes) != pairs or len(levels) != words or len(found) != pairs:
            raise RuntimeError("the rows of a partition changed between two reads: write the table first")
        exact = np.concatenate([_unpacked(a[0], len(a[1])) for a in answers])
        pair = np.empty(pairs, np.uint8)
        pair[np.argsort(_loosened(pair_parts, pairs, 4), kind="stable")] = found
        score = token_scores(LEVEL_COUNT[levels], LEVEL_COUNT[pair][pair_at], at, left, end, floor)
        begins = np.r_[0, last[:-1] + 1]
        n = last - begins + 1
        base = np.add.reduceat(np.log10(exact + 1.0)[at], begins) + 0.0 - n * float(np.log10(floor))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(out_flags, pa.bool_()), pa.array(n, pa.int64()),
             pa.array(np.add.reduceat((exact > 0)[at].astype(np.int64), begins)), pa.array([n_tokens] * len(n), pa.int64()),
             pa.array(base), pa.array(np.add.reduceat(score, begins))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def run(batches):
        asked, answers = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                part, ids, out_flags, shape, tokens, pair_parts, *own = (c[i].as_py() for c in batch.columns[1:])
                if part < 0:
                    if asked is not None:
                        yield close(*asked, answers)
                    asked, answers = (ids, out_flags, shape, tokens, pair_parts), []
                else:
                    answers.append(own)
        if asked is not None:
            yield close(*asked, answers)
    return run


def scores_by_exchange(docs: DataFrame, segments: int, group: int = PART_SEGMENTS) -> DataFrame:
    """The scores of ``docs`` (doc_id, text, held_out) with a filter of any size; ``docs`` is read twice and must read alike."""
    group = min(group, segments)
    parts = segments // group  # partitions grow with the tokens, too
    asked = docs.mapInArrow(_ask(segments, group), QUESTIONS)
    answers = materialize(asked.repartition(parts, "part").sortWithinPartitions("part", "slice")
                          .mapInArrow(_answer(segments, group), ANSWERS), "lm-answers")
    n_tokens, n_words = answers.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    numbered = docs.mapInArrow(_number(segments, group), SLICES).withColumn("part", F.lit(-1))
    both = numbered.unionByName(answers.drop("n_tokens", "n_words"), allowMissingColumns=True)
    both = both.select("slice", "part", "ids", "flags", "shape", "tokens", "pair_parts", "words_n", "word_levels", "pair_levels")
    return both.repartition(parts, "slice").sortWithinPartitions("slice", "part").mapInArrow(_score_answered(n_tokens, n_words), FINAL)


def _count_tokens(batches):
    """Task: the number of tokens of its texts."""
    n = 0
    for batch in batches:
        texts = text_bytes(batch.column(0))
        for a, b in slices(texts):
            n += len(tokens_of(texts[a:b]))
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])


def score_texts(docs: DataFrame, folds: int = FOLDS, max_filter_bits: int = MAX_FILTER_BITS,
                head: int = HEAD_WORDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    ``docs`` is read several times: a plain table, or one that was written.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", hold_out(F.col("doc_id"), folds).alias("held_out"))
    learned = docs.where(~F.col("held_out")).select("text")
    total = learned.mapInArrow(_count_tokens, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    segments = filter_segments(total)
    # What is broadcast is bounded by parameters: the frequent words, and the filter only up to ``max_filter_bits``.
    if segments * bloom.SEGMENT_BITS > max(max_filter_bits, bloom.SEGMENT_BITS):
        return scores_by_exchange(docs, segments)
    counts = materialize(learned.mapInArrow(_count_words, "word binary, n long").groupBy("word")
                         .agg(F.sum("n").alias("n")), "word-counts")
    vocab, frequent = counts.count(), head_words(counts, head)
    held = spark.sparkContext.broadcast((count_filter(learned, total)[0], segments, *frequent))
    scored = materialize(docs.mapInArrow(_score(held, total + vocab + 1), SCORED), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("t")) \
        .select("row", F.col("t.tail").alias("word"), F.col("t.tail_n").alias("tf"))
    met = tail.join(counts, "word").groupBy("row").agg(
        F.sum("tf").alias("_known"), F.sum(F.col("tf") * F.log10(F.col("n") + 1.0)).alias("_base"))
    floor = float(np.log10(total + vocab + 1))
    return scored.join(met, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("_base", F.lit(0.0)) - F.col("n_tokens") * floor).alias("base_score"), "score")
