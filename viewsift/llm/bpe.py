"""Byte-level BPE as a lazily determinised transducer, and a streaming decoder.

Encoding reads a piece byte by byte. A sequence of tokens is what the merges give
exactly when every token alone and every two neighbours together encode to
themselves; so each position of the input has one last token, and a state needs
only the *live* positions: those from which some longer token could still start.
A state is the bytes after the first live position and, for each live position,
its last token and the tokens not emitted yet. What all live positions share is
emitted at once, so the lookahead is bounded by the longest token. States and
transitions are built when first met and kept in a table of bounded size; beyond
it they are computed each time.

Decoding runs a UTF-8 state machine over token ids; its state is the unfinished
sequence (at most three bytes), and its steps per token are kept as well. Bytes
that cannot be UTF-8 become U+FFFD.

Defined cases: a null text encodes like the empty text, to no ids; bytes of a text
that are no UTF-8 are encoded as U+FFFD; repeated rows are encoded each; an empty table gives an empty result; whole texts are encoded
however long; input columns named like an output column are dropped.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewsift.llm.common import spans, text_bytes, without

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: States a worker keeps (the first met, so the common ones); further ones are computed when met.
MAX_STATES = 120_000
#: Pairs of tokens of which a worker keeps whether they stay apart, before it forgets them all.
MAX_FITS = 400_000
#: Words and pieces a worker keeps before it forgets them all and starts anew.
MAX_WORDS = 150_000
MAX_PIECES = 50_000
#: Slots that remember which words came before: a word's ids are kept from its second text on.
SEEN_SLOTS = 1 << 22
#: Longest piece (in characters) whose ids are kept.
KEPT_PIECE = 40
_NEVER = 1 << 40
_BYTES = [bytes((b,)) for b in range(256)]
_UNKNOWN = object()


class BpeTransducer:
    """Merges compiled on demand; ``encode_piece`` is one run of the machine."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.prefixes = {t[:n] for t in ranks for n in range(len(t))}
        self._edges: dict[bytes, tuple | None] = {}
        self._fits: dict[int, bool] = {}  # by left << 32 | right
        # A state is a table: its key under -1, and by byte the next state and the ids emitted.
        self._start: dict = {-1: (b"", ((0, -1, ()),))}
        self._keys: dict[tuple, dict] = {self._start[-1]: self._start}
        self._n_steps = 0

    def merge(self, piece: bytes) -> list[bytes]:
        """The parts of a short string after the merges in order of rank; two parts before the last merge."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 2:
            ranked = [(self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == _NEVER:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _is_whole(self, token: bytes) -> bool:
        """Whether a token encodes to itself; its edges are compiled with it."""
        known = self._edges.get(token, _UNKNOWN)
        if known is _UNKNOWN:
            known = self._edges[token] = self._edges_of(token) if token in self.ranks else None
        return known is not None

    def _edges_of(self, token: bytes) -> tuple[tuple, tuple] | None:
        """What stands at the token's left and right edge as its merges go on: (parts, ranks that made them)."""
        if len(token) == 1:
            return ((token,), (-1,)), ((token,), (-1,))
        halves = self.merge(token)
        if len(halves) != 2 or not self._is_whole(halves[0]) or not self._is_whole(halves[1]):
            return None
        (left, left_at), (right, right_at) = self._edges[halves[0]][0], self._edges[halves[1]][1]
        rank = self.ranks[token]
        return ((*left, token), (*left_at, rank)), ((*right, token), (*right_at, rank))

    def _fit(self, left: int, right: int) -> bool:
        """Whether two whole tokens stay apart: no merge across their border comes in its turn."""
        pair = left << 32 | right
        known = self._fits.get(pair)
        if known is None:
            if len(self._fits) >= MAX_FITS:
                self._fits.clear()
            known = self._fits[pair] = self._apart(self._edges[self.tokens[left]][1],
                                                   self._edges[self.tokens[right]][0])
        return known

    def _apart(self, left: tuple, right: tuple) -> bool:
        (parts, made), (next_parts, next_made) = left, right
        i = j = 0
        while True:
            grow_left = made[i + 1] if i + 1 < len(parts) else _NEVER
            grow_right = next_made[j + 1] if j + 1 < len(next_parts) else _NEVER
            across = self.ranks.get(parts[i] + next_parts[j], _NEVER)
            if across < grow_left and across <= grow_right:  # equal ranks: the leftmost goes first
                return False
            if grow_left == grow_right == _NEVER:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def _advance(self, key: tuple, byte: int) -> tuple[tuple, tuple[int, ...]]:
        """A state's key and a byte → the next state's key and the ids emitted."""
        tail, live = key
        tail += _BYTES[byte]
        new, kept, prefixes = None, [], self.prefixes
        for entry in live:
            token = tail[entry[0]:]
            if new is None:
                rank = self.ranks.get(token)
                if rank is not None and self._is_whole(token) and (entry[1] < 0 or self._fit(entry[1], rank)):
                    new = (len(tail), rank, (*entry[2], rank))
            if token in prefixes:
                kept.append(entry)
        if not kept:  # only the end is live
            return (b"", ((0, new[1], ()),)), new[2]
        kept.append(new)
        first, done = kept[0][2], 0
        while done < len(first) and all(len(e[2]) > done and e[2][done] == first[done] for e in kept):
            done += 1
        cut = kept[0][0]
        if cut or done:
            kept = [(at - cut, last, held[done:]) for at, last, held in kept]
        return (tail[cut:], tuple(kept)), first[:done]

    def _miss(self, state: dict, byte: int) -> tuple[dict, tuple[int, ...]]:
        """A step that no table holds; it is noted unless a table is full, and then the state may be one for this time only."""
        key, emitted = self._advance(state[-1], byte)
        found = self._keys.get(key)
        if found is None:
            found = {-1: key}
            if len(self._keys) >= MAX_STATES:
                return found, emitted
            self._keys[key] = found
        if self._n_steps < 3 * MAX_STATES and self._keys.get(state[-1]) is state:
            self._n_steps += 1
            state[byte] = found, emitted
        return found, emitted

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one piece; a piece that is a token itself is that token."""
        rank = self.ranks.get(piece)
        if rank is not None:
            return [rank]
        out: list[int] = []
        state = self._start
        for byte in piece:
            state, emitted = state.get(byte) or self._miss(state, byte)
            if emitted:
                out += emitted
        out += state[-1][1][-1][2]  # the last live position is the end
        return out


def _plain(word: str) -> bool:
    """Whether no white space stands at a word's ends but one line feed before it."""
    bare = word.strip()
    return bool(bare) and (bare == word or (word[0] == "\n" and bare == word[1:]))


class BpeCodec:
    """Whole texts to ids and back."""

    def __init__(self, rank_file: bytes, pattern: str = public_tokenizers.PATTERN):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.machine = BpeTransducer(ranks)
        self.split = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.seen = bytearray(SEEN_SLOTS)
        self.steps: dict[bytes, dict[int, tuple[str, bytes]]] = {}
        self.whole: dict[int, str] = {}  # tokens that are UTF-8 by themselves, as met

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A space or line feed between two characters that are no white space always
        opens a match of the pattern, so what lies between such places is encoded
        (and kept) word by word; a text with other white space is split whole.
        """
        words = text.replace("\n", " \n").split(" ")
        first, words, known = words[0], words[1:], self.words
        new = set(words).difference(known)
        if (first and first[-1].isspace()) or not all(map(_plain, new)):
            return self._encode_split(text)
        if len(known) >= MAX_WORDS:
            known.clear()
            new = set(words)
        once = []
        for w in new:
            known[w] = self._encode_word(w)
            slot = hash(w) & (SEEN_SLOTS - 1)
            if not self.seen[slot] or len(w) > KEPT_PIECE:
                self.seen[slot] = 1
                once.append(w)
        out = self._encode_split(first) + b"".join(map(known.__getitem__, words))
        for w in once:
            del known[w]
        return out

    def _encode_word(self, word: str) -> bytes:
        """Ids of a word with the space before it, or with the line feed it starts with."""
        if word.isalpha():  # the space and the letters are one match
            return array("I", self.machine.encode_piece(b" " + word.encode())).tobytes()
        if word[-1] in ".," and word[:-1].isalpha():
            run = self.machine.encode_piece
            return array("I", run(b" " + word[:-1].encode()) + run(word[-1:].encode())).tobytes()
        return self._encode_split(word if word[0] == "\n" else " " + word)

    def _encode_split(self, text: str) -> bytes:
        pieces, known = self.split(text), self.pieces
        if len(known) >= MAX_PIECES:
            known.clear()
        new = set(pieces).difference(known)
        known.update((p, array("I", self.machine.encode_piece(p.encode())).tobytes()) for p in new)
        out = b"".join(map(known.__getitem__, pieces))
        for p in new:
            if len(p) > KEPT_PIECE:
                del known[p]
        return out

    def _step(self, held: bytes, token: int) -> tuple[str, bytes]:
        step = utf8_step(held, self.machine.tokens[token])
        self.steps.setdefault(held, {})[token] = step
        if not held and not step[1]:
            self.whole[token] = step[0]
        return step

    def decode(self, ids) -> str:
        out = list(map(self.whole.get, ids))
        if None not in out:  # no sequence is left unfinished: the steps are one table's
            return "".join(out)
        first = out.index(None)
        del out[first:]
        held, steps = b"", self.steps
        table = steps.setdefault(b"", {})
        for token in ids[first:]:
            step = table.get(token) or self._step(held, token)
            out.append(step[0])
            if step[1] != held:
                held = step[1]
                table = steps.setdefault(held, {})
        return "".join(out) + "�" * bool(held)


def _sequence(lead: int) -> tuple[int, int, int]:
    """Length of the sequence a lead byte opens, and the range of its second byte; length 0: no lead byte."""
    if lead < 0x80:
        return 1, 0, 0
    if 0xC2 <= lead < 0xE0:
        return 2, 0x80, 0xBF
    if 0xE0 <= lead < 0xF0:
        return 3, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF
    if 0xF0 <= lead < 0xF5:
        return 4, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF
    return 0, 0, 0


def utf8_step(held: bytes, data: bytes) -> tuple[str, bytes]:
    """Text completed by ``data`` after the unfinished sequence ``held``, and what is unfinished then."""
    out: list[str] = []
    for byte in data:
        if held:
            size, low, high = _sequence(held[0])
            if len(held) > 1:
                low, high = 0x80, 0xBF
            if low <= byte <= high:
                held += bytes((byte,))
                if len(held) == size:
                    out.append(held.decode())
                    held = b""
                continue
            out.append("�")
            held = b""
        size = _sequence(byte)[0]
        if size == 1:
            out.append(chr(byte))
        elif size:
            held = bytes((byte,))
        else:
            out.append("�")
    return "".join(out), held


_CODECS: dict[str, BpeCodec] = {}


def _codec(rank_file: bytes) -> BpeCodec:
    """The worker's codec of a vocabulary: its tables stay between tasks."""
    name = hashlib.md5(rank_file).hexdigest()
    if name not in _CODECS:
        _CODECS[name] = BpeCodec(rank_file)
    return _CODECS[name]


def rank_broadcast(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The rank file (under a megabyte), read by the driver, for all workers."""
    with open(path or public_tokenizers.path(RANK_FILE), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _strings(texts: pa.Array) -> list[str]:
    """The texts; null is empty, bytes that are no UTF-8 are U+FFFD."""
    return [b.decode("utf-8", "replace") for b in text_bytes(texts)]


def encode(text: Column, held: Broadcast) -> Column:
    """``text`` → its ids as little-endian unsigned 32-bit integers (binary)."""
    @F.arrow_udf(T.BinaryType())
    def run(texts: pa.Array) -> pa.Array:
        codec = _codec(held.value)
        return pa.array((codec.encode(t) for t in _strings(texts)), pa.binary())
    return run(text)


def decode(ids: Column, held: Broadcast) -> Column:
    """Ids as ``encode`` gives them → text."""
    @F.arrow_udf(T.StringType())
    def run(blobs: pa.Array) -> pa.Array:
        codec = _codec(held.value)
        return pa.array((codec.decode(memoryview(b.as_py() or b"").cast("I")) for b in blobs), pa.string())
    return run(ids)


def bpe_encode(docs: DataFrame, rank_path: str | None = None) -> DataFrame:
    """``docs`` (text, more columns) plus ``ids`` (binary) and ``n_tokens``."""
    docs = without(docs, "ids", "n_tokens")
    ids = encode(F.col("text"), rank_broadcast(docs.sparkSession, rank_path))
    return docs.withColumn("ids", ids).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def bpe_decode(encoded: DataFrame, rank_path: str | None = None) -> DataFrame:
    """``encoded`` (ids, more columns) plus ``decoded`` (text; null ids decode to the empty text)."""
    encoded = without(encoded, "decoded")
    return encoded.withColumn("decoded", decode(F.col("ids"), rank_broadcast(encoded.sparkSession, rank_path)))


def bpe_round_trip(docs: DataFrame, rank_path: str | None = None) -> DataFrame:
    """``docs`` (text, more columns) plus ``ids``, ``n_tokens`` and the text ``decoded`` from the ids.

    One worker encodes and decodes a slice of texts after the other, so what it
    holds beside its tables is bounded by the slice (or the longest text).
    """
    docs = without(docs, "ids", "n_tokens", "decoded")
    held = rank_broadcast(docs.sparkSession, rank_path)
    more = [("ids", T.BinaryType()), ("n_tokens", T.LongType()), ("decoded", T.StringType())]
    names = [*docs.columns, *(name for name, _ in more)]
    at = names.index("text")

    def run(batches):
        codec = _codec(held.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
            for a, b in spans(sizes):
                part = batch.slice(a, b - a)
                ids = [codec.encode(t) for t in _strings(part.column(at))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array([codec.decode(memoryview(i).cast("I")) for i in ids], pa.string())],
                    names=names)
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *(T.StructField(n, t) for n, t in more)]))
