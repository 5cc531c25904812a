"""BPE ids against the tokenizer library; decoding against Python's own decoder."""

import hashlib
import os
import random
import sys
from array import array

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from viewsift.llm import bpe, registry  # noqa: E402

with open(public_tokenizers.path(bpe.RANK_FILE), "rb") as f:
    RANKS = f.read()
CODEC = bpe.BpeCodec(RANKS)
REF = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.machine.ranks, special_tokens={})


def ids(codec, text):
    return list(memoryview(codec.encode(text)).cast("I"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"])))
def test_any_text(text):
    assert ids(CODEC, text) == REF.encode_ordinary(text)
    assert CODEC.decode(ids(CODEC, text)) == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(sorted(CODEC.machine.ranks)), max_size=12))
def test_joined_tokens(parts):
    """Byte strings that invite other merges than the ones they were made of."""
    text = b"".join(parts).decode("utf-8", "replace")
    assert ids(CODEC, text) == REF.encode_ordinary(text)


def test_full_tables_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_WORDS", 20)
    monkeypatch.setattr(bpe, "MAX_PIECES", 20)
    codec, rnd = bpe.BpeCodec(RANKS), random.Random(2)
    for _ in range(400):
        text = "".join(rnd.choice("aeinrst dé\n.") for _ in range(rnd.randint(0, 80)))
        assert ids(codec, text) == REF.encode_ordinary(text)
        assert len(codec.machine._keys) <= 50


@pytest.mark.parametrize("text", ["", " ", "a\n\nb", " \n a", "a \nb", "a  b", "x y\x1c z w", "don't 'll", "\n", "a\n", "é" * 5000,
                                  "z" * 20_000, " " * 3000 + "end", "word" * 3000 + " end", "🙂👍🏽 日本語 ไทย", "1234567890" * 200])
def test_spaces_and_long_pieces(text):
    assert ids(CODEC, text) == REF.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=30), st.lists(st.integers(0, 30), max_size=5))
def test_streaming_decoder_equals_whole_decoding(data, cuts):
    held, out, at = b"", "", 0
    for cut in sorted(cuts) + [len(data)]:
        text, held = bpe.utf8_step(held, data[at:max(at, min(cut, len(data)))])
        out, at = out + text, max(at, min(cut, len(data)))
    assert out + "�" * bool(held) == data.decode("utf-8", "replace")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_operator_on_hand_made_rows(spark):
    data = cases.rows()
    docs = cases.frame(spark, data).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(0))
    out = bpe.bpe_round_trip(docs)
    two = bpe.bpe_decode(bpe.bpe_encode(docs))
    assert sorted(map(str, two.select(out.columns).collect())) == sorted(map(str, out.collect()))
    assert set(out.columns) == {*docs.columns, "n_tokens"}
    got = sorted(((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in out.collect()), key=str)
    want = []
    for r in data:
        own = REF.encode_ordinary(r[1] or "")
        want.append((r[0], len(own), array("I", own).tobytes(), r[1] or ""))
    assert got == sorted(want, key=str)
    assert bpe.bpe_encode(cases.frame(spark, [])).count() == 0


def test_query_equals_the_library_on_a_given_table(spark):
    sf = "/root/testdata/sf0.01"
    got = {tuple(r) for r in registry.QUERIES["op4_bpe"](spark, sf).collect()}
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        own = REF.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(own), sha(array("I", own).tobytes()), sha((r.text or "").encode())))
    assert got == want


def test_bytes_that_are_no_utf8(spark):
    data = [(1, bytearray(b"good \xff\xfe bad")), (2, bytearray(b"\xe2\x82")), (3, None)]
    docs = spark.createDataFrame(data, "doc_id long, b binary").selectExpr("doc_id", "cast(b as string) as text")
    want = {d: ("" if b is None else bytes(b).decode("utf-8", "replace")) for d, b in data}
    for r in bpe.bpe_round_trip(docs).collect():
        assert r.decoded == want[r.doc_id] and list(memoryview(bytes(r.ids)).cast("I")) == REF.encode_ordinary(want[r.doc_id])
    got = {r.doc_id: r.decoded for r in bpe.bpe_decode(bpe.bpe_encode(docs)).collect()}
    assert got == want


def test_known_whole_tokens_are_decoded_without_steps():
    codec = bpe.BpeCodec(RANKS)
    plain, split = ("some plain words, and more\n" * 3), "an ö, 数据 🙂🙂 \U0001F9FF end"
    for _ in range(2):
        for text in (plain, split):
            assert codec.decode(memoryview(codec.encode(text)).cast("I")) == text
    cut = memoryview(codec.encode("a🙂"))[:-4].cast("I")  # ends inside a sequence
    assert codec.decode(cut) == b"".join(codec.machine.tokens[i] for i in cut).decode("utf-8", "replace")
    codec.steps = None
    assert codec.decode(memoryview(codec.encode(plain)).cast("I")) == plain
