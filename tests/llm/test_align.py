"""Tokenizer alignment: against both libraries over whole texts, byte by byte."""

import hashlib
import os
import random
import sys
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import cases  # noqa: E402

from viewsift.llm import align, registry  # noqa: E402

A = Tokenizer.from_file(public_tokenizers.path(align.A_FILE))
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=public_tokenizers.path(align.B_FILE))
with open(public_tokenizers.path(align.A_FILE), "rb") as f, open(public_tokenizers.path(align.B_FILE), "rb") as g:
    PAIR = align.TokenizerPair(f.read(), g.read())
A_TEXT = {i: t for t, i in A.get_vocab().items()}
BYTE = align.byte_of_symbol()


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def brute(data):
    """(ids of A, ids of B, groups, link counter) of one text, from whole encodings."""
    none = [], [], "", Counter()
    try:
        text = (data or b"").decode()
    except UnicodeDecodeError:
        return none
    if not text:
        return none
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_parts, b_parts = [bytes(BYTE[c] for c in A_TEXT[i]) for i in a], [b_bytes(i) for i in b]
    if b"".join(a_parts) != b" " + data or b"".join(b_parts) != b" " + data:
        return none

    def ends(parts):
        out, at = [], 0
        for p in parts:
            at += len(p)
            out.append(at)
        return out
    a_ends, b_ends = ends(a_parts), ends(b_parts)
    groups, i, j = [], 0, 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        k, m = a_ends.index(cut, i) + 1, b_ends.index(cut, j) + 1
        groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        i, j = k, m
    links, j = Counter(), 0
    for x, (start, end) in enumerate(zip([0] + a_ends, a_ends)):
        while b_ends[j] <= start:
            j += 1
        for y in range(j, len(b)):
            if (b_ends[y - 1] if y else 0) >= end:
                break
            links[a[x], b[y]] += 1
    return a, b, ";".join(groups), links


def expected(texts):
    """The contract's columns per text."""
    found = [brute(t) for t in texts]
    held = Counter(p for *_, links in found for p in links)
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return [(len(a), len(b), groups.count(";") + bool(groups), sum(links.values()),
             sum(n for p, n in links.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in links.items()),
             hashlib.sha256(groups.encode()).hexdigest() if a else "") for a, b, groups, links in found]


def check(texts):
    data = [t.encode() if isinstance(t, str) else t for t in texts]
    columns = [c.to_pylist() for c in align.align_texts(PAIR, data)]
    for i, t in enumerate(data):
        a, b, groups, links = brute(t)
        got = [c[i] for c in columns]
        assert got[:5] == [len(a), len(b), groups.count(";") + bool(groups), sum(links.values()), groups], t
        assert dict(zip(zip(got[5], got[6]), got[7])) == links, t


TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b\n\n c", "foo bar\nbaz", "x \ny", "x\n y", "naïve 狐🦊 x", "狐狸狐狸🦊🦊", "▁", "x▁ y", "▁x y",
         "a  b", "a  b", "<s> </s> <unk> <|endoftext|> <0x41>", "tab\tsep\x0b\x0c\r\n", "ﬁ ﬂ", "é é", "\x00 \x1c \x1c", "don't 'll we've",
         "1234567890 " * 3, "z" * 3000, " " * 50 + "end", "word" * 500 + " end", "ไทย 日本語 العربية", "﻿bom", "👨‍👩‍👧‍👦 x", "a b 　 c"]


def test_hand_made_texts():
    check(TEXTS)
    check([b"\xff x", b"ok", b"", b"a \xc3"])
    assert align.align_texts(PAIR, [])[0].to_pylist() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n▁aé狐"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=4))
def test_any_texts(texts):
    check(texts)


def test_small_calls_and_whole_texts_change_nothing(monkeypatch):
    rnd = random.Random(3)
    texts = TEXTS + [" ".join(rnd.choice(TEXTS) for _ in range(6)) for _ in range(30)]
    want = [c.to_pylist() for c in align.align_texts(PAIR, [t.encode() for t in texts])]
    monkeypatch.setattr(align, "CALL_BYTES", 10)
    assert [c.to_pylist() for c in align.align_texts(PAIR, [t.encode() for t in texts])] == want
    monkeypatch.setattr(PAIR, "by_words", False)
    assert [c.to_pylist() for c in align.align_texts(PAIR, [t.encode() for t in texts])] == want


def test_coarse_cuts_agree_with_the_decoded_bytes():
    """Spans alone decide where they can; only parts of characters are refined."""
    for text in TEXTS:
        found = PAIR._cuts(" " + text, (" " + text).encode()) if text else None
        if found:
            for ids, ends, side in ((found[0], found[1], PAIR.a), (found[2], found[3], PAIR.b)):
                assert ends.tolist() == side.size[ids].cumsum().tolist()
    found = A.encode(" naïve text", add_special_tokens=False)
    span = found.offsets
    assert span[-1] == (6, 11) and align.refine(*(__import__("numpy").array(x) for x in ([6], [11], [5]))).tolist() == [11]


def columns(df):
    return df.select("doc_id", *align.COUNTS, "n_best", "count_sum", "groups_sha256")


def test_query_on_a_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").cast("binary")).collect()
    want = {d: e for (d, _), e in zip(docs, expected([t and bytes(t) for _, t in docs]))}
    got = {r[0]: tuple(r[1:]) for r in columns(registry.QUERIES["op12_tokenizer_alignment"](spark, sf)).collect()}
    assert got == want


@pytest.mark.parametrize("head", [1 << 20, 500, 0])
def test_hand_made_rows_and_joined_pairs(spark, head):
    """Few or no pairs known to the tasks: the others come by the join."""
    data = [r for r in cases.rows() if r[0] != 133] + [(300 + i, t, "en", "s", 1) for i, t in enumerate(TEXTS)] + [(300, TEXTS[5], "en", "s", 1)]
    docs = cases.frame(spark, data).withColumn("N_A", F.lit("clash")).withColumn("link_n", F.lit(1)).withColumn("a", F.lit(1))
    out = align.align(docs).cache()
    got = align.judge(out, align.link_counts(out), head=head)
    assert "source" in got.columns and "link_n" not in got.columns
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    got = got.select(F.col("text").cast("binary").alias("t"), *align.COUNTS, "n_best", "count_sum", digest).collect()
    texts = [r[1] and r[1].encode() for r in data]
    assert sorted((bytes(r.t or b""), *r[1:]) for r in got) == sorted((t or b"", *e) for t, e in zip(texts, expected(texts)))
    out.unpersist()


def test_empty_table(spark):
    out = align.align(cases.frame(spark, []))
    assert align.judge(out, align.link_counts(out)).count() == 0
