"""Quality rules: every rule is evaluated once into a ledger of failure bits; policies are masks over it.

``rule_ledger`` measures each document once: the measurements and one bit per
failed rule. ``stored_ledger`` writes them without the texts, and policies are judged
from that table. A policy (a version and the rules it applies) is a bit mask:
``apply_policy`` judges by ``failed & mask``, and ``ablations`` counts, for every
policy and rule, the documents that only this rule rejects, from the (at most
2^rules) distinct bit patterns, combined map-side.

Long words are judged without the characters of scripts that put no spaces between
words, so a clean text in such a script has none.

Defined cases: a null or empty text has no words, so it fails ``few_words``;
repeated rows are judged each; an empty table gives an empty ledger (ablations
give zeros); input columns named like an output column are dropped.
"""

from __future__ import annotations

import operator
import re
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewsift.llm.common import text_bytes, without
from viewsift.session import materialize

#: Words in a window whose second sight counts as a repetition.
WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_text_lines",
            "n_stutters", "n_unspaced"]
SYMBOLS = b"#*$%&|<>"
#: Code points of scripts written without spaces (Thai to Myanmar, Khmer, kana, Han).
UNSPACED_RANGES = [(0x0E00, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF),
                   (0x20000, 0x3FFFF)]
UNSPACED = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNSPACED_RANGES) + "]")
#: No character from U+0800 on is encoded without one of these bytes.
HIGH = re.compile(rb"[\xe0-\xf4]")

# Rule name -> failure as an expression over the measurements; the order gives the bits.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "dup_lines": "100 * n_dup_lines > 50 * n_text_lines",
    "stutters": "100 * n_stutters > 30 * n_words",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars - n_unspaced > 20 * n_words)",
}
BASE_RULES = ("few_words", "repeats")
#: Versioned policies: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "symbols", "dup_lines", "stutters"),
    "v2": tuple(RULES),
}
POLICY = "v2"


def mask_of(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def repeated_words(words: list[bytes], joined: bytes, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    grams = [joined[a:b] for a, b in zip(starts[:n].tolist(), ends[window - 1:].tolist())]
    first: dict[bytes, int] = {}
    twice: set[bytes] = set()
    if len(set(grams)) == n:
        return 0
    for g in grams:
        if first.setdefault(g, 0):
            twice.add(g)
        first[g] = 1
    edges = np.zeros(len(words) + 1, np.int64)
    for i, g in enumerate(grams):
        if g in twice:
            edges[i] += 1
            edges[i + window] -= 1
    return int(np.count_nonzero(np.cumsum(edges)[:-1]))


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    words = text.split()
    joined = b" ".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), len(joined.decode("utf-8", "replace")) - max(0, len(words) - 1),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words, joined), len(lines), sum(map(operator.eq, words, words[1:])),
            len(UNSPACED.findall(text.decode("utf-8", "replace"))) if HIGH.search(text) else 0)


@F.arrow_udf(T.StructType([T.StructField(m, T.LongType()) for m in MEASURES]))
def _measured(text: pa.Array) -> pa.Array:
    rows = [measure(t) for t in text_bytes(text)]
    return pa.StructArray.from_arrays(
        [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))], names=MEASURES)


def fail_bits() -> Column:
    """One bit per failed rule, each rule evaluated once."""
    bits = [F.when(F.expr(e), F.lit(1 << i)).otherwise(F.lit(0)) for i, e in enumerate(RULES.values())]
    return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")


def rule_ledger(docs: DataFrame) -> DataFrame:
    """``docs`` plus the measurements and ``failed`` (bit per rule of ``RULES``)."""
    docs = without(docs, *MEASURES, "failed", "_m")
    rows = docs.withColumn("_m", _measured(F.col("text")))
    rows = rows.select(*[f"`{c}`" for c in docs.columns], *[F.col(f"_m.{m}").alias(m) for m in MEASURES])
    return rows.withColumn("failed", fail_bits())


def stored_ledger(docs: DataFrame) -> DataFrame:
    """The ledger of ``docs`` (doc_id, text) as a written table without the texts: rules are evaluated once, however often it is read."""
    return materialize(rule_ledger(docs).select("doc_id", *MEASURES, "failed"), "quality-ledger")


def only_rule(policy: str = POLICY) -> Column:
    """The one rule for which a policy rejects a ledger row; null where none or several do."""
    hit = F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long"))
    out = F.lit(None).cast("string")
    for r in POLICIES[policy]:
        out = F.when(hit == mask_of([r]), r).otherwise(out)
    return out


def judged(ledger: DataFrame, policy: str = POLICY) -> DataFrame:
    """``ledger`` (stored) plus a verdict per policy (``kept_<policy>``), ``only_rule`` and how many documents that rule alone rejects."""
    cut = ablations(ledger).where(F.col("policy") == policy).select(F.col("rule").alias("_rule"), F.col("n_only_this_rule"))
    rows = ledger.select("*", *[(~rejected(p)).alias(f"kept_{p}") for p in POLICIES], only_rule(policy).alias("only_rule"))
    return rows.join(F.broadcast(cut), F.col("only_rule") == F.col("_rule"), "left").drop("_rule")  # a row per rule


def rejected(policy: str = POLICY) -> Column:
    """Whether a ledger row fails under a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) != 0


def apply_policy(ledger: DataFrame, policy: str = POLICY) -> DataFrame:
    """The ledger's rows that the policy keeps."""
    return ledger.where(~rejected(policy))


def ablations(ledger: DataFrame) -> DataFrame:
    """Per policy and rule: documents rejected, hit by the rule, and kept if the rule were left out."""
    patterns = ledger.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    rules = [(p, r, mask_of(rs), mask_of([r])) for p, rs in POLICIES.items() for r in rs]
    table = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"),
                                         F.lit(m).cast("long").alias("mask"), F.lit(b).cast("long").alias("bit"))
                                for p, r, m, b in rules]))
    cut = patterns.select("n", "failed", table.alias("r")).select(
        "n", "r.policy", "r.rule", F.col("failed").bitwiseAND(F.col("r.mask")).alias("hit"), "r.bit")
    return cut.groupBy("policy", "rule").agg(
        F.sum(F.when(F.col("hit") != 0, F.col("n")).otherwise(0)).alias("n_rejected"),
        F.sum(F.when(F.col("hit").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_hit"),
        F.sum(F.when(F.col("hit") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this_rule"))
