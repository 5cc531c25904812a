"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target share of the rows over its own rows.
Each document draws its number of copies by inverting the Poisson distribution
of that rate at a uniform number hashed from the seed and the document, so a
rerun, a lost task or another partitioning draws the same. Copies are exploded
and shuffled globally: dealt by a hashed key and sorted by it in each partition.

The only grouping is a count per source (combined map-side); documents meet
their source's row by a join whose document side may be split, so a source may
hold any part of the rows.

Defined cases: a null source is a source of its own; a null text is a document
like any other; a rate of zero draws no copies; a row without doc_id is hashed by
its text; equal rows draw equally and each is replicated (their order among each
other means nothing); an empty table gives an empty result; input columns named
like an output column are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewsift.llm.common import packed, unpacked, without
from viewsift.session import materialize

SEED = 11
#: Target share of a source grows as its rows to this power (1: as they are, 0: all alike).
TEMPERATURE = 0.5
#: A Poisson draw of a larger mean is the sum of draws of means below this.
STEP_MEAN = 16.0
#: Terms of a distribution: the rest behind mean + 12 sqrt(mean) + 16 is below 2^-53.
STEP_TERMS = 80


def unit_hash(text: Column) -> Column:
    """A uniform number in (0, 1) with 52 bits from the MD5 of ``text``."""
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def poisson_inverse(u: Column, mean: Column) -> Column:
    """The least k whose Poisson distribution function reaches ``u`` (means up to ``STEP_MEAN``)."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.lit(0).alias("k"))

    def term(s: Column, k: Column) -> Column:
        p = s["p"] * mean / k
        more = s["c"] < u
        return F.struct(F.when(more, p).otherwise(s["p"]).alias("p"), F.when(more, s["c"] + p).otherwise(s["c"]).alias("c"),
                        F.when(more, k).otherwise(s["k"]).alias("k"))
    terms = F.least(F.ceil(mean + F.sqrt(mean) * 12 + 16), F.lit(STEP_TERMS)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), terms), start, term, lambda s: s["k"])


def poisson_copies(key: Column, rate: Column) -> Column:
    """Number of copies with mean ``rate``, drawn from hashes of ``key``."""
    steps = F.greatest(F.ceil(rate / STEP_MEAN).cast("int"), F.lit(1))
    draws = F.transform(F.sequence(F.lit(1), steps), lambda i: poisson_inverse(
        unit_hash(F.concat_ws(":", key, F.lit("draw"), i.cast("string"))), rate / steps))
    return F.aggregate(draws, F.lit(0), lambda a, b: a + b).cast("long")


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, total: float | None = None,
                 temperature: float = TEMPERATURE) -> DataFrame:
    """(source, n_docs, rate) per source.

    ``weights`` are target shares per source (relative; an unnamed source gets
    none); without them a share is the source's row count to the power
    ``temperature``. ``total`` is the expected number of copies (the row count).
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    if weights is None:
        share = F.pow(F.col("n_docs").cast("double"), F.lit(float(temperature)))
    else:
        share = F.lit(0.0)
        for name, weight in weights.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(share)
    counts = counts.withColumn("_share", share)
    shares = counts.agg(F.sum("_share")).scalar()
    rows = counts.agg(F.sum("n_docs").cast("double")).scalar()
    goal = rows if total is None else F.lit(float(total))
    rate = F.when(shares > 0, F.col("_share") / shares * goal / F.col("n_docs")).otherwise(0.0)
    return counts.select("source", "n_docs", rate.alias("rate"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, total: float | None = None,
        temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """``docs`` replicated to the target weights in a global random order, plus copy, n_copies and rate.

    ``copy`` numbers a document's copies from 1; ``mix_key``, a hash of the document
    and the copy, deals the rows to partitions and orders them there.
    """
    docs = without(docs, "copy", "n_copies", "rate", "mix_key")
    # A written table has a known size: Spark broadcasts it while it is small, and joins it otherwise.
    rates = materialize(source_rates(docs, weights, total, temperature).select(F.col("source").alias("_of"), "rate"), "rates")
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"),
                                                        F.concat(F.lit("text "), F.md5(F.col("text").cast("binary"))),
                                                        F.lit("null")))
    rows = packed(docs, _source=F.col("source"), _key=key).join(rates, F.col("_source").eqNullSafe(F.col("_of")))
    # The draw stands once in the plan: its array [n, n, ...] of n elements is exploded.
    copies = F.transform(F.array(poisson_copies(F.col("_key"), F.col("rate"))), lambda n: F.array_repeat(n, n.cast("int")))
    rows = rows.select("_row", "_key", "rate", F.posexplode(copies[0]).alias("_pos", "n_copies"))
    rows = rows.withColumn("copy", F.col("_pos").cast("long") + 1)
    rows = rows.withColumn("mix_key", F.md5(F.concat_ws(":", F.col("_key"), F.lit("order"), F.col("copy").cast("string"))
                                            .cast("binary")))
    # A hashed key needs no sampled ranges: its hash deals rows evenly, and a document's copies apart.
    rows = rows.repartition("mix_key").sortWithinPartitions("mix_key")
    return unpacked(rows, docs.columns, "copy", "n_copies", "rate", "mix_key")
