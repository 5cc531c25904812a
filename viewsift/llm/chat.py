"""Chat formatting by perspective rotation: each participant in turn is the assistant.

For every participant of a conversation the whole dialogue is rendered once: that
speaker's turns as ``assistant``, everybody else's as users named after them, and
the mask marks the assistant's texts as character spans. Narrators (``system``)
are context in every rendering and never the assistant.

Turns are numbered by a range-partitioned sort and rendered in blocks of
``BLOCK_TURNS`` turns, so no conversation, however long, meets in one task. The
blocks are pieces of one rendering: joined in their order they are the whole
dialogue, ``offset`` is a block's place in it, and the mask counts from the start of
the whole. A conversation of up to ``BLOCK_TURNS`` turns is one row per participant.
All native expressions.

Defined cases: a null text is empty; a null role speaks as ``unknown`` and is no
participant; null turns come first; turns alike in number go by role, then text;
repeated rows are repeated turns; rows without conv_id are one conversation; a
conversation without participant has no rendering; an empty table gives an empty
result; further input columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewsift.operators.ranking import sorted_row_number
from viewsift.session import materialize

NARRATORS = ("system",)
UNKNOWN = "unknown"
BLOCK_TURNS = 256
STRETCH_BLOCKS = 4096


def _head(speaker: Column, role: Column) -> Column:
    """The line before a turn's text, seen as ``speaker``."""
    name = F.coalesce(role, F.lit(UNKNOWN))
    return F.when(role.isin(*NARRATORS), F.concat(F.lit("<|"), role, F.lit("|>\n"))) \
        .when(role == speaker, F.lit("<|assistant|>\n")) \
        .otherwise(F.concat(F.lit("<|user name="), name, F.lit("|>\n")))


def _spans(turns: Column) -> Column:
    """Start and end of the assistant's texts inside the block."""
    span = "struct<begin: bigint, end: bigint>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def step(a: Column, t: Column) -> Column:
        begin = a["at"] + F.length(t["head"])
        own = F.struct(begin.alias("begin"), (begin + F.length(t["text"])).alias("end"))
        return F.struct((a["at"] + F.length(t["line"])).alias("at"),
                        F.when(t["own"], F.array_append(a["spans"], own)).otherwise(a["spans"]).alias("spans"))
    return F.aggregate(turns, start, step, lambda a: a["spans"])


def _with_offsets(blocks: DataFrame) -> DataFrame:
    """``blocks`` (a written table) plus ``offset``: the characters of the conversation's earlier blocks.

    Sums of ``STRETCH_BLOCKS`` blocks first, so no task adds up all blocks of a long conversation.
    """
    key = ["conv_id", "speaker"]
    before = [Window.unboundedPreceding, -1]
    sizes = blocks.select(*key, "block", F.floor(F.col("block") / STRETCH_BLOCKS).alias("stretch"), F.length("text").alias("size"))
    sums = sizes.groupBy(*key, "stretch").agg(F.sum("size").alias("size"))
    begins = F.sum("size").over(Window.partitionBy(*key).orderBy("stretch").rowsBetween(*before)).alias("begins")
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in (*key, "stretch")], begins)
    inner = F.sum("size").over(Window.partitionBy(*key, "stretch").orderBy("block").rowsBetween(*before)).alias("inner")
    sizes = sizes.select(*key, "block", "stretch", inner)
    both = sizes.join(sums, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*key, "stretch")])
    zero = F.lit(0).cast("long")
    at = both.select(*[F.col(c).alias(f"_{c}") for c in (*key, "block")],
                     (F.coalesce("begins", zero) + F.coalesce("inner", zero)).alias("offset"))
    return blocks.join(at, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*key, "block")]).select(*blocks.columns, "offset")


def rotate(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per conversation, participant and block: conv_id, speaker, block, n_turns, n_trained, offset, text, mask."""
    turns = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = sorted_row_number(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), "text"],
                              out="seq")
    speakers = conversations.where(F.col("role").isNotNull() & ~F.col("role").isin(*NARRATORS)) \
        .select(F.col("conv_id").alias("_conv"), F.col("role").alias("speaker")).distinct()
    seen = turns.join(speakers, F.col("conv_id").eqNullSafe(F.col("_conv")))
    head = _head(F.col("speaker"), F.col("role"))
    own = F.coalesce(F.col("role") == F.col("speaker"), F.lit(False))
    turn = F.struct("seq", head.alias("head"), "text", own.alias("own"),
                    F.concat(head, F.col("text"), F.lit("<|end|>\n")).alias("line"))
    block = F.floor((F.col("seq") - 1) / block_turns).cast("long").alias("block")
    lists = seen.groupBy("conv_id", "speaker", block).agg(F.sort_array(F.collect_list(turn)).alias("t"))  # block_turns at most
    blocks = lists.select(
        "conv_id", "speaker", "block", F.size("t").cast("long").alias("n_turns"),
        F.size(F.filter("t", lambda t: t["own"])).cast("long").alias("n_trained"),
        F.array_join(F.transform("t", lambda t: t["line"]), "").alias("text"), _spans(F.col("t")).alias("spans"))
    whole = F.transform("spans", lambda s: F.concat_ws(":", (s["begin"] + F.col("offset")).cast("string"),
                                                       (s["end"] + F.col("offset")).cast("string")))
    return _with_offsets(materialize(blocks, "chat-blocks")).select(
        "conv_id", "speaker", "block", "n_turns", "n_trained", "offset", "text", F.array_join(whole, ",").alias("mask"))
