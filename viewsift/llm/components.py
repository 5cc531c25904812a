"""Connected components of a link table by alternating large-star and small-star steps.

Every step is grouping and equi-joins over the link table, so no vertex's
neighbours meet in one task: minima are combined map-side and a hot vertex's
links are one side of a join that can be split. Each round is written under the
checkpoint folder, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewsift.session import materialize

#: Links of a few rounds always reach a star forest (O(log² n)); beyond this something is wrong.
MAX_ROUNDS = 60


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """Large star (``both_ways``) or small star of links (hi, lo) with hi > lo."""
    if both_ways:
        ends = links.select("hi", "lo").union(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = ends.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("_min"))
        # neighbours above the vertex go to its minimum
        out = ends.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("_min").alias("lo"))
    else:
        least = links.groupBy("hi").agg(F.min("lo").alias("_min"))
        # the vertex and its smaller neighbours go to the smallest
        out = links.join(least, "hi").select(
            F.explode(F.array(F.struct(F.col("hi"), F.col("_min").alias("lo")),
                              F.struct(F.col("lo").alias("hi"), F.col("_min").alias("lo")))).alias("e")
        ).select("e.hi", "e.lo")
    return out.where("hi > lo").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that ``links`` (hi, lo: long, hi > lo) names, root its component's least node."""
    links = materialize(links.where("hi > lo").distinct(), "links")
    state = _state(links)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        links = materialize(_star(_star(links, True), False), "stars")
        now = _state(links)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("the links did not settle")
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
