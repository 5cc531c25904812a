"""Row numbers inside groups that may be hot (a third of all rows in one group).

``row_number() OVER (PARTITION BY g ORDER BY ...)`` puts every row of a group
through one task. Two exact replacements:

``split_row_number`` (lazy, for views) splits the position level by level: by the
value, then by coarse keys that follow the order of the tie-breakers (a date, a
domain, the first characters of a title). A histogram over all levels (combined
map-side) is summed up to each level, and a running sum over the siblings of a level
gives the rows before it; only rows equal in all of them are numbered in one task. So
neither a hot group nor a hot (group, value) pair meets there.

``sorted_row_number`` (materialised, for batches) makes no assumption about the
values: a range-partitioned sort on ``(g, order)`` cuts even one huge group, or a
run of equal rows, into many tasks; every row takes its position inside its
sorted partition, and a small table of per-(partition, group) counts turns
positions into row numbers. The same plan runs at every size.

Both equal the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewsift.session import materialize


def split_row_number(df: DataFrame, group: Sequence[str], value: str, ties: Sequence[Column],
                     out: str = "rank", cuts: Sequence[tuple[Column, bool]] = ()) -> DataFrame:
    """``df`` plus ``out`` = row number in ``group`` ordered by ``value`` desc, then ``ties``.

    ``cuts`` lists (key, descending) from coarse to fine; a row with a smaller key (a
    larger one if descending) must come first by ``ties`` too. ``group``, ``value`` and
    the keys must be non-null (they are join keys).
    """
    group, names = list(group), [f"_k{i}" for i in range(len(cuts) + 1)]
    rows = df.withColumns({"_k0": F.col(value), **{n: key for n, (key, _) in zip(names[1:], cuts)}})
    orders = [F.col(n).desc() if down else F.col(n).asc() for n, down in zip(names, [True, *(down for _, down in cuts)])]
    level = rows.groupBy(*group, *names).agg(F.count(F.lit(1)).alias("_n"))
    offsets = None
    for i in reversed(range(len(names))):  # the finest level first; each is the sum of the one below
        if i < len(names) - 1:
            level = level.groupBy(*group, *names[:i + 1]).agg(F.sum("_n").alias("_n"))
        before = Window.partitionBy(*group, *names[:i]).orderBy(orders[i]).rowsBetween(Window.unboundedPreceding, -1)
        own = level.select(*group, *names[:i + 1], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(f"_before{i}"))
        offsets = own if offsets is None else offsets.join(own, [*group, *names[:i + 1]])
    offset = sum((F.col(f"_before{i}") for i in range(len(names))), F.lit(0))
    offsets = offsets.select(*group, *names, offset.alias("_offset"))
    local = Window.partitionBy(*group, *names).orderBy(*ties)
    return (rows.join(offsets, [*group, *names])
            .withColumn(out, (F.col("_offset") + F.row_number().over(local)).cast("long"))
            .select(*df.columns, out))


def sorted_row_number(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                      out: str = "row_number") -> DataFrame:
    """``df`` plus ``out`` = ``row_number() OVER (PARTITION BY group ORDER BY order)``, skew-proof.

    The input is written once, so a row's place in its file is fixed; that place
    breaks the last ties, which lets the range partitioning cut even equal rows
    apart. The sorted, position-tagged rows are written too: whoever reads the
    result reads the same numbers.
    """
    group = list(group)
    keys = [F.col(g).asc_nulls_first() for g in group] + [F.col(o) if isinstance(o, str) else o for o in order]
    source = materialize(df, "numbering-input").withColumn("_tie", F.monotonically_increasing_id())
    # orderBy = range partitioning: split points come from a sample of the keys, so a group
    # holding a third of all rows is spread over about a third of the tasks.
    tagged = (source.orderBy(*keys, "_tie")
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))  # position inside the sorted partition
    tagged = materialize(tagged, "sorted-rows")  # positions are frozen as column values
    # One row per (partition, group) touched: at most #partitions + #groups rows.
    spans = tagged.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(F.col("_part").alias("_s_part"), *[F.col(g).alias(f"_s_{i}") for i, g in enumerate(group)],
                         "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    cond = [F.col("_part") == F.col("_s_part")] + [F.col(g).eqNullSafe(F.col(f"_s_{i}")) for i, g in enumerate(group)]
    rn = (F.col("_before") + (F.col("_pos") - F.col("_first")) + 1).cast("long")
    return tagged.join(spans, cond).select(*df.columns, rn.alias(out))
