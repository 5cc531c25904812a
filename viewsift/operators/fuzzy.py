"""Fuzzy title search by trigram similarity (J6), re-aimed from a trigram index.

Trigrams follow the published pg_trgm definition: lower-case the text, split it
into words of letters and digits, pad each word with two spaces in front and one
behind, take every 3-character substring, and keep the set. Similarity is
``|A ∩ B| / |A ∪ B|``. Everything is a built-in higher-order array expression, so
a search is one pass over the distinct titles (map-side de-duplicated) with no
join and no pairs: the query's trigram set is a literal.

For repeated searches the trigrams can be stored (``add_titles``): a table with one
row per (trigram, title), dealt by the trigram and sorted by it, to which later loads
append their new titles. A search in it (``search_stored``) reads only the rows of a
few trigrams. With q trigrams in the query and threshold t, a match shares at least
ceil(t * q) of them, so it holds one of the q - ceil(t * q) + 1 rarest, and its own
number of trigrams lies between t * q and q / t. The titles found are compared exactly.
"""

from __future__ import annotations

import math
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewsift.session import materialize

DEFAULT_THRESHOLD = 0.3  # pg_trgm's default similarity threshold
WORD_SPLIT = r"[^\p{L}\p{N}]+"


def trigrams_expr(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), WORD_SPLIT), lambda w: w != "")

    def word_trigrams(w: Column) -> Column:
        p = F.concat(F.lit("  "), w, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, 3))

    return F.array_distinct(F.flatten(F.transform(words, word_trigrams)))


def trigrams(text: str) -> list[str]:
    """The same trigram set in Python (for literals and tests)."""
    out: list[str] = []
    for w in re.split(r"[^\w]+|_", text.lower()):
        if not w:
            continue
        p = f"  {w} "
        out.extend(p[i:i + 3] for i in range(len(p) - 2))
    return sorted(set(out))


def similarity_expr(a: Column, b: Column) -> Column:
    inter = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(inter / union)


def fuzzy_search(df: DataFrame, query: str, title_col: str = "page_title",
                 threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Distinct titles with ``similarity(title, query) >= threshold``."""
    q = F.array(*[F.lit(t) for t in trigrams(query)]).cast("array<string>")
    titles = df.select(F.col(title_col).alias("page_title")).distinct()
    scored = titles.select("page_title", similarity_expr(trigrams_expr(F.col("page_title")), q).alias("similarity"))
    return scored.where(F.col("similarity") >= float(threshold))


# --------------------------------------------------------------------------- stored trigrams

#: Folders that trigrams are dealt into.
SLOTS = 64
POSTINGS = "trigram string, n_trigrams int, page_title string, slot int"


def _slot(col: Column) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(SLOTS)).cast("int")


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # nothing stored yet
        return spark.createDataFrame([], schema)


def add_titles(spark: SparkSession, df: DataFrame, path: str, title_col: str = "page_title") -> int:
    """Store the trigrams of the titles that the table does not hold yet; returns how many titles are new.

    Titles are noted last, so a load that broke off is repeated; rows that are then
    stored twice change no search.
    """
    known = _stored(spark, f"{path}/titles", "page_title string")
    new = df.select(F.col(title_col).alias("page_title")).where("page_title IS NOT NULL").distinct() \
        .join(known, "page_title", "left_anti")
    new = materialize(new.withColumn("_t", trigrams_expr(F.col("page_title"))), "new-titles")
    rows = new.select(F.explode("_t").alias("trigram"), F.size("_t").alias("n_trigrams"), "page_title").withColumn("slot", _slot(F.col("trigram")))
    rows.hint("rebalance", "slot").sortWithinPartitions("slot", "trigram").write.mode("append").partitionBy("slot").parquet(f"{path}/postings")
    rows.groupBy("trigram").agg(F.count(F.lit(1)).alias("n")).write.mode("append").parquet(f"{path}/counts")
    new.select("page_title").write.mode("append").parquet(f"{path}/titles")
    return new.count()


def rarest_trigrams(spark: SparkSession, query: str, path: str, threshold: float) -> list[str]:
    """The trigrams of ``query`` of which every match holds one, by the stored counts."""
    own = trigrams(query)
    counts = _stored(spark, f"{path}/counts", "trigram string, n long").where(F.col("trigram").isin(own))
    n = {r[0]: r[1] for r in counts.groupBy("trigram").agg(F.sum("n")).collect()}  # the query's trigrams
    return sorted(own, key=lambda t: (n.get(t, 0), t))[:len(own) - math.ceil(threshold * len(own) - 1e-9) + 1]


def search_stored(spark: SparkSession, query: str, path: str, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """``fuzzy_search`` over the stored titles, reading the rows of the query's rarest trigrams only (``threshold`` above 0)."""
    if not 0 < threshold <= 1:
        raise ValueError(f"a stored search needs a threshold above 0 and up to 1, not {threshold}")
    size, few = len(trigrams(query)), rarest_trigrams(spark, query, path, threshold)
    slots = [r[0] for r in spark.createDataFrame([(t,) for t in few], "t string").select(_slot(F.col("t"))).distinct().collect()] if few else []
    rows = _stored(spark, f"{path}/postings", POSTINGS).where(
        F.col("slot").isin(slots) & F.col("trigram").isin(few)
        & F.col("n_trigrams").between(math.ceil(threshold * size - 1e-9), math.floor(size / threshold + 1e-9)))
    return fuzzy_search(rows, query, threshold=threshold)
