"""Link extraction over a page table and seeded, repeatable picks.

Re-aimed from "fetch one index page, pick a random ``.gz`` link": extraction
runs per row with built-in regex functions over every page; the pick is a
seeded hash order, so reruns choose the same link and no driver-side random
choice is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An ``a`` tag with its attributes; attribute values may be quoted either way or bare.
_VALUE = r"""\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
ANCHOR_PATTERN = rf"""(?i)<a((?:\s+[^\s=>"']+(?:{_VALUE})?)*+)\s*/?>"""
# The first attribute named exactly ``href`` among those of a tag (never ``data-href``).
HREF_PATTERN = rf"""(?i)^(?:\s+(?!href[\s=])[^\s=>"']+(?:{_VALUE})?)*\s+href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Character references an address can hold; the ampersand comes last.
ENTITIES = [("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]
ORIGIN_PATTERN = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)"


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute links stay; ``/x`` joins the base's origin; ``x`` joins the base folder."""
    origin = F.regexp_extract(base, ORIGIN_PATTERN, 1)
    folder = F.regexp_extract(base, r"^([^?#]*/)", 1)
    return (F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
            .when(href.startswith("/"), F.concat(origin, href))
            .otherwise(F.concat(folder, href)))


def href_of(attributes: Column) -> Column:
    """The ``href`` value of an anchor's attributes, unquoted and with character references resolved."""
    value = F.regexp_extract(attributes, HREF_PATTERN, 1)
    value = F.regexp_replace(value, "^[\"']|[\"']$", "")
    for name, char in ENTITIES:
        value = F.replace(value, F.lit(name), F.lit(char))
    return F.trim(value)


def page_links(pages: DataFrame, suffix: str | None = ".gz", url_col: str = "url",
               html_col: str = "html", id_col: str = "page_id") -> DataFrame:
    """Every ``a[href]`` of every page (position kept), optionally only those ending in ``suffix``."""
    tags = F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR_PATTERN), 1)
    tags = F.filter(tags, lambda t: t.rlike(HREF_PATTERN))
    links = pages.select(id_col, url_col, F.posexplode(F.transform(tags, href_of)).alias("link_pos", "href"))
    if suffix:
        links = links.where(F.col("href").endswith(suffix))
    return links.select(id_col, F.col("link_pos").cast("long").alias("link_pos"), "href",
                        resolve_url(F.col(url_col), F.col("href")).alias("full_url"))


def seeded_order(seed: str, col: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.col(col)))


def seeded_pick(links: DataFrame, seed: str, group_cols: list[str] | None = None,
                value_col: str = "full_url") -> DataFrame:
    """One link per group (or overall), the one with the smallest ``md5(seed || link)``.

    Per group it is an aggregate (``min_by``) combined map-side, not a sort;
    ties between equal links pick the same value either way.
    """
    key = seeded_order(seed, value_col)
    pick = F.min_by(F.col(value_col), F.struct(key, F.col(value_col))).alias(value_col)
    if group_cols:
        return links.groupBy(*group_cols).agg(pick)
    return links.agg(pick)


def seeded_sample(df: DataFrame, seed: str, n: int, group_cols: list[str], value_col: str = "full_url") -> DataFrame:
    """The ``n`` rows per group with the smallest ``md5(seed || value)`` (repeatable sampling).

    ``row_number() <= n`` plans as WindowGroupLimit: each map task keeps at most
    ``n`` rows per group before the shuffle, so a hot group never moves whole.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*group_cols).orderBy(seeded_order(seed, value_col), F.col(value_col))
    return df.withColumn("pick_no", F.row_number().over(w)).where(F.col("pick_no") <= int(n))
