"""URL filters: allow and block rules first, gradient-boosted trees on lexical features for the rest.

The URLs that a rule decides are the labelled ones. Features are native
expressions: lengths, depth, digit ratio, character entropy, parameter counts,
and statistics of the host's suffixes (how common a suffix is, and the smoothed
share of blocked URLs under it, for labelled URLs out of fold) from one aggregation joined back. Spark ML's
boosted trees are trained on at most about ``TRAIN_ROWS`` distinct labelled URLs,
drawn per class by a hash and weighted by their rows, and judge every URL without
a rule. No Python runs in tasks.

Defined cases: a null URL, or one without ``://``, has an empty host and path, fits
no rule and is judged by its features; without labelled rows the verdict is
``allow``, with labels of one kind it is that kind; repeated rows are judged each
and count each; of rules equally long the longer host wins; an empty table gives
an empty result; input columns named like an output column are dropped.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewsift.llm.common import ascii_lower, packed, unpacked, without
from viewsift.session import materialize

ALLOW, BLOCK = "allow", "block"
#: (action, host and path); a rule fits its host and all subdomains.
RULES = [(ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/")]
TRAIN_ROWS = 40_000
TREES = 20
DEPTH = 4
SEED = 5
#: Weight of the overall share of blocked URLs against a suffix's own.
PRIOR = 10.0
#: Folds of URLs: the shares a labelled URL is trained with come from the other folds.
FOLDS = 5
FEATURES = ["f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_entropy", "f_params",
            "f_param_length", "f_fragment", "f_secure", "f_tld_rows", "f_tld_blocked", "f_domain_rows", "f_domain_blocked"]


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=None) -> Column:
    """Struct (action, rule) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<action: string, rule: string>")
    ordered = sorted(RULES if rules is None else rules, key=lambda r: (len(r[1]), r[1].index("/")))
    for action, rule in ordered:  # later conditions wrap earlier ones, so the longest is asked first
        own, start = rule[:rule.index("/")], rule[rule.index("/"):]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def entropy(text: Column) -> Column:
    """Bits per character: runs of the sorted characters give the counts."""
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("n"), F.lit(0.0).alias("s"))

    def weight(n: Column) -> Column:
        return F.when(n > 0, n * F.log2(n)).otherwise(0.0)

    def step(a: Column, c: Column) -> Column:
        same = a["c"] == c
        return F.struct(c.alias("c"), F.when(same, a["n"] + 1).otherwise(1.0).alias("n"),
                        F.when(same, a["s"]).otherwise(a["s"] + weight(a["n"])).alias("s"))
    total = F.aggregate(chars, start, step, lambda a: a["s"] + weight(a["n"]))
    size = F.size(chars).cast("double")
    return F.when(size > 0, F.log2(size) - total / size).otherwise(0.0)


def _count_of(text: Column, part: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))).cast("double")


def lexical(rows: DataFrame) -> DataFrame:
    """``rows`` (url, host, path) plus the features of the URL itself and its suffixes."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1)
    size = F.length(url).cast("double")
    labels = F.split(F.col("host"), "\\.")
    return rows.select(
        "*", size.alias("f_length"), F.length("host").cast("double").alias("f_host_length"),
        F.length("path").cast("double").alias("f_path_length"), _count_of(F.col("path"), "/").alias("f_depth"),
        F.size(labels).cast("double").alias("f_labels"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(size, F.lit(1.0))).alias("f_digits"),
        entropy(url).alias("f_entropy"),
        F.when(query == "", 0.0).otherwise(_count_of(query, "&") + 1).alias("f_params"),
        F.length(query).cast("double").alias("f_param_length"), F.contains(url, F.lit("#")).cast("double").alias("f_fragment"),
        url.startswith("https:").cast("double").alias("f_secure"),
        F.substring_index("host", ".", -1).alias("tld"), F.substring_index("host", ".", -2).alias("domain"))


def _with_suffix(rows: DataFrame, name: str) -> DataFrame:
    """Adds how common the suffix is and its smoothed share of blocked URLs among the labelled ones.

    A labelled URL's share leaves out the labels of its own fold of URLs, so it does
    not hold its own label (nor that of its repeated rows).
    """
    fold = F.pmod(F.xxhash64("url"), F.lit(FOLDS)).cast("int")
    per_fold = [F.when(fold == k, F.col("label")) for k in range(FOLDS)]
    stats = rows.groupBy(F.col(name).alias("_suffix")).agg(
        F.count(F.lit(1)).alias("_n"), F.array(*[F.coalesce(F.sum(x), F.lit(0.0)) for x in per_fold]).alias("_blocked"),
        F.array(*[F.count(x).cast("double") for x in per_fold]).alias("_labelled"))
    share = rows.agg(F.coalesce(F.avg("label"), F.lit(0.5))).scalar()
    stats = stats.select("_suffix", F.log2(F.col("_n") + 1.0).alias(f"f_{name}_rows"), "_blocked", "_labelled")
    # A written table has a known size: broadcast while it is small, else joined with plain scans that can be split.
    stats = materialize(stats, f"suffix-{name}")

    def others(counts: str) -> Column:
        own = F.when(F.col("label").isNotNull(), F.get(F.col(counts), fold)).otherwise(0.0)
        return F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) - own
    blocked = (others("_blocked") + PRIOR * share) / (others("_labelled") + PRIOR)
    return rows.join(stats, F.col(name) == F.col("_suffix")).withColumn(f"f_{name}_blocked", blocked) \
        .drop("_suffix", "_blocked", "_labelled")


def featured(pages: DataFrame, rules=None) -> DataFrame:
    """url, host, path, rule, label (1 block, 0 allow, null without rule) and ``FEATURES`` of every row."""
    rows = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    fit = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("_fit", fit).withColumn("rule", F.col("_fit.rule")) \
        .withColumn("label", F.when(F.col("_fit.action") == BLOCK, 1.0).when(F.col("_fit.action") == ALLOW, 0.0)).drop("_fit")
    return _with_suffix(_with_suffix(lexical(rows), "tld"), "domain")


def training_urls(known: DataFrame, kinds: dict[float, int], train_rows: int = TRAIN_ROWS) -> DataFrame:
    """label, weight and ``FEATURES`` of distinct labelled URLs; ``kinds`` has the number of distinct URLs per label.

    Half of the rows are the rarer label's, or all its URLs if they are fewer. The
    weight is a URL's number of rows over its chance to be drawn.
    """
    rates, left = {}, float(train_rows)
    for i, (label, n) in enumerate(sorted(kinds.items(), key=lambda x: x[1])):
        own = min(float(n), left / (len(kinds) - i))
        rates[label], left = own / n, left - own
    rate = F.create_map(*[F.lit(x) for kv in rates.items() for x in kv])[F.col("label")]
    steps = 1 << 40
    drawn = known.where("label IS NOT NULL").withColumn("_rate", rate) \
        .where(F.pmod(F.xxhash64("url"), F.lit(steps)) < steps * F.col("_rate"))
    # a URL's rows are alike but for the page: combined per task before they meet
    same = [F.min(c).alias(c) for c in ("label", *FEATURES)]
    return drawn.groupBy("url").agg(*same, (F.count(F.lit(1)) / F.min("_rate")).alias("weight")).drop("url")


def url_filter(pages: DataFrame, rules=None, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``pages`` (url, more columns) plus host, path, rule and verdict."""
    pages = without(pages, "host", "path", "rule", "verdict")
    rows = packed(pages, url=F.col("url"))
    known = materialize(featured(rows, rules), "url-features")
    kinds = {r["label"]: r["n"] for r in known.where("label IS NOT NULL").groupBy("label")
             .agg(F.approx_count_distinct("url").alias("n")).collect()}
    if len(kinds) < 2:
        guess = F.lit(BLOCK if kinds.get(1.0) else ALLOW)
        judged = known.withColumn("_guess", guess)
    else:
        join = VectorAssembler(inputCols=FEATURES, outputCol="features")
        sample = materialize(training_urls(known, kinds, train_rows), "url-labels")
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight").fit(join.transform(sample))
        judged = model.transform(join.transform(known))
        judged = judged.withColumn("_guess", F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW))
    verdict = F.when(F.col("label") == 1.0, BLOCK).when(F.col("label") == 0.0, ALLOW).otherwise(F.col("_guess"))
    return unpacked(judged.withColumn("verdict", verdict), pages.columns, "host", "path", "rule", "verdict")
