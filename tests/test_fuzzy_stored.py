"""Stored trigrams: the same matches as a pass over all titles, from few rows."""

import random
import tempfile

import pytest

from viewsift.operators import fuzzy

WORDS = ["Google", "Pixel", "phone", "Maps", "Windows", "iPad", "Café", "pro", "a", "XL", "Apple", "8", "İstanbul", "---"]


def matches(df):
    return sorted((r.page_title, r.similarity) for r in df.collect())


@pytest.fixture(scope="module")
def stored(spark):
    rnd = random.Random(6)
    titles = ["_".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 5))) for _ in range(800)] + ["", "---", "google pixel phone"]
    df = spark.createDataFrame([(t,) for t in titles] + [(None,)], "page_title string")
    path = tempfile.mkdtemp(prefix="viewsift-trigrams-")
    n = [fuzzy.add_titles(spark, part, path) for part in (df.limit(300), df, df)]
    assert sum(n) == len(set(titles)) and n[2] == 0
    return df.where("page_title IS NOT NULL"), path


@pytest.mark.parametrize("query", ["google pixel phone", "Maps", "windows 8 pro xl", "a", "nothing like it", "İstanbul café", "", "--"])
@pytest.mark.parametrize("threshold", [0.1, 0.5, 1.0])
def test_equal_to_a_pass_over_all_titles(spark, stored, query, threshold):
    df, path = stored
    assert matches(fuzzy.search_stored(spark, query, path, threshold)) == matches(fuzzy.fuzzy_search(df, query, threshold=threshold))


def test_only_the_rarest_trigrams_are_read(spark, stored):
    df, path = stored
    few = fuzzy.rarest_trigrams(spark, "google pixel phone", path, 0.5)
    assert 0 < len(few) < len(fuzzy.trigrams("google pixel phone")) * 0.6
    found = fuzzy.search_stored(spark, "google pixel phone", path, 0.5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "slot" in plan and "In(trigram" in plan.replace("PushedFilters: [In(", "In(").replace(" ", "")
    assert len({f.rsplit("slot=", 1)[1].split("/")[0] for f in found.inputFiles()}) <= fuzzy.SLOTS


def test_bad_thresholds(spark, stored):
    for t in (0, -1, 1.5):
        with pytest.raises(ValueError):
            fuzzy.search_stored(spark, "x", stored[1], t)


def test_nothing_stored(spark):
    assert fuzzy.search_stored(spark, "google", tempfile.mkdtemp() + "/none").count() == 0
