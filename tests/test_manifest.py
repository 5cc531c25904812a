"""The raw table's manifest: compaction, dropped dates, file ledger, metrics without a scan."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from viewsift.operators import curate, manifest
from viewsift.plans import analytics, daily_job
from viewsift.sources import dumps, warehouse

TS = dt.datetime(2024, 1, 30, 1)
DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]
SCHEMA = "domain string, page_title string, count_views int, source_file string, loaded_at timestamp_ntz, processing_date date"


@pytest.fixture
def path():
    return tempfile.mkdtemp(prefix="viewsift-manifest-") + "/t"


def rows(spark, name, days=DAYS, n=2):
    return spark.createDataFrame([("en", f"{name}{i}", i, name, TS, d) for d in days for i in range(n)], SCHEMA)


def titles(spark, path, **more):
    return sorted((r.page_title, r.processing_date.day) for r in warehouse.raw_table(spark, path, **more).collect())


def test_compaction_swaps_loads_in_one_commit(spark, path):
    for name in "abc":
        curate.raw_load(spark, rows(spark, name), path, name)
    want, before = titles(spark, path), manifest.current_version(spark, path)
    manifest.write_raw(rows(spark, "half"), manifest.folder(path, "compact-broken"))  # one that broke off
    assert titles(spark, path) == want
    assert manifest.compact(spark, path, "merged") == 3
    state = manifest.snapshot(spark, path)
    assert list(state.loads) == ["merged"] and state.gone == ["a", "b", "c"]
    assert titles(spark, path) == want == titles(spark, path, version=before)
    assert curate.raw_load(spark, rows(spark, "a"), path, "again") == 0  # its file is known all the same
    curate.raw_load(spark, rows(spark, "d"), path, "d")
    assert len(manifest.vacuum(spark, path)) == 3 and not os.path.exists(path + "/load_id=a")
    assert titles(spark, path) == sorted(want + [(f"d{i}", d.day) for d in DAYS for i in range(2)])
    assert manifest.vacuum(spark, path) and manifest.compact(spark, path, least=5) == 0


def test_of_two_compactions_the_first_counts(spark, path):
    for name in "ab":
        curate.raw_load(spark, rows(spark, name), path, name)
    want, base = titles(spark, path), manifest.current_version(spark, path)
    manifest.compact(spark, path, "first")
    # the second had read the same loads before the first committed
    manifest.write_raw(warehouse.raw_table(spark, path, base), manifest.folder(path, "second"))
    old = spark.createDataFrame([("second", "a"), ("second", "b")], "load_id string, replaces string")
    manifest.commit(spark, path, manifest.one(spark, action="compact", load_id="second", n_rows=base),
                    old.withColumn("action", F.lit("replace")))
    assert titles(spark, path) == want and list(manifest.snapshot(spark, path).loads) == ["first"]
    manifest.vacuum(spark, path)
    assert titles(spark, path) == want and not os.path.exists(path + "/load_id=second")


def test_dropped_dates(spark, path):
    for name in "ab":
        curate.raw_load(spark, rows(spark, name), path, name)
    assert manifest.drop_expired(spark, path, dt.date(2024, 1, 31), 29) == DAYS[:1]  # before Jan 2
    left = [(f"{n}{i}", d.day) for n in "ab" for d in DAYS[1:] for i in range(2)]
    assert titles(spark, path) == sorted(left)  # hidden at once, files still there
    assert os.path.exists(f"{path}/load_id=a/processing_date=2024-01-01")
    assert manifest.drop_expired(spark, path, dt.date(2024, 1, 31), 29) == []  # nothing is left to drop
    curate.raw_load(spark, rows(spark, "c", DAYS[:1]), path, "c")  # a load after the drop is seen
    left += [("c0", 1), ("c1", 1)]
    assert titles(spark, path) == sorted(left)
    assert len(manifest.vacuum(spark, path)) == 2 and not os.path.exists(f"{path}/load_id=a/processing_date=2024-01-01")
    assert titles(spark, path) == sorted(left)
    manifest.compact(spark, path)
    assert titles(spark, path) == sorted(left) and manifest.snapshot(spark, path).hidden() == []


def test_a_date_dropped_during_a_compaction_stays_hidden(spark, path, monkeypatch):
    for name in "ab":
        curate.raw_load(spark, rows(spark, name), path, name)
    write = manifest.write_raw

    def slow(*args):
        write(*args)
        manifest.drop_dates(spark, path, [DAYS[1]])
    monkeypatch.setattr(manifest, "write_raw", slow)
    manifest.compact(spark, path)
    assert {d for _, d in titles(spark, path)} == {1, 3}


def test_scans_prune_loads_and_dates(spark, path):
    for name in "ab":
        curate.raw_load(spark, rows(spark, name), path, name)
    manifest.drop_dates(spark, path, [DAYS[0]])
    df = warehouse.raw_table(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1]
    assert filters.startswith(("NOT", "(NOT", "Or", "or")) or "load_id" in filters.split("]")[0], plan
    assert "Join" not in plan


def test_unknown_version(spark, path):
    curate.raw_load(spark, rows(spark, "a"), path, "a")
    assert titles(spark, path, version=0) == []
    with pytest.raises(manifest.UnknownVersionError):
        warehouse.raw_table(spark, path, version=9)


def test_metrics_come_from_the_manifest_alone(spark, path):
    for i in range(4):
        more = spark.createDataFrame([(f"d{i}-{k}", "t", 1, f"f{i}", TS + dt.timedelta(hours=i), DAYS[i % 3]) for k in range(3000)], SCHEMA)
        curate.raw_load(spark, more.unionByName(rows(spark, f"x{i}")), path, f"load{i}")
    manifest.compact(spark, path)
    curate.raw_load(spark, rows(spark, "late", DAYS[:1]), path, "late")
    raw = warehouse.raw_table(spark, path)
    empty = spark.createDataFrame([], "processing_date date, x int")
    want = sorted(map(tuple, analytics.v_data_quality_metrics(raw, empty).collect()))
    got = analytics.v_data_quality_from_manifest(spark, path, empty)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "load_id=" not in plan and "t_commits" in plan
    assert sorted(tuple(r)[:-1] for r in got.collect()) == want
    exact = {r[0]: r[1] for r in raw.groupBy("processing_date").agg(F.count_distinct("domain")).collect()}
    assert all(abs(r.approx_domains - exact[r.processing_date]) <= 0.03 * exact[r.processing_date] for r in got.collect())


def test_sketched_medians(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "A").when(F.col("id") % 1000 == 1, "B").otherwise("C").alias("company"),
        (F.xxhash64("id") % 100_000 + 100_000).cast("int").alias("count_views"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("processing_date"))
    parts = analytics.company_partials(rows)
    got = {r.company: r for r in analytics.rankings_from_partials(parts, dt.date(2024, 1, 9), 7).collect()}
    for r in analytics.rankings_window(rows, dt.date(2024, 1, 9), 7).collect():
        own = got[r.company]
        assert (own.rank, own.page_count, own.total_views, own.avg_views, own.max_views, own.min_views, own.market_share_pct) == \
            (r.rank, r.page_count, r.total_views, r.avg_views, r.max_views, r.min_views, r.market_share_pct)
        rank = rows.where((F.col("company") == r.company) & (F.col("processing_date") >= "2024-01-02")) \
            .agg(F.avg((F.col("count_views") <= own.median_views).cast("double"))).first()[0]
        assert abs(rank - 0.5) <= analytics.MEDIAN_RANK_ERROR + 1 / r.page_count


# --------------------------------------------------------------------------- file ledger

def land(spark, landing, *lines):
    dumps.write_dump_lines(spark.createDataFrame(list(lines), "source_file string, line string"), landing)


def run(spark, root, **more):
    return daily_job.run_daily(spark, root + "/landing", root + "/wh", event_time_from_name=True, **more)


def states(spark, root):
    return {r.source_file: (r.state, r.n_rows, r.n_bad) for r in manifest.file_states(spark, root + "/wh/raw_pageviews").collect()}


A, B, C, E = (f"pageviews-20240130-{h}0000.gz" for h in ("10", "11", "12", "13"))


def test_bad_lines_are_quarantined_once(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="viewsift-ledger-")
    land(spark, root + "/landing", (A, "en Google_Maps 5000 0"), (A, "en bad"), (B, "en worse"), (C, " "))
    done = [run(spark, root) for _ in range(3)]
    assert [d.quarantined_lines for d in done] == [2, 0, 0] and [d.files_read for d in done] == [3, 0, 0]
    assert sorted(r.line for r in daily_job.read_quarantine(spark, root + "/wh").collect()) == ["en bad", "en worse"]
    assert states(spark, root) == {A: ("loaded", 1, 1), B: ("quarantined", 0, 1), C: ("empty", 0, None)}
    land(spark, root + "/landing", (E, "en Google_Maps 7000 0"))
    assert run(spark, root).files_read == 1


def test_a_broken_load_leaves_no_quarantine(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="viewsift-ledger-")
    land(spark, root + "/landing", (A, "en Google_Maps 5000 0"), (A, "en bad"))

    def broken(*args, **more):
        raise RuntimeError("lost executors")
    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", broken)
        with pytest.raises(RuntimeError):
            run(spark, root)
    assert daily_job.read_quarantine(spark, root + "/wh").count() == 0
    assert run(spark, root).raw_rows_loaded == 1
    assert daily_job.read_quarantine(spark, root + "/wh").count() == 1


def test_corrupt_files_are_noted_once_and_read_again_when_mended(spark):
    root = tempfile.mkdtemp(prefix="viewsift-ledger-")
    os.mkdir(root + "/landing")
    with open(f"{root}/landing/{A}", "wb") as f:
        f.write(b"no gzip")
    first = run(spark, root, audit=True)  # nothing but a corrupt file
    assert (first.files_read, first.raw_rows_loaded) == (0, 0)
    land(spark, root + "/landing", (B, "en Google_Maps 5000 0"))
    assert run(spark, root, audit=True).files_read == 1 and run(spark, root, audit=True).files_read == 0
    assert spark.read.parquet(root + "/wh/corrupt_files").count() == 1
    assert states(spark, root)[A][0] == "corrupt"
    os.remove(f"{root}/landing/{A}")
    land(spark, root + "/landing", (A, "en Google_Maps 6000 0"))
    assert run(spark, root, audit=True).raw_rows_loaded == 1
    assert states(spark, root) == {A: ("loaded", 1, None), B: ("loaded", 1, None)}
