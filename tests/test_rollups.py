"""Percentiles from latency counts, counts from footers, and lookups that skip pages."""

import datetime as dt

import pytest

from faultline.functions.timeframe import time_range
from faultline.operators import analytics, audit, histograms, latency
from faultline.session import work_path
from faultline.sources import store
from faultline.sources.synthetic import synthetic_events
from tests.conftest import event, rows_of
from tests.test_store import rows_scanned


@pytest.fixture(scope="module")
def events(spark):
    return synthetic_events(spark, 20_000).cache()


@pytest.fixture(scope="module")
def rollup(spark, events):
    return histograms.write_histograms(events, work_path(spark, "histogram-test"))


def test_every_level_gives_the_percentile(spark, events, rollup):
    want = rows_of(analytics.p95_latency(events))
    sizes = []
    for level in histograms.LEVELS:
        counts = histograms.read_level(spark, rollup, level)
        assert rows_of(histograms.p95_from_histogram(counts)) == want
        sizes.append(counts.count())
    assert sizes[0] > sizes[1] > sizes[2]


@pytest.mark.parametrize("lo, hi, parts", [
    ("2026-09-27 10:17:00", "2026-10-01 03:05:00", ["day", "hour", "hour", "minute", "minute"]),
    ("2026-09-28", "2026-09-30", ["day"]),
    ("2026-09-28 10:59:00", "2026-09-28 12:01:00", ["hour", "minute", "minute"]),
    ("2026-09-28 10:10:00", "2026-09-28 10:20:00", ["minute"]),
    ("2026-09-28 23:50:00", "2026-09-29 00:10:00", ["minute"]),
    ("2026-09-28 10:10:00", "2026-09-28 10:10:00", []),
])
def test_ranges_are_made_of_few_parts(spark, events, rollup, lo, hi, parts):
    counts = histograms.between(spark, rollup, lo, hi)
    assert rows_of(histograms.p95_from_histogram(counts)) == rows_of(analytics.p95_latency(events, None, lo, hi))
    assert sorted({f.split("/")[-3] for f in counts.inputFiles()}) == sorted(set(parts))


def test_nulls_count_and_rank_first(spark, events_of):
    rows = [event(i, latency=None if i < 96 else i) for i in range(100)] + [event(200 + i, latency=None, service="b") for i in range(3)]
    path = histograms.write_histograms(events_of(rows), work_path(spark, "null-histogram"))
    for level in histograms.LEVELS:
        assert sorted(tuple(r) for r in histograms.p95_from_histogram(histograms.read_level(spark, path, level)).collect()) == [("a-service", None), ("b", None)]
    assert rows_of(histograms.p95_from_histogram(histograms.read_level(spark, path, "day"), "0.97"), "service")[0] == ("a-service",)


def test_only_touched_days_are_counted_anew(spark, events_of):
    path, rollup = work_path(spark, "touched"), work_path(spark, "touched-histogram")
    first = events_of([event(1, "2024-01-01", latency=1), event(2, "2024-01-02", latency=2), event(3, "2024-01-09", latency=3)])
    store.append_batch(first, path)
    assert len(histograms.update_histograms(rollup, store.read_store(spark, path), first)) == 3
    before = set(histograms.read_level(spark, rollup, "day").inputFiles())
    more = events_of([event(4, "2024-01-02 10:00:00", latency=9)])
    store.append_batch(more, path)
    assert histograms.update_histograms(rollup, store.read_store(spark, path), more) == [dt.date(2024, 1, 2)]
    after = set(spark.read.schema(histograms.SCHEMA).parquet(f"{rollup}/day").inputFiles())
    assert {f.split("/")[-2] for f in before - after} == {"event_date=2024-01-02"}
    assert rows_of(histograms.read_level(spark, rollup, "day"), "latency_ms", "n") == [(1, 1), (2, 1), (3, 1), (9, 1)]


def test_whole_minutes_only(spark, rollup):
    with pytest.raises(ValueError):
        histograms.between(spark, rollup, "2026-09-28 10:10:30", "2026-09-28 10:20:00")


def test_profile_and_count_come_from_footers(spark, events):
    path = store.write_daily(events, work_path(spark, "footers"), "errorifexists", files=8)
    found = audit.stored_profile(spark, path)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(ts_ms), MAX(ts_ms)]" in plan and "PushedGroupBy: [event_date]" in plan
    assert rows_of(found) == rows_of(audit.partition_profile(store.read_store(spark, path)))
    count = audit.stored_row_count(spark, path)
    assert "PushedAggregation: [COUNT(*)]" in count._jdf.queryExecution().executedPlan().toString()
    assert count.first()[0] == 20_000
    # This session reads as it did before.
    assert "PushedAggregation" not in audit.row_count(store.read_store(spark, path))._jdf.queryExecution().executedPlan().toString()


def test_a_lookup_reads_pages_and_not_row_groups(spark, events_of):
    rows = [event(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=2 * i)) for i in range(40_000)]
    path = store.write_daily(events_of(rows), work_path(spark, "pages"), "errorifexists", files=1)
    minutes = analytics.range_lookup(store.read_store(spark, path), "a-service", "2024-01-01 12:00:00", "2024-01-01 12:10:00", 1000)
    assert rows_scanned(minutes) <= 2 * store.PAGE_ROWS and minutes.count() == 300
    # Compacted days keep their pages.
    store.compact_day(spark, path, dt.date(2024, 1, 1), files=1)
    again = time_range(store.read_store(spark, path), "2024-01-01 12:00:00", "2024-01-01 12:10:00")
    assert rows_scanned(again) <= 2 * store.PAGE_ROWS and again.count() == 300


def test_summary_takes_all_ranks_from_one_histogram(spark, events_of):
    rows = [event(i, latency=i * 7 % 31 - 5, endpoint="/x" if i % 3 else None) for i in range(40)] + [event(99, latency=None)]
    found = latency.latency_summary(events_of(rows))
    assert found._jdf.queryExecution().analyzed().toString().count("LogicalRDD") <= 2
    got = {r["endpoint"]: (r["median_latency_ms"], r["min_latency_ms"], r["max_latency_ms"]) for r in found.collect()}
    for endpoint in ("/x", None):
        values = sorted(r[7] for r in rows if r[8] == endpoint and r[7] is not None)
        middle = (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2
        assert got[endpoint] == (middle, values[0], values[-1])
