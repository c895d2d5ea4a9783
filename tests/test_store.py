import datetime as dt

import pytest

from faultline.operators import analytics, audit
from faultline.session import work_path, work_root
from faultline.sources import names, store, traces
from faultline.sources.synthetic import synthetic_events
from faultline.functions.timeframe import time_range
from tests.conftest import at, event, rows_of


@pytest.fixture(scope="module")
def stored(spark):
    path = work_path(spark, "store-test")
    store.write_daily(synthetic_events(spark, 40_000), path, "errorifexists", files=16)
    return path


def files_read(df):
    return {row[0] for row in df.selectExpr("input_file_name()").distinct().collect()}


def test_days_are_directories(spark, stored):
    days = store.day_directories(spark, stored)
    assert sorted(days) == [dt.date(2026, 9, 26) + dt.timedelta(days=i) for i in range(7)]
    assert store.read_store(spark, stored).count() == 40_000


def test_range_reads_one_day(spark, stored):
    hour = time_range(store.read_store(spark, stored), "2026-10-02 14:00:00", "2026-10-02 15:00:00")
    assert all("event_date=2026-10-02" in path for path in files_read(hour))
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "GreaterThanOrEqual(ts_ms" in plan


def rows_scanned(df):
    """Rows the scan of an executed plan put out, before any filter."""
    df.collect()
    scans, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            scans.append(node.metrics().apply("numOutputRows").value())
        left += [node.children().apply(i) for i in range(node.children().size())]
    return sum(scans)


def test_row_groups_outside_the_hour_are_skipped(spark, events_of):
    rows = [event(i, dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=1234 * i), message=f"{i * 7919 % 100_003} " * 40) for i in range(20_000)]
    path = store.write_daily(events_of(rows), work_path(spark, "groups"), "errorifexists", files=1, row_group_bytes=200_000)
    hour = analytics.window_events(store.read_store(spark, path), "a-service", "2024-01-01 03:00:00", "2024-01-01 03:10:00")
    assert len(hour.collect()) == 486
    assert rows_scanned(hour) < 5_000


def test_bounds_finer_than_a_millisecond_keep_their_rows(spark, events_of):
    path = store.write_daily(events_of([event(i, f"2024-01-01 00:00:00.00{i}") for i in range(5)]), work_path(spark, "fine"), "errorifexists")
    table = store.read_store(spark, path)
    assert rows_of(time_range(table, "2024-01-01 00:00:00.000500", "2024-01-01 00:00:00.003500"), "id") == [(1,), (2,), (3,)]
    assert rows_of(time_range(table, "2024-01-01 00:00:00.001", "2024-01-01 00:00:00.003"), "id") == [(1,), (2,)]


def test_lookup_reads_only_its_columns(spark, stored):
    rate = analytics.error_rate(store.read_store(spark, stored), "payment-service", "2026-10-02", "2026-10-03")
    plan = rate._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<service:string,level:string,ts:timestamp_ntz,ts_ms:bigint>" in plan
    assert "EqualTo(service,payment-service)" in plan


def test_files_hold_short_stretches(spark, stored):
    """Files of a day do not overlap in (service, ts), so their minima and maxima tell them apart."""
    spans = (
        store.read_store(spark, stored)
        .selectExpr("input_file_name() f", "event_date", "struct(service, ts, id) k")
        .groupBy("f", "event_date")
        .agg({"k": "min"})
        .toDF("f", "event_date", "lo")
    )
    spans.createOrReplaceTempView("spans")
    highs = (
        store.read_store(spark, stored)
        .selectExpr("input_file_name() f", "struct(service, ts, id) k")
        .groupBy("f")
        .agg({"k": "max"})
        .toDF("f", "hi")
    )
    rows = spans.join(highs, "f").collect()
    for day in {r.event_date for r in rows}:
        ordered = sorted((r.lo, r.hi) for r in rows if r.event_date == day)
        assert all(ordered[i][1] < ordered[i + 1][0] for i in range(len(ordered) - 1))


def test_a_day_with_most_rows_is_spread_over_tasks(spark, events_of):
    rows = [event(i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(4000)]
    rows += [event(10_000 + i, f"2024-01-{2 + i:02d}") for i in range(10)]
    path = store.write_daily(events_of(rows), work_path(spark, "hot-day"), "errorifexists", files=8)
    hot = store.read_store(spark, path).filter("event_date = DATE '2024-01-01'")
    sizes = [r["count"] for r in hot.selectExpr("input_file_name() f").groupBy("f").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1500


def test_overwrite_replaces_and_append_adds(spark, events_of):
    path = work_path(spark, "modes")
    store.write_daily(events_of([event(1)]), path, "overwrite")
    store.append_batch(events_of([event(2, "2024-01-05")]), path)
    assert rows_of(store.read_store(spark, path), "id") == [(1,), (2,)]
    store.write_daily(events_of([event(3)]), path, "overwrite")
    assert rows_of(store.read_store(spark, path), "id", "event_date") == [(3, dt.date(2024, 1, 1))]


def test_flat_copy_is_made_once(spark, stored):
    path = work_path(spark, "flat-test")
    events = store.read_store(spark, stored)
    assert store.write_flat(events, path)
    assert not store.write_flat(events, path)
    check = audit.copy_check(events, store.read_flat(spark, path)).first()
    assert check.same_count and check.same_content and check.events_count == 40_000
    assert store.write_flat(time_range(events, "2026-10-01"), path)


def test_copy_check_sees_changes_that_keep_the_count(events_of):
    original = events_of([event(1), event(2)])
    other = audit.copy_check(original, events_of([event(1), event(1)])).first()
    assert other.same_count and not other.same_content
    empty = original.limit(0)
    assert audit.copy_check(empty, empty).first().same_content


def test_repeated_append_adds_nothing(spark, events_of):
    path = work_path(spark, "idem-test")
    trace = "AB" * 18
    batch = events_of(
        [event(5, trace=trace), event(4, trace=trace.lower()), event(6, "2024-01-01 00:00:01", trace=trace), event(7, "2024-01-03")]
    )
    store.append_new(batch, path)
    store.append_new(batch, path)
    late = events_of([event(9, trace=trace), event(8, "2024-01-02", trace=trace)])
    store.append_new(late, path)
    assert rows_of(store.read_store(spark, path), "id", "trace_id") == [
        (4, trace.lower()),
        (6, trace.lower()),
        (7, f"{7:036d}"),
        (8, trace.lower()),
    ]


def test_only_touched_days_are_looked_up(spark, stored):
    known = store.read_store(spark, stored)
    batch = time_range(known, "2026-10-01", "2026-10-01 01:00:00").drop("event_date")
    fresh = store.new_rows(batch, known)
    assert fresh.count() == 0
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "event_date#" in plan.split("PartitionFilters: [")[-1]
    assert "GreaterThanOrEqual(ts_ms" in plan and store.new_rows(batch.limit(0), known).count() == 0


def test_days_between_are_left_out_without_a_list(spark, stored, events_of):
    known = store.read_store(spark, stored)
    assert store.new_rows(known.drop("event_date", "ts_ms"), known).count() == 0
    older = events_of([event(1, "1969-12-31 23:59:59.999"), event(2, "2030-01-01")])
    assert store.touched_rows(older, known).count() == 0 and store.new_rows(older, known).count() == 2


def test_every_write_normalizes(spark, events_of):
    path = work_path(spark, "normalized")
    odd = events_of([event(1, "2024-01-01 00:00:00.123456", trace="AB" * 18)])
    store.append_batch(odd, path)
    store.append_new(odd, path)
    assert rows_of(store.read_store(spark, path), "trace_id", "ts") == [("ab" * 18, at("2024-01-01 00:00:00.123"))]


def test_trace_alone_is_a_duplicate_on_any_day(spark, events_of):
    path = work_path(spark, "trace-alone")
    traces.append_once(events_of([event(1, trace="ab" * 18)]), path)
    traces.append_once(events_of([event(2, "2025-05-05", trace="AB" * 18), event(3, "2025-05-06"), event(4, "2025-05-05", trace=f"{3:036d}")]), path)
    assert rows_of(store.read_store(spark, path), "id") == [(1,), (4,)]


def test_compaction_keeps_rows_and_lessens_files(spark, events_of):
    path, day = work_path(spark, "compacted"), dt.date(2024, 1, 1)
    for i in range(5):
        store.append_batch(events_of([event(10 * i + j, f"2024-01-0{1 + j % 2} 00:00:0{i}") for j in range(4)]), path)
    before = rows_of(store.read_store(spark, path))
    store.compact_day(spark, path, day, files=1)
    assert rows_of(store.read_store(spark, path)) == before
    files = store.folder_names(spark, f"{path}/event_date=2024-01-01")
    assert sum(name.endswith(".parquet") and not name.startswith(".") for name in files) == 1
    assert len(store.folder_names(spark, f"{path}/event_date=2024-01-02")) >= 5


def test_a_day_ahead_of_the_clock_stops_retention(spark, events_of):
    path = store.write_daily(events_of([event(i, f"2024-01-0{i}") for i in range(1, 10)] + [event(99, "2099-01-01")]), work_path(spark, "ahead"), "errorifexists")
    with pytest.raises(ValueError, match="2099-01-01"):
        store.retain_days(spark, path, 7)
    assert store.read_store(spark, path).count() == 10
    assert store.expired_days(spark, path, 7, dt.date(2099, 1, 1))[-1] == dt.date(2024, 1, 9)


def test_level_order_scans_fewer_rows(spark):
    events = synthetic_events(spark, 60_000)
    paths = [store.write_daily(events, work_path(spark, "order"), "errorifexists", files=4, row_group_bytes=100_000, order=o) for o in (store.TIME_ORDER, store.LEVEL_ORDER)]
    lookups = [analytics.error_lookup(store.read_store(spark, p), "auth-service", "2026-10-01", "2026-10-02") for p in paths]
    assert lookups[0].collect() == lookups[1].collect()
    by_time, by_level = (rows_scanned(df) for df in lookups)
    assert by_level < by_time


@pytest.fixture
def batches(spark, events_of):
    """A day that thirty small appends have left, out of order, and another day."""
    path = work_path(spark, "small-batches")
    for i in range(6):
        rows = [event(100 * i + j, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=(j * 37 + i) % 1440), service=f"s{j % 4}") for j in range(100)]
        store.append_batch(events_of(rows), path)
    store.append_batch(events_of([event(9999, "2024-01-02")]), path)
    return path


def test_compaction_gives_as_many_files_as_asked_and_no_overlap(spark, batches):
    day = dt.date(2024, 1, 1)
    before = rows_of(store.read_store(spark, batches), "id", "ts", "ts_ms", "event_date")
    store.compact_day(spark, batches, day, files=8)
    table = store.read_store(spark, batches)
    assert rows_of(table, "id", "ts", "ts_ms", "event_date") == before
    spans = table.filter("id < 9999").selectExpr("input_file_name() f", "struct(service, ts, id) k").groupBy("f").agg({"k": "min"}).collect()
    highs = dict(tuple(r) for r in table.filter("id < 9999").selectExpr("input_file_name() f", "struct(service, ts, id) k").groupBy("f").agg({"k": "max"}).collect())
    ordered = sorted((r[1], highs[r[0]]) for r in spans)
    assert len(ordered) == 8 and all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


def test_rows_that_come_during_a_compaction_stay(spark, events_of, batches, monkeypatch):
    plain = store.write_text

    def interrupted(*args):
        store.append_batch(events_of([event(5000, "2024-01-01 05:00:00")]), batches)
        plain(*args)

    monkeypatch.setattr(store, "write_text", interrupted)
    store.compact_day(spark, batches, dt.date(2024, 1, 1), files=2)
    assert store.read_store(spark, batches).count() == 602 and store.read_store(spark, batches).filter("id = 5000").count() == 1


@pytest.mark.parametrize("step", ["move", "delete_folders"])
def test_a_compaction_that_broke_off_is_finished(spark, batches, monkeypatch, step):
    before = rows_of(store.read_store(spark, batches), "id")
    plain, calls = getattr(store, step), []

    def broken(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        plain(*args)

    with monkeypatch.context() as patch:
        patch.setattr(store, step, broken)
        with pytest.raises(OSError):
            store.compact_day(spark, batches, dt.date(2024, 1, 1), files=4)
    assert {r[0] for r in rows_of(store.read_store(spark, batches), "id")} == {r[0] for r in before}
    assert store.finish_compaction(spark, batches) and rows_of(store.read_store(spark, batches), "id") == before
    assert not store.finish_compaction(spark, batches)


def test_loose_names_are_looked_up_exactly(spark, events_of):
    start = dt.datetime(2024, 1, 1)
    spelled = ["payment", "Payment ", "pàyment", "zebra", "auth"]
    rows = [event(i, start + dt.timedelta(seconds=i), service=spelled[i % 5] if i % 5 < 3 and i < 100 else spelled[3 + i % 2]) for i in range(20_000)]
    path = store.write_daily(events_of(rows), work_path(spark, "loose"), "errorifexists", files=1)
    assert names.spellings(spark, path, "PAYMENT") == ["Payment ", "payment", "pàyment"]
    found = analytics.of_service(store.read_store(spark, path), names.spellings(spark, path, "PAYMENT"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(service, [" in plan and "collate" not in plan
    assert found.count() == 60 and rows_scanned(found) < 20_000
    # Only a day whose files have changed is read again.
    kept = store.folder_names(spark, f"{path}.services/event_date=2024-01-01")
    store.append_batch(events_of([event(30_000, "2024-01-05", service="PÂYMENT")]), path)
    assert names.spellings(spark, path, "payment ") == ["Payment ", "PÂYMENT", "payment", "pàyment"]
    assert names.spellings(spark, path, "payment", dt.date(2024, 1, 2)) == ["PÂYMENT"]
    assert store.folder_names(spark, f"{path}.services/event_date=2024-01-01") == kept
    assert names.spellings(spark, work_path_of(spark), "x") == []


def work_path_of(spark):
    path = work_path(spark, "nothing")
    spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(path))
    return path


def test_retention_drops_whole_days(spark, stored):
    path = store.write_daily(store.read_store(spark, stored), work_path(spark, "retain-test"), "errorifexists")
    kept = store.retain_days(spark, path, 2)
    assert sorted(store.day_directories(spark, path)) == [dt.date(2026, 9, 30), dt.date(2026, 10, 1), dt.date(2026, 10, 2)]
    assert kept.agg({"ts": "min"}).first()[0] >= at("2026-09-30")
    assert store.latest_stored(spark, path) == store.latest_stored(spark, stored)


def test_overflow_names_the_missing_partition(events_of):
    df = events_of([event(1, "2026-10-11 23:59:59"), event(2, "2026-10-12"), event(3, "2026-10-12 05:00:00"), event(4, "2026-09-01")])
    got = audit.overflow_dates(df, dt.date(2026, 9, 26), dt.date(2026, 10, 11))
    assert rows_of(got) == [
        ("2026-09-01", 1, "before", "p20260901", "2026-09-02"),
        ("2026-10-12", 2, "after", "p20261012", "2026-10-13"),
    ]


def test_bloom_filter_is_written(spark, events_of):
    def size(bloom):
        path = work_path(spark, "bloom")
        store.write_daily(events_of([event(i) for i in range(100)]), path, "errorifexists", files=1, row_group_bytes=1 << 20, trace_bloom=bloom)
        assert store.read_store(spark, path).filter(f"trace_id = '{7:036d}'").count() == 1
        return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(
            spark._jvm.org.apache.hadoop.fs.Path(path)
        ).getLength()

    # The filter is of a fixed size, by default one megabyte at most.
    assert size(True) > size(False) + 10_000


class FakeSession:
    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})


def test_work_root_is_the_shared_folder_or_local_in_tests():
    assert work_root(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert work_root(FakeSession("local[2]")).endswith("faultline-app-1")
    with pytest.raises(RuntimeError):
        work_root(FakeSession("yarn"))
