"""Appends by trace alone: what is read, and what an append that broke off leaves."""

import datetime as dt

import pytest

from faultline.session import work_path
from faultline.sources import store, traces
from tests.conftest import event, rows_of


def trace(i):
    return f"{i:036d}"


@pytest.fixture
def filled(spark, events_of):
    path = work_path(spark, "traces")
    traces.append_once(events_of([event(i, dt.datetime(2024, 1, 1 + i % 20)) for i in range(600)]), path)
    return path


def stored(spark, path):
    return rows_of(store.read_store(spark, path), "id")


def bucket_of(path):
    return int(path.split("bucket=")[1].split("/")[0])


def test_a_small_batch_reads_its_buckets_and_not_the_store(spark, events_of, filled):
    batch = events_of([event(1000, "2024-03-01", trace=trace(7)), event(1001, "2024-03-01", trace=trace(2000))])
    table = traces.trace_table(filled)
    touched = table.touched(batch)
    known = traces.known_traces(spark, filled, touched)
    assert {bucket_of(f) for f in known.inputFiles()} <= set(touched) and len(touched) == 2
    assert known.count() < 60  # of 600
    traces.append_once(batch, filled)
    assert stored(spark, filled) == sorted([(i,) for i in range(600)] + [(1001,)])
    assert sum(len(v) for v in table.versions(spark).values()) <= 64 + 2


def test_a_batch_again_adds_nothing(spark, events_of, filled):
    batch = events_of([event(700 + i, f"2025-01-{1 + i:02d}", trace=trace(5000 + i // 3).upper()) for i in range(9)])
    for _ in range(2):
        traces.append_once(batch, filled)
        assert stored(spark, filled) == [(i,) for i in range(600)] + [(700,), (703,), (706,)]


def test_an_append_that_broke_off_is_completed(spark, events_of, filled, monkeypatch):
    batch = events_of([event(900, "2024-02-02", trace=trace(9000)), event(901, "2024-02-03", trace=trace(9001))])
    with monkeypatch.context() as broken:
        broken.setattr(traces.BucketTable, "write", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            traces.append_once(batch, filled)
    assert (900,) in stored(spark, filled)
    assert traces.known_traces(spark, filled, range(64)).count() == 600
    traces.append_once(batch, filled)
    assert stored(spark, filled)[-2:] == [(900,), (901,)] and len(stored(spark, filled)) == 602
    assert traces.known_traces(spark, filled, range(64)).count() == 602


def test_a_store_without_its_table_is_read_once(spark, events_of):
    path = store.write_daily(events_of([event(1), event(2, "2024-01-05")]), work_path(spark, "plain"), "errorifexists")
    traces.append_once(events_of([event(3, "2024-02-01", trace=trace(2)), event(4, "2024-02-01")]), path)
    assert stored(spark, path) == [(1,), (2,), (4,)]


def test_dropped_days_are_forgotten(spark, events_of, filled):
    store.drop_days_before(spark, filled, dt.date(2024, 1, 10))
    traces.append_once(events_of([event(800, "2024-01-20", trace=trace(0)), event(801, "2024-01-20", trace=trace(19))]), filled)
    assert (800,) in stored(spark, filled) and (801,) not in stored(spark, filled)


def test_compaction_leaves_one_version(spark, events_of, filled):
    for i in range(2):
        traces.append_once(events_of([event(1000 + 300 * i + j, trace=trace(1000 + 300 * i + j)) for j in range(300)]), filled)
    before = rows_of(traces.known_traces(spark, filled, range(64)))
    assert traces.compact(spark, filled)
    assert rows_of(traces.known_traces(spark, filled, range(64))) == before and len(before) == 1200
    assert max(len(v) for v in traces.trace_table(filled).versions(spark).values()) == 1
    traces.append_once(events_of([event(5000, trace=trace(3)), event(5001, trace=trace(5001))]), filled)
    assert traces.known_traces(spark, filled, range(64)).count() == 1201
