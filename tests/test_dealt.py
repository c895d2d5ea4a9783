"""Events of one row group are dealt to several tasks before anything is made of them."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from faultline.plans import registry
from faultline.session import work_path
from faultline.sources import driver_events, store
from faultline.streaming import ingest

ROWS = 4096


@pytest.fixture
def one_group(spark, monkeypatch):
    """A folder of input whose events are one row group, and the folder the queries work in."""
    monkeypatch.setattr(registry, "SPREAD_BYTES", 1 << 13, raising=False)
    root = work_path(spark, "dealt")
    monkeypatch.setattr(registry, "work_path", lambda spark, name: f"{root}/{name}")
    kinds = ("error", "view", "signup", "purchase")
    rows = [(i, dt.datetime(2024, 1, 9) + dt.timedelta(seconds=200 * i), i % 50, kinds[i % 4], i % 90 + 0.5, '{"k": 1}') for i in range(ROWS)]
    spark.createDataFrame(rows, driver_events.RAW_SCHEMA).coalesce(1).write.parquet(f"{root}/in/events.parquet")
    return f"{root}/in", root


def rows_by_task(df):
    return [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]


def test_stream_ingest_makes_messages_in_several_tasks(spark, one_group, monkeypatch):
    path, _ = one_group
    seen, archive = [], ingest.archive_raw

    def archive_raw(messages, *rest):
        seen.append(rows_by_task(messages))
        archive(messages, *rest)

    monkeypatch.setattr(ingest, "archive_raw", archive_raw)
    assert registry.queries()["stream_ingest"](spark, path).count() == ROWS * 10 // 16
    (tasks,) = seen
    assert sum(tasks) == ROWS * 5 // 2 and max(tasks) <= sum(tasks) // 4


def landed_share(path):
    """Files of a landing folder, and their bytes for each message."""
    files = [f"{path}/{name}" for name in os.listdir(path) if name.startswith("part-")]
    return len(files), sum(map(os.path.getsize, files)) / (ROWS * 5 // 2)


def test_landed_lines_come_in_several_compressed_files(spark, one_group):
    path, root = one_group
    assert registry.queries()["landed_dead_letter"](spark, path).count() > 0
    files, bytes_each = landed_share(f"{root}/landing")
    assert files >= 4 and bytes_each < 150


def test_receives_come_in_several_compressed_files(spark, one_group):
    path, root = one_group
    assert registry.queries()["stream_dead_letter_days"](spark, path).count() > 0
    files, bytes_each = landed_share(f"{root}/receives-landing")
    assert files >= 8 and bytes_each < 150


@pytest.mark.parametrize("name", ["p95_from_rollup_range", "append_events", "layout_daily"])
def test_stores_are_written_from_dealt_events(spark, one_group, monkeypatch, name):
    path, _ = one_group
    seen, write_daily = [], store.write_daily

    def recorded(events, *rest, **named):
        seen.append(rows_by_task(events))
        return write_daily(events, *rest, **named)

    monkeypatch.setattr(store, "write_daily", recorded)
    assert registry.queries()[name](spark, path).count() > 0
    assert sum(map(sum, seen)) == ROWS and all(max(tasks) <= sum(tasks) // 2 for tasks in seen)
