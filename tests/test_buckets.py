"""State in hash buckets: what batches read, repeat and merge, and message counters built on it."""

import datetime as dt
import json
import os

import pytest

from faultline.session import work_path
from faultline.sources.buckets import KEEP, BucketTable
from faultline.streaming import ingest, jobs
from tests.conftest import rows_of


@pytest.fixture
def table(spark):
    return BucketTable(work_path(spark, "bucket-table"), "name string, n bigint", "name", buckets=8)


def frame(spark, **values):
    return spark.createDataFrame(list(values.items()), "name string, n bigint")


def state(spark, table, before, touched=range(8)):
    return dict(rows_of(table.read(spark, touched, before), "name", "n"))


def test_the_newest_row_of_each_key(spark, table):
    assert state(spark, table, 5) == {} and table.touched(frame(spark)) == []
    table.write(frame(spark, a=1, b=1, c=1), 0)
    table.write(frame(spark, a=2, d=1), 3)
    assert state(spark, table, 0) == {} and state(spark, table, 3) == {"a": 1, "b": 1, "c": 1}
    assert state(spark, table, 4) == {"a": 2, "b": 1, "c": 1, "d": 1}


def test_a_batch_again_changes_nothing(spark, table):
    table.write(frame(spark, a=1), 0)
    for _ in range(2):
        n = state(spark, table, 1).get("a", 0)
        table.write(frame(spark, a=n + 1), 1)
    assert state(spark, table, 2) == {"a": 2}


def test_only_touched_buckets_are_read(spark, table):
    table.write(spark.range(200).selectExpr("cast(id as string) name", "id n"), 0)
    few = frame(spark, **{"7": 0, "8": 0})
    touched = table.touched(few)
    assert 1 <= len(touched) <= 2
    read = table.read(spark, touched, 1)
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in read.inputFiles()} == set(touched)
    assert 2 <= read.count() < 100 and {"7", "8"} <= set(state(spark, table, 1, touched))


def test_merging_keeps_the_state(spark, table):
    for batch in range(5):
        table.write(frame(spark, **{"a": batch, f"x{batch}": 1}), batch)
    before = state(spark, table, 5)
    full = table.merge(spark, 4, range(8), after=3)
    assert table.touched(frame(spark, a=0))[0] in full
    assert state(spark, table, 5) == before and state(spark, table, 3)["a"] == 2
    table.write(frame(spark, a=9), 5)
    assert state(spark, table, 6) == before | {"a": 9}
    versions = table.versions(spark)[full[0]]
    assert versions[-1] in (9, 10) and 9 in versions
    # What no batch can ask for any more is removed, the base and what follows it stay.
    table.merge(spark, 5 + KEEP, range(8))
    assert min(table.versions(spark)[full[0]]) == 9 and state(spark, table, 6) == before | {"a": 9}


def test_another_number_of_buckets_is_refused(spark, table):
    table.write(frame(spark, a=1), 0)
    with pytest.raises(ValueError):
        BucketTable(table.path, table.schema, table.key, 16).versions(spark)


def test_receives_on_three_days_make_one_letter(spark):
    """One message a day, read in three batches, and one that has no time."""
    path, sinks = work_path(spark, "days"), ingest.Sinks(work_path(spark, "days-sinks"))
    os.makedirs(path)
    for batch in range(4):
        with open(f"{path}/{batch}.json", "w") as out:
            for name, sent in (("m1", f"2024-01-{1 + 9 * batch:02d}T00:00:00"), ("m2", None), ("m3", "2024-01-01T00:00:00")):
                if (name, batch) != ("m3", 3) and name != "m3" or batch < 2:
                    out.write(json.dumps({"message_id": name, "sent_at": sent, "body": "no json", "receive": batch + 1}) + "\n")
        os.utime(f"{path}/{batch}.json", (1_000_000 + batch, 1_000_000 + batch))
    ingest.ingest(jobs.message_stream(spark, path, max_files=1), sinks)
    assert rows_of(ingest.read_dead_letters(spark, sinks), "message_id", "receives", "batch") == [("m1", 3, 2), ("m2", 3, 2)]
    assert dict(rows_of(sinks.receives.read(spark, range(64), 4), "message_id", "receives")) == {"m1": 4, "m2": 4, "m3": 2}
    again = spark.read.schema(jobs.MESSAGE_SCHEMA).json(f"{path}/2.json")
    ingest.ingest_batch(again, 2, sinks)
    assert rows_of(ingest.read_dead_letters(spark, sinks), "message_id", "receives", "batch") == [("m1", 3, 2), ("m2", 3, 2)]
