"""Appends that store a trace once, whatever its times, without reading the store.

Beside a store stands a table of its trace ids in hash buckets. A batch is joined with the buckets its traces fall in. An append writes events first and
their traces after that. Between the two a note says which days the append was about; an append that finds a note of one that broke off reads those days, and no others, and completes the table. There is one writer at a time, as for the store.

Traces of days that retention has dropped are forgotten with them. Rows appended by other means than append_once are made known by rebuild().
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.contract import EVENT_COLUMNS, normalized
from faultline.functions.ranking import first_of_each
from faultline.sources.buckets import BUCKETS, BucketTable
from faultline.sources.files import delete_folders, folder_names, move, path_exists
from faultline.sources.store import append_batch, day_directories, read_store

NOTE_SCHEMA = "first date, last date"


def trace_table(path: str, buckets: int = BUCKETS) -> BucketTable:
    return BucketTable(f"{path.rstrip('/')}.traces", "trace_id string, event_date date", "trace_id", buckets)


def _note(path: str) -> str:
    return f"{path.rstrip('/')}.appending"


def _traces(events: DataFrame) -> DataFrame:
    return events.select(F.lower("trace_id").alias("trace_id"), F.to_date("ts").alias("event_date"))


def known_traces(spark: SparkSession, path: str, touched: Sequence[int], buckets: int = BUCKETS) -> DataFrame:
    """The traces of these buckets whose day is still stored: trace_id, bucket."""
    table = trace_table(path, buckets)
    found = table.read_all(spark, touched, _next_batch(spark, table))
    stored = day_directories(spark, path) if path_exists(spark, path) else ()
    kept = F.col("event_date") >= F.lit(min(stored)) if stored else F.lit(False)
    return found.filter(kept).select("trace_id", "bucket")


def _next_batch(spark: SparkSession, table: BucketTable) -> int:
    """One more than the newest batch; appends are numbered as they come."""
    return max((versions[-1] // 2 for versions in table.versions(spark).values()), default=-1) + 1


def _add(spark: SparkSession, path: str, traces: DataFrame, buckets: int) -> None:
    """Traces that are not known yet, each once."""
    table = trace_table(path, buckets)
    once = first_of_each(traces, ["trace_id"], ["event_date"]).withColumn("bucket", table.bucket())
    known = known_traces(spark, path, table.touched(once), buckets)
    table.write(once.join(known, ["bucket", "trace_id"], "left_anti"), _next_batch(spark, table))


def rebuild(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """Make known the traces that are stored, and no others. The table is there whole or not at all."""
    table = trace_table(path, buckets)
    made = replace(table, path=f"{table.path}.new")
    delete_folders(spark, [made.path])
    made.write(first_of_each(_traces(read_store(spark, path)), ["trace_id"], ["event_date"]), 0)
    delete_folders(spark, [table.path])
    if path_exists(spark, made.path):
        move(spark, made.path, table.path)


def _days_between(spark: SparkSession, path: str, first: dt.date, last: dt.date) -> DataFrame:
    return read_store(spark, path).filter(F.col("event_date").between(F.lit(first), F.lit(last)))


def _complete(spark: SparkSession, path: str, buckets: int) -> None:
    """Finish what an append that broke off has left: its events may be stored and its traces not known."""
    if not path_exists(spark, path):
        # What is known belonged to another store.
        delete_folders(spark, [trace_table(path).path, _note(path)])
        return
    if not path_exists(spark, trace_table(path).path):
        rebuild(spark, path, buckets)
    if path_exists(spark, _note(path)):
        if "_SUCCESS" in folder_names(spark, _note(path)):
            days = spark.read.schema(NOTE_SCHEMA).parquet(_note(path)).first()
            if days is not None and days["first"] is not None:
                _add(spark, path, _traces(_days_between(spark, path, days["first"], days["last"])), buckets)
        delete_folders(spark, [_note(path)])


def append_once(batch: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Append the first event of each trace that is not stored yet. buckets: of the table of traces, the same for all appends to a store."""
    spark, table = batch.sparkSession, trace_table(path, buckets)
    _complete(spark, path, buckets)
    first = first_of_each(normalized(batch), ["trace_id"], ["ts", "id"]).withColumn("bucket", table.bucket())
    touched = table.touched(normalized(batch.select("trace_id", "ts")))
    fresh = first.join(known_traces(spark, path, touched, buckets), ["bucket", "trace_id"], "left_anti")
    fresh = fresh.select(*EVENT_COLUMNS).persist(StorageLevel.DISK_ONLY)
    try:
        days = fresh.agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last"))
        days.write.mode("overwrite").parquet(_note(path))
        append_batch(fresh, path)
        table.write(_traces(fresh), _next_batch(spark, table))
        delete_folders(spark, [_note(path)])
    finally:
        fresh.unpersist()


def compact(spark: SparkSession, path: str, buckets: int = BUCKETS) -> list[int]:
    """Merge what many appends have left in each bucket into one file; a job for quiet hours."""
    table = trace_table(path, buckets)
    batch = _next_batch(spark, table)
    merged = table.merge(spark, batch, sorted(table.versions(spark)), after=2)
    versions = table.versions(spark)
    # Appends are not delivered again by number, so nothing older is asked for.
    delete_folders(spark, [f"{table.root}/bucket={b}/version={v}" for b in merged for v in versions[b] if v < 2 * batch])
    return merged
