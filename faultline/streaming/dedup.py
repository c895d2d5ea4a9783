"""Duplicates on a stream: combined within a batch, then looked up among the keys seen before, which expire.

Copies in one batch are reduced to one row per map task and key before they meet, so a trace with a third of all rows sends a few.
What was seen before stands in hash buckets by key (sources/buckets), one row a key, and a batch reads the buckets of its keys. A key is forgotten when event time has
moved on by the delay: until then a copy is dropped, later it may pass, as with Spark's own duplicates within a watermark. Each batch owns
its folder of the output, so a batch that is delivered again changes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.contract import EVENT_COLUMNS, EVENT_SCHEMA, normalized
from faultline.functions.ranking import first_of_each
from faultline.sources.buckets import BucketTable
from faultline.streaming.jobs import run_available

TRACE_TS = ("trace_id", "ts")
TRACE = ("trace_id",)


def seen_table(path: str) -> BucketTable:
    """Keys by which events were kept, and their event time in milliseconds."""
    return BucketTable(f"{path}/seen", "key string, at_ms bigint", "key")


def _keyed(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    parts = [F.col(k) if k != "ts" else F.unix_millis(F.col("ts").cast("timestamp")).cast("string") for k in keys]
    return events.withColumns({"key": F.concat_ws("|", *parts), "at_ms": F.unix_millis(F.col("ts").cast("timestamp"))})


def dedup_batch(batch: DataFrame, batch_id: int, path: str, delay: dt.timedelta, keys: Sequence[str] = TRACE_TS) -> None:
    """Write the events of a batch that are no copies to <path>/events/batch=<id>."""
    spark, table, wait = batch.sparkSession, seen_table(path), delay // dt.timedelta(milliseconds=1)
    once = _keyed(first_of_each(normalized(batch.select(*EVENT_COLUMNS)), list(keys), [c for c in ("ts", "id") if c not in keys]), keys).persist()
    try:
        touched = table.touched(once)
        if not touched:
            return
        seen = table.read(spark, touched, batch_id).withColumnRenamed("at_ms", "_seen_ms")
        fresh = once.withColumn("bucket", table.bucket()).join(seen, ["bucket", "key"], "left")
        fresh = fresh.filter(F.col("_seen_ms").isNull() | (F.col("at_ms") > F.col("_seen_ms") + wait))
        table.write(fresh.select("key", "at_ms"), batch_id)
        fresh.select(*EVENT_COLUMNS).write.mode("overwrite").parquet(f"{path}/events/batch={batch_id}")
        newest = once.agg(F.max("at_ms")).first()[0]
        table.merge(spark, batch_id, touched, keep=F.col("at_ms") >= newest - wait)
    finally:
        once.unpersist()


def dedup(events: DataFrame, path: str, delay: dt.timedelta, keys: Sequence[str] = TRACE_TS, parts: int | None = None) -> DataFrame:
    """Run over all waiting events and read back what has been kept so far. keys: (trace_id, ts), or trace_id alone whatever the times."""
    writer = events.writeStream.foreachBatch(lambda batch, batch_id: dedup_batch(batch, batch_id, path, delay, keys))
    run_available(events.sparkSession, writer, f"{path}/checkpoint", parts)
    return read_kept(events.sparkSession, path)


def read_kept(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(f"{path}/events").select(*EVENT_COLUMNS)
