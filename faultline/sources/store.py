"""The event store: Parquet in day directories, sorted by service and time."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.contract import EVENT_COLUMNS, EVENT_SCHEMA, STORED_SCHEMA, normalized, with_event_date
from faultline.functions.ranking import first_of_each
from faultline.sources.files import delete_folders, folder_names, move, path_exists, read_text, write_text


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_SCHEMA).parquet(path)


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EVENT_SCHEMA).parquet(path)


def _epoch_ms() -> Column:
    return F.expr("unix_millis(cast(ts AS timestamp))")


#: Rows of one page. A page has its own minima and maxima in the file's column index, so a short range reads some pages of a row group.
PAGE_ROWS = 1000
TIME_ORDER = ("service", "ts", "id")
#: For lookups of one level: its rows of a service stand together.
LEVEL_ORDER = ("service", "level", "ts", "id")


def clustered(events: DataFrame, files: int | None = None, order: Sequence[str] = TIME_ORDER) -> DataFrame:
    """Rows range-partitioned and sorted by day and `order`.

    Ranges are cut by sampled quantiles, so a day or a service with a third of all rows is spread over
    a third of the tasks, where hashing by day would give it to one. Each file then covers one short
    stretch of the order, which is what its minima and maxima are good for. `files` is the number of tasks, by
    default the session's shuffle partitions; a task should get about 512 MB.
    """
    keys = ["event_date", *order]
    dated = with_event_date(events).withColumn("ts_ms", _epoch_ms())
    ranged = dated.repartitionByRange(files, *keys) if files else dated.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_daily(
    events: DataFrame,
    path: str,
    mode: str,
    files: int | None = None,
    row_group_bytes: int | None = None,
    trace_bloom: bool = False,
    order: Sequence[str] = TIME_ORDER,
) -> str:
    """Write day directories; mode is Spark's: overwrite replaces the table, append adds to it, errorifexists refuses.

    Rows are stored normalized, so that duplicates are found whichever way they came.
    trace_bloom adds a Bloom filter on trace_id for lookups that have no time range.
    """
    rows = normalized(events.select(*EVENT_COLUMNS))
    writer = clustered(rows, files, order).write.mode(mode).option("parquet.page.row.count.limit", PAGE_ROWS).partitionBy("event_date")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    if trace_bloom:
        writer = writer.option("parquet.bloom.filter.enabled#trace_id", "true")
    writer.parquet(path)
    return path


def append_batch(events: DataFrame, path: str) -> None:
    """One batch; its files become visible together when the job commits."""
    write_daily(events, path, mode="append")


def compact_day(spark: SparkSession, path: str, day: dt.date, files: int | None = None) -> None:
    """Rewrite a day's files, as many small batches leave them, as `files` clustered ones whose ranges do not overlap.

    The rows are written beside the store first. Then a note is left of the files that were read and of those that replace them, and what it says is
    done: files are moved in, and the old ones removed. Files that others add meanwhile are in no note and stay. A run that fails before the note changes
    nothing; one that fails after it leaves the rest to the next compaction, or to finish_compaction, and until then the day may have rows twice.
    """
    finish_compaction(spark, path)
    folder = f"{path}/event_date={day.isoformat()}"
    old = [name for name in folder_names(spark, folder) if name.endswith(".parquet")] if path_exists(spark, folder) else []
    if not old:
        return
    rows = spark.read.schema(EVENT_SCHEMA).parquet(*[f"{folder}/{name}" for name in old])
    staged = f"{_compacting(path)}/{uuid.uuid4().hex}"
    # All rows are of one day, so a task writes one file.
    clustered(rows, files).drop("event_date").write.option("parquet.page.row.count.limit", PAGE_ROWS).parquet(staged)
    new = [name for name in folder_names(spark, staged) if name.endswith(".parquet")]
    write_text(spark, f"{_compacting(path)}/note", json.dumps({"folder": folder, "staged": staged, "old": old, "new": new}))
    finish_compaction(spark, path)


def _compacting(path: str) -> str:
    return f"{path.rstrip('/')}.compacting"


def finish_compaction(spark: SparkSession, path: str) -> bool:
    """Do what the note of a compaction still leaves to do; whether there was one."""
    note = f"{_compacting(path)}/note"
    found = path_exists(spark, note)
    if found:
        plan = json.loads(read_text(spark, note))
        waiting = set(folder_names(spark, plan["staged"])) if path_exists(spark, plan["staged"]) else set()
        for name in plan["new"]:
            if name in waiting:
                move(spark, f"{plan['staged']}/{name}", f"{plan['folder']}/{name}")
        delete_folders(spark, [f"{plan['folder']}/{name}" for name in plan["old"]])
    # What has no note was given up.
    delete_folders(spark, [_compacting(path)])
    return found


def write_flat(events: DataFrame, path: str) -> bool:
    """Copy to an undivided table, unless the copy is there with the same number of rows."""
    spark = events.sparkSession
    if path_exists(spark, path) and read_flat(spark, path).count() == events.count():
        return False
    events.select(*EVENT_COLUMNS).write.mode("overwrite").parquet(path)
    return True


def touched_rows(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The stored rows of the days a batch has events on, within the batch's span of time.

    The span is read first, as one row, so that it is a literal and prunes folders and row groups; days between that
    the batch does not have are left out by a join with its days.
    """
    times = batch.select(F.to_date("ts").alias("event_date"), _epoch_ms().alias("ms"))
    first, last, lo, hi = times.agg(F.min("event_date"), F.max("event_date"), F.min("ms"), F.max("ms")).first()
    near = stored.filter(F.col("event_date").between(F.lit(first), F.lit(last)) & F.col("ts_ms").between(F.lit(lo), F.lit(hi)))
    return near.join(times.select("event_date").distinct(), "event_date", "left_semi")


DUPLICATE_KEYS = ("trace_id", "ts")


def new_rows(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of the batch whose (trace_id, ts) is neither stored nor earlier in the batch; only the touched days are looked at."""
    keys = list(DUPLICATE_KEYS)
    fresh = first_of_each(normalized(batch), keys, ["id"])
    return fresh.join(touched_rows(normalized(batch), stored).select(*keys), keys, "left_anti").select(*EVENT_COLUMNS)


def append_new(batch: DataFrame, path: str) -> None:
    """Append a batch so that repeating it, or any event in it, adds nothing. For the rule of trace_id alone see traces.append_once."""
    spark = batch.sparkSession
    if path_exists(spark, path):
        batch = new_rows(batch, read_store(spark, path))
    else:
        batch = first_of_each(normalized(batch), list(DUPLICATE_KEYS), ["id"])
    append_batch(batch, path)


def day_directories(spark: SparkSession, path: str) -> dict[dt.date, str]:
    """The stored days by one listing of the table's folder; no file is opened."""
    days = (re.fullmatch(r"event_date=(\d{4}-\d{2}-\d{2})", name) for name in folder_names(spark, path))
    return {dt.date.fromisoformat(day[1]): f"{path}/{day[0]}" for day in days if day}


def latest_stored(spark: SparkSession, path: str) -> dt.datetime | None:
    """The newest event time, read from the newest day only."""
    days = day_directories(spark, path)
    if not days:
        return None
    return read_store(spark, path).filter(F.col("event_date") == F.lit(max(days))).agg(F.max("ts")).first()[0]


def drop_days_before(spark: SparkSession, path: str, first_kept: dt.date) -> list[dt.date]:
    """Remove the day directories older than first_kept; no file of a kept day is touched."""
    expired = {day: folder for day, folder in day_directories(spark, path).items() if day < first_kept}
    delete_folders(spark, expired.values())
    return sorted(expired)


def expired_days(spark: SparkSession, path: str, days: int, as_of: dt.date | None = None) -> list[dt.date]:
    """The stored days more than `days` before the newest one, which retain_days would remove.

    A day after as_of (today by default) is an event with a wrong clock. Counted from it, everything else would have
    expired, so it is an error.
    """
    stored = sorted(day_directories(spark, path))
    limit = as_of or dt.datetime.now(dt.timezone.utc).date()
    if late := [day.isoformat() for day in stored if day > limit]:
        raise ValueError(f"{path} has days after {limit}: {', '.join(late)}")
    return [day for day in stored if day < stored[-1] - dt.timedelta(days=days)]


def retain_days(spark: SparkSession, path: str, days: int, as_of: dt.date | None = None) -> DataFrame:
    """Drop every day more than `days` before the newest stored one and return what remains."""
    if expired := expired_days(spark, path, days, as_of):
        drop_days_before(spark, path, expired[-1] + dt.timedelta(days=1))
    return read_store(spark, path)
