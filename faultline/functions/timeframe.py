"""Time ranges and buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Moment = dt.datetime | str


def moment(value: Moment) -> dt.datetime:
    return dt.datetime.fromisoformat(value) if isinstance(value, str) else value


def ntz(value: Moment) -> Column:
    """A literal without zone; a plain datetime literal would force a cast onto the column."""
    return F.lit(moment(value).isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_ms(value: Moment) -> int:
    """Milliseconds since 1970, rounded down."""
    return (moment(value) - dt.datetime(1970, 1, 1)) // dt.timedelta(milliseconds=1)


def time_range(df: DataFrame, lo: Moment | None = None, hi: Moment | None = None, column: str = "ts") -> DataFrame:
    """Rows with lo <= ts < hi; either bound may be open.

    A filter on ts alone prunes neither day directories nor row groups, so on a stored table the same
    range is put on event_date and, rounded outwards, on ts_ms too.
    """
    stored = {"event_date", "ts_ms"} <= set(df.columns)
    if lo is not None:
        df = df.filter(F.col(column) >= ntz(lo))
        if stored:
            df = df.filter((F.col("event_date") >= F.lit(moment(lo).date())) & (F.col("ts_ms") >= epoch_ms(lo)))
    if hi is not None:
        df = df.filter(F.col(column) < ntz(hi))
        if stored:
            last = moment(hi) - dt.timedelta(microseconds=1)
            df = df.filter((F.col("event_date") <= F.lit(last.date())) & (F.col("ts_ms") <= epoch_ms(last)))
    return df


def bucket(length: str, column: str = "ts") -> Column:
    """Start of the epoch-aligned bucket of the given length."""
    return F.window(column, length).getField("start")


def latest(events: DataFrame) -> dt.datetime | None:
    """The newest event time, by one pass over the column. For a store, store.latest_stored reads only its newest day."""
    return events.agg(F.max("ts")).first()[0]
