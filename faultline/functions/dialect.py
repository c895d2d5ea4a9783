"""Functions of the reference's SQL that have another name or another meaning in Spark.

Event times carry no zone and are read as UTC, as the session is set.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: TO_DAYS('1970-01-01').
_DAYS_BEFORE_EPOCH = 719528


def unix_timestamp(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def from_unixtime(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def to_days(day: Column | str) -> Column:
    """Days since year 0, the value day partitions are bounded by."""
    return F.datediff(day, F.lit("1970-01-01").cast("date")) + _DAYS_BEFORE_EPOCH
