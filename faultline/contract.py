"""The log event contract: columns, types, allowed levels and length limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("trace_id", T.StringType(), False),
        T.StructField("service", T.StringType(), False),
        T.StructField("host", T.StringType(), False),
        T.StructField("level", T.StringType(), False),
        T.StructField("ts", T.TimestampNTZType(), False),
        T.StructField("message", T.StringType(), True),
        T.StructField("latency_ms", T.IntegerType(), True),
        T.StructField("endpoint", T.StringType(), True),
    ]
)
EVENT_COLUMNS = EVENT_SCHEMA.names

# As stored in day directories: the same columns, the time as epoch milliseconds and the partition column.
# Spark's Parquet reader skips row groups by numbers, but not by times without a zone.
STORED_SCHEMA = T.StructType(
    [
        *EVENT_SCHEMA.fields,
        T.StructField("ts_ms", T.LongType(), False),
        T.StructField("event_date", T.DateType(), False),
    ]
)

# Fixed values of the contract: levels in rank order, column lengths.
LEVELS = ("DEBUG", "INFO", "WARN", "ERROR")
TRACE_ID_LENGTH = 36
MAX_LENGTH = {"service": 64, "host": 64, "endpoint": 128}

# Opt-in comparison that ignores case, accents and trailing spaces.
LOOSE_COLLATION = "UNICODE_CI_AI_RTRIM"


def level_rank(level: Column | str) -> Column:
    """1 for DEBUG to 4 for ERROR; plain string order would put ERROR before INFO."""
    return F.array_position(F.array(*[F.lit(name) for name in LEVELS]), F.col(level) if isinstance(level, str) else level).cast("int")


def is_error() -> Column:
    return F.col("level") == "ERROR"


def with_event_date(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("ts"))


def normalized(events: DataFrame) -> DataFrame:
    """Lower-case trace ids and millisecond event times, as stored."""
    return events.withColumns(
        {
            "trace_id": F.lower("trace_id"),
            "ts": F.date_trunc("millisecond", "ts").cast("timestamp_ntz"),
        }
    )


# Rules of the contract in the order they are checked, each as the SQL condition of a broken row.
BROKEN = (
    ("trace_id missing", "trace_id IS NULL"),
    ("trace_id length", f"length(trace_id) <> {TRACE_ID_LENGTH}"),
    ("service missing", "service IS NULL"),
    ("service too long", f"length(service) > {MAX_LENGTH['service']}"),
    ("host missing", "host IS NULL"),
    ("host too long", f"length(host) > {MAX_LENGTH['host']}"),
    ("level missing", "level IS NULL"),
    ("level unknown", f"level NOT IN {LEVELS}"),
    ("ts missing or invalid", "ts IS NULL"),
    ("endpoint too long", f"length(endpoint) > {MAX_LENGTH['endpoint']}"),
)


def reject_reason(*before: tuple[str, str]) -> Column:
    """The first broken rule of a row, or NULL for a good one; `before` are rules to check first."""
    return F.expr(f"CASE {' '.join(f"WHEN {broken} THEN '{reason}'" for reason, broken in (*before, *BROKEN))} END")
