"""Log events and derived feeds from the driver's `events` table.

The table has no duplicates and no bad rows, so the feeds that need some are derived from all of its
rows by a fixed rule; plans/oracles.py states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.timeframe import Moment, time_range

RAW_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def raw_event_stream(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """parts: as for log_events."""
    # The file source wants a folder or a pattern.
    raw = spark.readStream.schema(RAW_SCHEMA).parquet(f"{sf_dir}/events.parque[t]")
    return raw.repartition(parts) if parts else raw


def to_log_events(raw: DataFrame) -> DataFrame:
    """The columns of the contract."""
    name = """CASE user_id % 5 WHEN 0 THEN 'auth' WHEN 1 THEN 'payment' WHEN 2 THEN 'order'
                WHEN 3 THEN 'inventory' ELSE 'notification' END"""
    digest = "md5(cast(event_id AS string))"
    trace = ", ".join(f"substr({digest}, {start}, {n})" for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return raw.selectExpr(
        "event_id AS id",
        f"concat_ws('-', {trace}) AS trace_id",
        f"concat({name}, '-service') AS service",
        "concat('host-', lpad(cast(event_id % 10 + 1 AS string), 2, '0'), '.internal') AS host",
        """CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'purchase' THEN 'DEBUG'
             ELSE 'INFO' END AS level""",
        "cast(date_trunc('millisecond', ts) AS timestamp_ntz) AS ts",
        "concat_ws(' ', event_type, props) AS message",
        "cast(floor(value) AS int) AS latency_ms",
        f"concat('/api/v1/', {name}, '/', cast(event_id % 4 AS string)) AS endpoint",
    )


def log_events(spark: SparkSession, sf_dir: str, lo: Moment | None = None, hi: Moment | None = None, parts: int | None = None) -> DataFrame:
    """All log events, or those of a range with millisecond bounds.

    The range is put on the stored column: cutting to milliseconds cannot move a row across a
    millisecond bound, and a filter on the cut value would not reach the scan.

    parts: deal the rows, while they are small, to so many tasks. A row group is read by one task, and a file may have all its rows in one; without
    that, whatever is made of them (messages with bodies, quantiles and sorted ranges of a store) is made by that task.
    """
    raw = time_range(raw_events(spark, sf_dir), lo, hi)
    return to_log_events(raw.repartition(parts) if parts else raw)


def deliveries(events: DataFrame) -> DataFrame:
    """Every event as a sender with retries delivers it: 1 to 4 attempts, by id.

    Attempt 0 is the event. Later attempts get a new id and an upper-case trace id; senders on hosts
    06 to 10 also stamp the time anew, one second per attempt.
    """
    return events.selectExpr("*", "explode(sequence(0, cast(id % 4 AS int))) AS attempt").selectExpr(
        "id * 4 + attempt AS id",
        "if(attempt > 0, upper(trace_id), trace_id) AS trace_id",
        "service",
        "host",
        "level",
        "if(id % 10 >= 5, ts + make_dt_interval(0, 0, 0, attempt), ts) AS ts",
        "message",
        "latency_ms",
        "endpoint",
    )


def messages(events: DataFrame) -> DataFrame:
    """The events as queue messages with a JSON body, some of them damaged by id, all received 1 to 4 times.

    Some senders give times with an offset, and some of those whose events are bad leave out when they sent.
    """
    body = """to_json(named_struct(
        'id', id,
        'trace_id', if(id % 16 = 3, substr(trace_id, 1, 35), trace_id),
        'service', if(id % 16 = 1, NULL, service),
        'host', if(id % 16 = 2, rpad(host, 65, 'x'), host),
        'level', if(id % 16 = 0, 'FATAL', level),
        'ts', CASE id % 16 WHEN 5 THEN 'yesterday'
            WHEN 6 THEN date_format(ts + make_dt_interval(0, 5, 30), "yyyy-MM-dd'T'HH:mm:ss.SSS'+05:30'")
            ELSE date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') END,
        'message', message, 'latency_ms', latency_ms, 'endpoint', endpoint))"""
    # Receives go by bits above the fault number, so that every fault occurs with every number of them.
    return events.selectExpr("*", f"{body} AS _body").selectExpr(
        "concat('m', cast(id AS string)) AS message_id",
        "if(id % 32 = 3, NULL, ts) AS sent_at",
        "if(id % 16 = 4, substr(_body, 1, length(_body) - 1), _body) AS body",
        "explode(sequence(1, cast((id div 16) % 4 AS int) + 1)) AS receive",
    )


def later_receives(messages: DataFrame) -> DataFrame:
    """The messages as a sender stamps them who sends anew: every receive a day and a half after the one before."""
    return messages.withColumn("sent_at", F.expr("sent_at + make_dt_interval((receive - 1) * 3 div 2, (receive - 1) % 2 * 12)"))


def landed_lines(events: DataFrame) -> DataFrame:
    """The messages as lines of a landing folder; those of every 64th id are cut off."""
    whole = messages(events).selectExpr(
        "cast(substr(message_id, 2) AS bigint) AS id",
        "receive",
        "to_json(named_struct('message_id', message_id, 'sent_at', sent_at, 'body', body, 'receive', receive)) AS line",
    )
    return whole.selectExpr("if(id % 64 = 9, concat('{\"message_id\":\"m', id, '\",\"receive\":', receive, ',\"body'), line) AS value")


def signed_latencies(events: DataFrame) -> DataFrame:
    """The events of a feed whose clocks run apart: latencies below zero, and none for every seventh id."""
    return events.selectExpr(*[c for c in events.columns if c != "latency_ms"], "if(id % 7 = 0, NULL, latency_ms - 150) AS latency_ms")
