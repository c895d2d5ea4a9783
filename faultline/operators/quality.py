"""Duplicates, contract violations, dead letters and silent services."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.contract import EVENT_COLUMNS, normalized, reject_reason
from faultline.functions.ranking import first_of_each
from faultline.operators.analytics import of_service
from faultline.functions.timeframe import Moment, time_range

# Fixed value: receives after which a message that is still rejected goes to the dead letters.
MAX_RECEIVES = 3

# The body of a message as read: time and level are still text, so that a bad one can be reported.
BODY_SCHEMA = (
    "id bigint, trace_id string, service string, host string, level string, ts string, "
    "message string, latency_ms int, endpoint string, _corrupt string"
)


def dedup_trace_ts(events: DataFrame) -> DataFrame:
    """One row per (trace_id, ts), the one with the lowest id."""
    return first_of_each(normalized(events), ["trace_id", "ts"], ["id"])


def dedup_trace(events: DataFrame) -> DataFrame:
    """One row per trace_id, the earliest."""
    return first_of_each(normalized(events), ["trace_id"], ["ts", "id"])


def retry_audit(events: DataFrame) -> DataFrame:
    """Traces stored under more than one time: their sender stamps retries anew, past the duplicate rule."""
    return (
        normalized(events.select("trace_id", "ts"))
        # Copies of one (trace, time) are combined first, so a trace with very many copies arrives as a few rows.
        .groupBy("trace_id", "ts")
        .agg(F.count("*").alias("_copies"))
        .groupBy("trace_id")
        .agg(
            F.count("*").alias("distinct_ts"),
            F.sum("_copies").alias("deliveries"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
        .filter(F.col("distinct_ts") > 1)
        .withColumn("span_ms", F.unix_millis(F.col("last_ts").cast("timestamp")) - F.unix_millis(F.col("first_ts").cast("timestamp")))
    )


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message columns, the event in the body, and reject_reason (NULL for a good event)."""
    parsed = F.from_json("body", BODY_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # As a generator the body is parsed once; as a struct column it would be parsed once per field taken from it.
    opened = (
        messages.select("*", F.inline(F.array(parsed)))
        # A time with an offset is that instant; without one it is UTC, as the session is.
        .withColumns({"trace_id": F.lower("trace_id"), "ts": F.expr("cast(try_cast(ts AS timestamp) AS timestamp_ntz)")})
        # Senders need not number their events; the number then follows from the event's key.
        .withColumn("id", F.coalesce("id", F.xxhash64("trace_id", "ts")))
    )
    return opened.withColumn("reject_reason", reject_reason(("malformed body", "_corrupt IS NOT NULL"))).drop("_corrupt")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).select(*EVENT_COLUMNS)


def rejected(parsed: DataFrame, message_columns: list[str]) -> DataFrame:
    """The quarantine: the message as it came, with the reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select(*message_columns, "reject_reason")


def quarantine_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("row_count"))


def dead_letters(parsed: DataFrame, max_receives: int = MAX_RECEIVES) -> DataFrame:
    """Messages received max_receives times or more and rejected each time.

    A reason follows from the body alone, so a message is either always rejected or never, and any of
    its reasons is its reason.
    """
    refused = parsed.filter(F.col("reject_reason").isNotNull() & F.col("message_id").isNotNull())
    # Numbers are combined on the map side; bodies are fetched for the letters alone.
    counted = refused.groupBy("message_id").agg(F.count("*").alias("receives")).filter(F.col("receives") >= max_receives)
    bodies = first_of_each(refused.select("message_id", "reject_reason", "body", "receive"), ["message_id"], ["receive"]).drop("receive")
    return counted.join(bodies, "message_id").select("message_id", "receives", "reject_reason", "body")


def silent_services(events: DataFrame, known: DataFrame, lo: Moment, hi: Moment | None = None) -> DataFrame:
    """Events of every known service in the range, 0 where there are none; a grouped query has no row for those."""
    seen = of_service(time_range(events, lo, hi), None).groupBy("service").agg(F.count("*").alias("_n"))
    total = F.coalesce("_n", F.lit(0).cast("bigint"))
    return known.join(seen, "service", "left").select("service", total.alias("total_events"), (total == 0).alias("silent"))


def services_of(events: DataFrame) -> DataFrame:
    return events.select("service").distinct()
