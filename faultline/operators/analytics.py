"""The eight queries. service=None answers for every service at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.contract import LOOSE_COLLATION, is_error
from faultline.functions import exact
from faultline.functions.ranking import nearest_rank
from faultline.functions.timeframe import Moment, bucket, latest, moment, time_range

LOOKUP_COLUMNS = ["id", "trace_id", "service", "level", "ts", "latency_ms", "endpoint"]
WINDOW_COLUMNS = ["id", "trace_id", "service", "host", "level", "ts", "latency_ms", "endpoint", "message"]


def of_service(events: DataFrame, service: str | Sequence[str] | None, loose: bool = False) -> DataFrame:
    """Rows of one service, or of several; loose ignores case, accents and trailing spaces, at the price of pushdown.

    For a store, names.spellings gives the names to look up instead, which keeps pushdown.
    """
    if service is None:
        return events
    if not isinstance(service, str):
        return events.filter(F.col("service").isin(list(service)))
    name = F.lit(service)
    if loose:
        return events.filter(F.collate("service", LOOSE_COLLATION) == F.collate(name, LOOSE_COLLATION))
    return events.filter(F.col("service") == name)


def error_counts() -> list[Column]:
    return [F.expr("count(*) AS total_events"), F.expr("count_if(level = 'ERROR') AS error_events")]


def with_error_rate(counted: DataFrame) -> DataFrame:
    return counted.withColumn("error_rate_pct", exact.percent("error_events", "total_events"))


def error_rate(
    events: DataFrame,
    service: str | None = None,
    lo: Moment | None = None,
    hi: Moment | None = None,
    length: str = "5 minutes",
) -> DataFrame:
    """Q1: events, errors and error percentage per window and service, oldest window first."""
    counted = (
        of_service(time_range(events, lo, hi), service)
        .groupBy("service", bucket(length).alias("window_start"))
        .agg(*error_counts())
    )
    return with_error_rate(counted).orderBy("window_start", "service")


def p95_latency(
    events: DataFrame, service: str | None = None, lo: Moment | None = None, hi: Moment | None = None, q: str = "0.95"
) -> DataFrame:
    """Q2: latency at rank CEIL(q * n) per service; NULL latencies count and rank first."""
    return nearest_rank(of_service(time_range(events, lo, hi), service), ["service"], "latency_ms", q, "p95_latency_ms")


def slowest_endpoints(
    events: DataFrame, service: str | None = None, lo: Moment | None = None, hi: Moment | None = None, k: int = 10
) -> DataFrame:
    """Q3: endpoints of the k highest average latencies per service; equal averages share a rank."""
    stats = (
        of_service(time_range(events, lo, hi), service)
        .groupBy("service", "endpoint")
        .agg(
            F.count("*").alias("call_count"),
            exact.mean("sum(latency_ms)", "count(latency_ms)").alias("avg_latency_ms"),
            F.max("latency_ms").alias("max_latency_ms"),
        )
    )
    by_average = Window.partitionBy("service").orderBy(F.desc("avg_latency_ms"))
    return (
        stats.withColumn("latency_rank", F.dense_rank().over(by_average))
        .filter(F.col("latency_rank") <= k)
        .withColumn("latency_rank", F.col("latency_rank").cast("bigint"))
        .orderBy("service", F.desc("avg_latency_ms"), "endpoint")
    )


def range_lookup(
    events: DataFrame, service: str | None, lo: Moment | None, hi: Moment | None, limit: int = 100
) -> DataFrame:
    """Q4: the first rows of a service in a range, by time and id."""
    found = of_service(time_range(events, lo, hi), service).select(*LOOKUP_COLUMNS)
    return found.orderBy("ts", "id").limit(limit)


def error_lookup(
    events: DataFrame, service: str | None, lo: Moment | None, hi: Moment | None, limit: int = 100
) -> DataFrame:
    """Q5: the first ERROR rows of a service in a range, by time and id."""
    found = of_service(time_range(events, lo, hi), service).filter(is_error()).select(*LOOKUP_COLUMNS, "message")
    return found.orderBy("ts", "id").limit(limit)


def errors_per_hour(
    events: DataFrame, service: str | None = None, lo: Moment | None = None, hi: Moment | None = None
) -> DataFrame:
    """Q6: errors per hour; the hour is text, as dashboards of the reference read it."""
    hours = (
        of_service(time_range(events, lo, hi), service)
        .filter(is_error())
        .groupBy("service", bucket("1 hour").alias("hour"))
        .agg(F.count("*").alias("error_count"))
    )
    # Text is made once per group, not once per event.
    return hours.select(
        "service", F.date_format("hour", "yyyy-MM-dd HH:00:00").alias("hour_bucket"), "error_count"
    ).orderBy("hour_bucket", "service")


def window_events(events: DataFrame, service: str | None, lo: Moment | None, hi: Moment | None) -> DataFrame:
    """Q7: all columns of all rows of a service in a range."""
    return of_service(time_range(events, lo, hi), service).select(*WINDOW_COLUMNS)


def alert_error_rate(
    events: DataFrame,
    service: str | None = None,
    span: dt.timedelta = dt.timedelta(minutes=5),
    as_of: Moment | None = None,
) -> DataFrame:
    """Q8: error rate over the span before as_of, by default the newest event; a row at as_of counts, later ones do not.

    as_of is read first, as one row, so that the range is a literal and prunes days and row groups.
    """
    as_of = latest(events) if as_of is None else moment(as_of)
    # A table without rows has no newest event; any bound then gives the empty answer.
    hi = as_of or dt.datetime(1970, 1, 2)
    within = time_range(events, hi - span, hi + dt.timedelta(microseconds=1))
    counted = of_service(within, service).groupBy("service").agg(*error_counts())
    return with_error_rate(counted)
