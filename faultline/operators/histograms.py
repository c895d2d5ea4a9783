"""Percentiles from rollups: counts of each latency a service had, by minute, hour and day.

A histogram of values is exact and can be added up, where a percentile cannot: hours are sums of minutes, days sums of hours, and any range
of whole minutes is the sum of the days, hours and minutes that make it up. Rows without a latency are counted as a value of their own, as
Q2 ranks them first. What a percentile costs then depends on the distinct latencies of the range and not on its events.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.ranking import target_rank, values_at_counts
from faultline.functions.timeframe import Moment, bucket, moment, ntz

#: Levels of the rollup, each made from the one before.
LEVELS = {"minute": "1 minute", "hour": "1 hour", "day": "1 day"}
SCHEMA = "service string, start timestamp_ntz, latency_ms int, n bigint, event_date date"


def latency_histogram(events: DataFrame, level: str = "minute") -> DataFrame:
    """Rows for each service, start of the minute, hour or day, and latency: n."""
    return events.groupBy("service", bucket(LEVELS[level]).alias("start"), "latency_ms").agg(F.count("*").alias("n"))


def coarser(histogram: DataFrame, level: str) -> DataFrame:
    """A finer histogram added up to hours or days."""
    return histogram.groupBy("service", bucket(LEVELS[level], "start").alias("start"), "latency_ms").agg(F.sum("n").alias("n"))


def _write(histogram: DataFrame, path: str) -> None:
    dated = histogram.withColumn("event_date", F.to_date("start")).repartitionByRange("event_date", "service", "start").sortWithinPartitions("event_date", "service", "start")
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def read_level(spark: SparkSession, path: str, level: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{path}/{level}")


def write_histograms(events: DataFrame, path: str) -> str:
    """All levels, in day directories; the days that events has are replaced, others stay. Events are read once."""
    spark = events.sparkSession
    days = [row[0] for row in events.select(F.to_date("ts")).distinct().collect()]
    _write(latency_histogram(events), f"{path}/minute")
    for finer, level in zip(LEVELS, list(LEVELS)[1:]):
        _write(coarser(read_level(spark, path, finer).filter(F.col("event_date").isin(days)), level), f"{path}/{level}")
    return path


def update_histograms(path: str, stored: DataFrame, batch: DataFrame) -> list[dt.date]:
    """Bring all levels up to date after a batch was stored: its days are counted anew from the store, and no others are read."""
    days = sorted(row[0] for row in batch.select(F.to_date("ts")).distinct().collect())
    if days:
        write_histograms(stored.filter(F.col("event_date").isin(days)), path)
    return days


def _next(time: dt.datetime, step: dt.timedelta) -> dt.datetime:
    """The first multiple of the step at or after a time."""
    return time + (dt.datetime(1970, 1, 1) - time) % step


def between(spark: SparkSession, path: str, lo: Moment, hi: Moment) -> DataFrame:
    """Counts of a range of whole minutes, from as many days and hours and as few minutes as it has: service, latency_ms, n."""
    lo, hi = moment(lo), moment(hi)
    if lo.second or lo.microsecond or hi.second or hi.microsecond:
        raise ValueError("a rollup answers for whole minutes")
    wanted: dict[str, list[tuple[dt.datetime, dt.datetime]]] = {level: [] for level in LEVELS}

    def cover(first: dt.datetime, end: dt.datetime, levels: list[str]) -> None:
        if first >= end:
            return
        step = dt.timedelta(**{f"{levels[0]}s": 1})
        inner, outer = _next(first, step), end - (end - dt.datetime(1970, 1, 1)) % step
        if len(levels) == 1 or inner < outer:
            wanted[levels[0]].append((inner, outer))
            if len(levels) > 1:
                cover(first, inner, levels[1:])
                cover(outer, end, levels[1:])
        else:
            cover(first, end, levels[1:])

    cover(lo, hi, ["day", "hour", "minute"])
    parts = []
    for level, ranges in wanted.items():
        for first, end in ranges:
            days = F.col("event_date").between(F.lit(first.date()), F.lit((end - dt.timedelta(minutes=1)).date()))
            rows = read_level(spark, path, level).filter(days & (F.col("start") >= ntz(first)) & (F.col("start") < ntz(end)))
            parts.append(rows.select("service", "latency_ms", "n"))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], "service string, latency_ms int, n bigint")


def p95_from_histogram(histogram: DataFrame, q: str = "0.95") -> DataFrame:
    """Q2 from counts: the latency at rank CEIL(q * n) per service, rows without one ranked first."""
    counts = histogram.groupBy("service", "latency_ms").agg(F.sum("n").alias("n"))
    return values_at_counts(counts, ["service"], "latency_ms", {"p95_latency_ms": target_rank(q, F.col("cnt"))})
