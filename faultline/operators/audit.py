"""Checks of the stored table: counts, days, schema, copies."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.contract import EVENT_COLUMNS, EVENT_SCHEMA, LEVELS, MAX_LENGTH, STORED_SCHEMA, TRACE_ID_LENGTH, level_rank
from faultline.functions import dialect, exact


def row_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("total_count"))


def partition_profile(events: DataFrame) -> DataFrame:
    """Name, upper bound, rows and time span of every day's partition; rows are counted, not estimated."""
    day = F.col("event_date") if "event_date" in events.columns else F.to_date("ts")
    return (
        events.groupBy(day.alias("_day"))
        .agg(F.count("*").alias("row_count"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .select(
            _partition_name("_day").alias("partition_name"),
            dialect.to_days(F.date_add("_day", 1)).alias("less_than_days"),
            F.col("_day").cast("string").alias("event_date"),
            "row_count",
            "first_ts",
            "last_ts",
        )
    )


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside this one that answers counts, minima and maxima of Parquet tables from the files' footers."""
    other = spark.newSession()
    # Only the newer of Spark's two Parquet readers hands aggregates to the footers.
    for name, value in (
        ("spark.sql.sources.useV1SourceList", ""),
        ("spark.sql.parquet.aggregatePushdown", "true"),
        ("spark.sql.session.timeZone", "UTC"),
        ("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")),
    ):
        other.conf.set(name, value)
    return other


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """partition_profile of a store without reading a row: files state how many rows they have and their first and last ts_ms.

    Times are to the millisecond, as stored ones are.
    """
    stated = (
        _by_footers(spark, path)
        .groupBy("event_date")
        .agg(F.count("*").alias("row_count"), F.min("ts_ms").alias("_first"), F.max("ts_ms").alias("_last"))
    )
    return stated.select(
        _partition_name("event_date").alias("partition_name"),
        dialect.to_days(F.date_add("event_date", 1)).alias("less_than_days"),
        F.col("event_date").cast("string").alias("event_date"),
        "row_count",
        F.timestamp_millis("_first").cast("timestamp_ntz").alias("first_ts"),
        F.timestamp_millis("_last").cast("timestamp_ntz").alias("last_ts"),
    )


def stored_row_count(spark: SparkSession, path: str) -> DataFrame:
    """row_count of a store from the footers."""
    return _by_footers(spark, path).agg(F.count("*").alias("total_count"))


def _by_footers(spark: SparkSession, path: str) -> DataFrame:
    """A store whose aggregates come from footers. Spark looks the statistics of a column up by its place, so the schema has to be the files' own, whole."""
    return footer_session(spark).read.schema(STORED_SCHEMA).parquet(path)


def _partition_name(day: str) -> Column:
    return F.concat(F.lit("p"), F.date_format(day, "yyyyMMdd"))


def overflow_dates(events: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Days with rows outside the expected ones, and the partition each would need.

    Writing creates a day directory by itself; what is left of the rollover is to notice rows that a
    catch-all partition would have taken in silently.
    """
    day = F.to_date("ts")
    return (
        events.groupBy(day.alias("_day"))
        .agg(F.count("*").alias("row_count"))
        .filter((F.col("_day") < F.lit(first)) | (F.col("_day") > F.lit(last)))
        .select(
            F.col("_day").cast("string").alias("event_date"),
            "row_count",
            F.when(F.col("_day") < F.lit(first), "before").otherwise("after").alias("side"),
            _partition_name("_day").alias("partition_name"),
            F.date_add("_day", 1).cast("string").alias("less_than"),
        )
    )


def checksum(events: DataFrame) -> DataFrame:
    """Row count and a sum of row hashes; a sum keeps duplicates, which an exclusive or would cancel."""
    return events.agg(F.count("*").alias("row_count"), F.sum(_row_hash()).alias("hash_sum"))


def _row_hash() -> Column:
    return F.xxhash64(*EVENT_COLUMNS).cast("decimal(38,0)")


def copy_check(original: DataFrame, copy: DataFrame) -> DataFrame:
    """One row: counts of both tables and whether counts and contents agree."""
    def hashes(table: DataFrame, side: str) -> DataFrame:
        return table.select(F.lit(side).alias("_side"), _row_hash().alias("_hash"))

    is_copy = F.col("_side") == "copy"
    signed = F.when(is_copy, -F.col("_hash")).otherwise(F.col("_hash"))
    return (
        hashes(original, "original")
        .union(hashes(copy, "copy"))
        .agg(
            F.count_if(~is_copy).alias("events_count"),
            F.count_if(is_copy).alias("copy_count"),
            # Equal contents cancel to zero; two empty tables have no sum.
            (F.coalesce(F.sum(signed), F.lit(0)) == 0).alias("_same_hash"),
        )
        .select(
            "events_count",
            "copy_count",
            (F.col("events_count") == F.col("copy_count")).alias("same_count"),
            (F.col("_same_hash") & (F.col("events_count") == F.col("copy_count"))).alias("same_content"),
        )
    )


def schema_check(events: DataFrame) -> DataFrame:
    """One row per column of the contract: stored type, NULLs, longest text, rows breaking the rule of the column."""
    types = dict(events.dtypes)
    rules = {name: F.length(name) > limit for name, limit in MAX_LENGTH.items()}
    rules["trace_id"] = F.length("trace_id") != TRACE_ID_LENGTH
    rules["level"] = ~F.col("level").isin(*LEVELS)

    measures = []
    for field in EVENT_SCHEMA:
        present = field.name in types
        is_text = types.get(field.name) == "string"
        broken = rules.get(field.name, F.lit(False))
        if not field.nullable:
            broken = F.col(field.name).isNull() | broken
        measures.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("declared_type"),
                F.lit(types.get(field.name, "missing")).alias("stored_type"),
                (F.count_if(F.col(field.name).isNull()) if present else F.count("*")).alias("null_rows"),
                (F.coalesce(F.max(F.length(field.name)), F.lit(0)) if is_text else F.lit(0)).alias("max_length"),
                (F.count_if(broken) if present else F.count("*")).alias("broken_rows"),
            )
        )
    # All measures are taken in one pass and only then turned into rows.
    return events.agg(F.array(*measures).alias("_columns")).select(F.inline("_columns"))


def level_mix(events: DataFrame, expected: dict[str, float], tolerance: float = 1.0) -> DataFrame:
    """Share of each level in percent against the expected one."""
    wanted = reduce(
        lambda rest, item: F.when(F.col("level") == item[0], F.lit(float(item[1]))).otherwise(rest),
        expected.items(),
        F.lit(0.0),
    )
    # The total is summed from the counts, whose shuffle both uses share.
    counted = events.groupBy("level").agg(F.count("*").alias("row_count"))
    total = counted.agg(F.sum("row_count")).scalar()
    return (
        counted.withColumn("_total", total)
        .select("level", level_rank("level").alias("level_rank"), "row_count", exact.percent("row_count", "_total").alias("share_pct"), wanted.alias("expected_pct"))
        .withColumn("within_tolerance", F.abs(F.col("share_pct") - F.col("expected_pct")) <= tolerance)
    )
