"""Rollups, rolling and sliding error rates, threshold rules, spikes, episodes and error sessions.

The reference names alerting but sets no thresholds or formulas: all of them are parameters here and
the defaults are ours.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.contract import is_error
from faultline.functions.timeframe import Moment, bucket, moment, ntz
from faultline.operators.analytics import error_counts, with_error_rate


def rollup_minute(events: DataFrame) -> DataFrame:
    """Count, latency sum and maximum per service, level and minute."""
    return events.groupBy("service", "level", bucket("1 minute").alias("minute")).agg(
        F.count("*").alias("event_count"),
        F.count("latency_ms").alias("latency_count"),
        F.sum("latency_ms").alias("latency_sum"),
        F.max("latency_ms").alias("latency_max"),
    )


def _rollup_counts() -> list[Column]:
    errors = F.when(is_error(), F.col("event_count")).otherwise(0)
    return [F.sum("event_count").alias("total_events"), F.sum(errors).alias("error_events")]


def error_rate_from_rollup(rollup: DataFrame, length: str = "5 minutes") -> DataFrame:
    """Q1 from the minute rollup; the window must be whole minutes."""
    counted = rollup.groupBy("service", bucket(length, "minute").alias("window_start")).agg(*_rollup_counts())
    return with_error_rate(counted).orderBy("window_start", "service")


def alert_from_rollup(rollup: DataFrame, span: dt.timedelta, as_of: Moment) -> DataFrame:
    """Q8 from the minute rollup, over the whole minutes of the span that ends with the minute of as_of."""
    hi = moment(as_of).replace(second=0, microsecond=0) + dt.timedelta(minutes=1)
    minutes = rollup.filter((F.col("minute") >= ntz(hi - span)) & (F.col("minute") < ntz(hi)))
    if "event_date" in rollup.columns:
        minutes = minutes.filter(F.col("event_date").between(F.lit((hi - span).date()), F.lit(hi.date())))
    return with_error_rate(minutes.groupBy("service").agg(*_rollup_counts()))


def write_rollup(events: DataFrame, path: str) -> str:
    """The minute rollup in day directories; days that events has are replaced, others stay."""
    daily = rollup_minute(events).withColumn("event_date", F.to_date("minute"))
    daily.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
    return path


def update_rollup(path: str, stored: DataFrame, batch: DataFrame) -> None:
    """Bring the rollup up to date after a batch was stored: its days are counted anew from the store, no others are read."""
    days = batch.select(F.to_date("ts").alias("event_date")).distinct()
    first, last = days.agg(F.min("event_date"), F.max("event_date")).first()
    if first is not None:
        near = stored.filter(F.col("event_date").between(F.lit(first), F.lit(last)))
        write_rollup(near.join(days, "event_date", "left_semi"), path)


def errors_per_hour_from_rollup(rollup: DataFrame) -> DataFrame:
    """Q6 from the minute rollup."""
    hours = (
        rollup.filter(is_error())
        .groupBy("service", bucket("1 hour", "minute").alias("hour"))
        .agg(F.sum("event_count").alias("error_count"))
    )
    return hours.select("service", F.date_format("hour", "yyyy-MM-dd HH:00:00").alias("hour_bucket"), "error_count").orderBy(
        "hour_bucket", "service"
    )


def rolling_errors(events: DataFrame, window: dt.timedelta = dt.timedelta(minutes=5)) -> DataFrame:
    """Errors of the service in the window ending at each event, both ends counted.

    The plain form, a RANGE frame over the service, sorts a whole service in one task and adds up the
    frame anew for every row. Here the answer is found once per distinct (service, time) and joined
    back; a time that many events share is split by the skew join. Time is cut into chunks as long as
    the window, each its own group, so a chunk holds no more rows than the window has milliseconds,
    times three. An error counts +1 when it happens and -1 when it leaves the window, which makes the
    answer a running sum; errors that reach into the next chunk are carried there by an extra row.
    """
    width = int(window.total_seconds() * 1_000_000)
    times = (
        events.groupBy("service", "ts")
        .agg(F.expr("count_if(level = 'ERROR') AS _errors"))
        .selectExpr("service", "ts", "_errors", "unix_micros(cast(ts AS timestamp)) AS _at")
        .selectExpr("*", f"_at - pmod(_at, {width}L) AS _chunk")
    )
    # The window includes its lower end, so an error leaves one microsecond after it. Chunks are as
    # long as the window, so that is in the next chunk or at its far edge.
    def mark(chunk: str, time: str, change: str, own: str) -> str:
        return f"named_struct('_chunk', {chunk}, '_time', {time}, '_change', {change}, '_own', {own})"

    event = mark("_chunk", "_at", "_errors", "true")
    carried = mark(f"_chunk + {width}L", "_at", "_errors", "false")
    gone = mark(f"_chunk + {width}L", f"_at + {width + 1}L", "-_errors", "false")
    marks = F.expr(f"inline(if(_errors > 0, array({event}, {carried}, {gone}), array({event})))")
    running = Window.partitionBy("service", "_chunk").orderBy("_time").rangeBetween(Window.unboundedPreceding, 0)
    rolled = (
        times.select("service", "ts", marks)
        .withColumn("errors_in_window", F.sum("_change").over(running))
        .filter("_own")
        .select("service", "ts", "errors_in_window")
    )
    return events.select("id", "service", "ts").join(rolled, ["service", "ts"]).select("id", "service", "ts", "errors_in_window")


def sliding_error_rate(events: DataFrame, length: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Error rate in overlapping windows.

    Events are counted per slide first, so that it is counts and not events that are copied into each
    window they fall in.
    """
    steps = events.groupBy("service", bucket(slide).alias("_step")).agg(*error_counts())
    counted = steps.groupBy("service", F.window("_step", length, slide).getField("start").alias("window_start")).agg(
        F.sum("total_events").alias("total_events"), F.sum("error_events").alias("error_events")
    )
    return with_error_rate(counted)


@dataclass(frozen=True)
class Rule:
    """Alert when a window of this length has enough events and too high an error rate."""

    name: str
    window_minutes: int
    min_events: int
    max_error_pct: float
    service: str | None = None


def rules_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [(r.name, r.service, r.window_minutes, r.min_events, float(r.max_error_pct)) for r in rules]
    return spark.createDataFrame(
        rows, "rule string, rule_service string, window_minutes int, min_events bigint, max_error_pct double"
    )


def with_rules(counted: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Windows joined to the rules of their length that are for their service or for all."""
    joined = counted.join(rules_frame(counted.sparkSession, rules), "window_minutes")
    return joined.filter("rule_service IS NULL OR rule_service = service").drop("rule_service")


def broken_rules(counted: DataFrame) -> DataFrame:
    return with_error_rate(counted).filter(
        (F.col("total_events") >= F.col("min_events")) & (F.col("error_rate_pct") > F.col("max_error_pct"))
    )


def threshold_alerts(events: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Windows that break a rule, for rules of any window length, in one pass over the events."""
    minutes = events.groupBy("service", bucket("1 minute").alias("_minute")).agg(*error_counts())
    seconds = F.unix_seconds(F.col("_minute").cast("timestamp"))
    lengths = F.array(*[F.lit(n) for n in sorted({rule.window_minutes for rule in rules})]).cast("array<int>")
    length = F.col("window_minutes").cast("bigint") * 60
    start = F.timestamp_seconds(seconds - F.pmod(seconds, length)).cast("timestamp_ntz")
    # Minutes are copied once for each length, not for each rule; rules meet whole windows.
    counted = (
        minutes.withColumn("window_minutes", F.explode(lengths))
        .groupBy("service", "window_minutes", start.alias("window_start"))
        .agg(F.sum("total_events").alias("total_events"), F.sum("error_events").alias("error_events"))
    )
    return broken_rules(with_rules(counted, rules)).select(
        "rule", "service", "window_start", "window_minutes", "total_events", "error_events", "error_rate_pct"
    )


def error_windows(events: DataFrame, length: str) -> DataFrame:
    return with_error_rate(events.groupBy("service", bucket(length).alias("window_start")).agg(*error_counts()))


def error_spikes(events: DataFrame, minutes: int = 60, history: int = 6, factor: int = 2, min_errors: int = 3) -> DataFrame:
    """Windows with at least min_errors errors and more than factor times the mean of the windows before.

    The mean is over the `history` windows directly before in time; a window without events counts as
    zero. Windows without that much history behind them are not judged.
    """
    seconds = F.unix_seconds(F.col("window_start").cast("timestamp"))
    step = minutes * 60
    # Windows per service are bounded by the period, not by the number of events.
    by_time = Window.partitionBy("service").orderBy("_second")
    before = by_time.rangeBetween(-history * step, -step)
    judged = (
        events.groupBy("service", bucket(f"{minutes} minutes").alias("window_start"))
        .agg(*error_counts())
        .withColumn("_second", seconds)
        .withColumn("previous_errors", F.coalesce(F.sum("error_events").over(before), F.lit(0).cast("bigint")))
        .withColumn("_first", F.min("_second").over(Window.partitionBy("service")))
    )
    return judged.filter(
        (F.col("error_events") >= min_errors)
        & (F.col("_second") - F.col("_first") >= history * step)
        & (F.col("error_events") * history > F.col("previous_errors") * factor)
    ).select("service", "window_start", "error_events", "previous_errors")


def breaches(events: DataFrame, minutes: int, min_events: int, max_error_pct: float) -> DataFrame:
    windows = error_windows(events, f"{minutes} minutes")
    return windows.filter((F.col("total_events") >= min_events) & (F.col("error_rate_pct") > max_error_pct))


def alert_episodes(events: DataFrame, minutes: int = 60, min_events: int = 2, max_error_pct: float = 20.0) -> DataFrame:
    """Breaching windows that follow each other without a gap, as one row each.

    A window that does not breach, or has no events, ends the episode.
    """
    by_time = Window.partitionBy("service").orderBy("window_start")
    step = F.make_dt_interval(mins=F.lit(minutes))
    continues = F.lag("window_start").over(by_time) + step == F.col("window_start")
    return (
        breaches(events, minutes, min_events, max_error_pct)
        .withColumn("_starts", F.when(continues, 0).otherwise(1))
        .withColumn("_episode", F.sum("_starts").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("service", "_episode")
        .agg(
            F.min("window_start").alias("episode_start"),
            (F.max("window_start") + step).alias("episode_end"),
            F.count("*").alias("windows"),
            F.sum("total_events").alias("total_events"),
            F.sum("error_events").alias("error_events"),
        )
        .drop("_episode")
    )


def error_sessions(events: DataFrame, gap: dt.timedelta = dt.timedelta(minutes=30)) -> DataFrame:
    """Errors of a service no further apart than the gap, as one row per run.

    Errors within one slot of half a gap belong together in any case, so they are combined first;
    what is ordered per service is slots, which the period bounds, and not errors.
    """
    slot = f"{int(gap.total_seconds() * 500)} milliseconds"
    width = F.make_dt_interval(secs=F.lit(gap.total_seconds()))
    slots = (
        events.filter(is_error())
        .groupBy("service", bucket(slot).alias("_slot"))
        .agg(F.min("ts").alias("_first"), F.max("ts").alias("_last"), F.count("*").alias("_n"))
    )
    by_time = Window.partitionBy("service").orderBy("_slot")
    joined = F.lag("_last").over(by_time) + width >= F.col("_first")
    return (
        slots.withColumn("_starts", F.when(joined, 0).otherwise(1))
        .withColumn("_session", F.sum("_starts").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("service", "_session")
        .agg(
            F.min("_first").alias("session_start"),
            (F.max("_last") + width).alias("session_end"),
            F.sum("_n").alias("error_events"),
        )
        .drop("_session")
    )
