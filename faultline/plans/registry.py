"""The registered queries: each operator on the driver's tables.

Times are those of the driver's events, January 2024.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.contract import EVENT_COLUMNS, level_rank
from faultline.functions import dialect
from faultline.functions.timeframe import time_range
from faultline.operators import alerts, analytics, audit, histograms, latency, quality
from faultline.session import use_utc, work_path
from faultline.sources import driver_events, store, synthetic, traces
from faultline.streaming import dedup, episodes, ingest, jobs, processors, windows

Query = Callable[[SparkSession, str], DataFrame]

# The level shares in percent that the generator is documented to produce.
EXPECTED_LEVELS = {"ERROR": 5.0, "WARN": 15.0, "INFO": 60.0, "DEBUG": 20.0}

EXPECTED_FIRST_DAY, EXPECTED_LAST_DAY = dt.date(2024, 1, 2), dt.date(2024, 1, 25)
SPLIT = dt.datetime(2024, 1, 16)
DAY = dt.timedelta(days=1)
RULES = (
    alerts.Rule("hourly errors", window_minutes=60, min_events=2, max_error_pct=30.0),
    alerts.Rule("daily errors", window_minutes=1440, min_events=20, max_error_pct=22.0),
    alerts.Rule("payment errors", window_minutes=15, min_events=1, max_error_pct=10.0, service="payment-service"),
)
DELAY, DELAY_SPAN = "10 minutes", dt.timedelta(minutes=10)

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(use_utc(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return function


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_events.log_events(spark, sf_dir)


def _version(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """When the events were written, and their size: another version is another table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(path).getModificationTime(), system.getContentSummary(path).getLength()


#: Bytes of the events' files for one task, some 50,000 rows, of which messages make some 50 MB.
SPREAD_BYTES = 1 << 20


def _spread(spark: SparkSession, sf_dir: str) -> int:
    """Tasks to deal the events to before they are made into messages or a store."""
    _, size = _version(spark, sf_dir)
    return max(1, -(-size // SPREAD_BYTES))


def _dealt_events(spark: SparkSession, sf_dir: str, lo: dt.datetime | None = None, hi: dt.datetime | None = None) -> DataFrame:
    return driver_events.log_events(spark, sf_dir, lo, hi, _spread(spark, sf_dir))


@lru_cache(maxsize=None)
def _stored(spark: SparkSession, sf_dir: str, version: tuple[int, int]) -> str:
    return store.write_daily(_dealt_events(spark, sf_dir), work_path(spark, "daily"), "errorifexists")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day-partitioned table of an input folder, written once per session and version of the input."""
    return store.read_store(spark, _stored(spark, sf_dir, _version(spark, sf_dir)))


def _listed(stored: DataFrame) -> DataFrame:
    return stored.select(*EVENT_COLUMNS, F.col("event_date").cast("string").alias("event_date"))


# Sources and sinks


@query
def scan_events(spark, sf_dir):
    return _events(spark, sf_dir).select(*EVENT_COLUMNS)


@query
def append_events(spark, sf_dir):
    path = work_path(spark, "append")
    for lo, hi in ((None, SPLIT), (SPLIT, None)):
        store.append_batch(_dealt_events(spark, sf_dir, lo, hi), path)
    return _listed(store.read_store(spark, path))


@query
def layout_daily(spark, sf_dir):
    return _listed(daily(spark, sf_dir))


@query
def copy_flat(spark, sf_dir):
    path = work_path(spark, "flat")
    store.write_flat(daily(spark, sf_dir), path)
    return store.read_flat(spark, path)


@query
def overflow_dates(spark, sf_dir):
    return audit.overflow_dates(_events(spark, sf_dir), EXPECTED_FIRST_DAY, EXPECTED_LAST_DAY)


@query
def retain_days(spark, sf_dir):
    path = store.write_daily(_dealt_events(spark, sf_dir), work_path(spark, "retained"), "errorifexists")
    return _listed(store.retain_days(spark, path, 7, dt.date(2024, 12, 31)))


@query
def partition_profile(spark, sf_dir):
    return audit.partition_profile(daily(spark, sf_dir))


@query
def stored_profile(spark, sf_dir):
    """The profile of the stored table from its files' footers."""
    return audit.stored_profile(spark, _stored(spark, sf_dir, _version(spark, sf_dir)))


@query
def stored_row_count(spark, sf_dir):
    return audit.stored_row_count(spark, _stored(spark, sf_dir, _version(spark, sf_dir)))


@query
def row_count(spark, sf_dir):
    return audit.row_count(_events(spark, sf_dir))


@query
def copy_check(spark, sf_dir):
    return audit.copy_check(_events(spark, sf_dir), daily(spark, sf_dir))


@query
def schema_check(spark, sf_dir):
    return audit.schema_check(daily(spark, sf_dir))


@query
def synthetic_events(spark, sf_dir):
    ids = driver_events.raw_events(spark, sf_dir).select(F.col("event_id").alias("id"))
    return synthetic.synthesize(ids)


@query
def scalar_functions(spark, sf_dir):
    """The functions of the reference's SQL over every event."""
    return _events(spark, sf_dir).select(
        "id",
        dialect.unix_timestamp("ts").alias("unix_seconds"),
        dialect.from_unixtime(F.floor(dialect.unix_timestamp("ts") / 300) * 300).alias("five_minutes"),
        F.expr("ceil(0.95 * id)").cast("bigint").alias("rank"),
        F.round(F.col("latency_ms").cast("decimal(20,3)") / 7, 2).cast("double").alias("weekly_ms"),
        F.expr("coalesce(nullif(latency_ms, 0), -1)").alias("nonzero_ms"),
        F.expr("CASE WHEN level = 'ERROR' THEN 1 ELSE 0 END").alias("is_error"),
        F.date_format("ts", "yyyy-MM-dd HH:00:00").alias("hour_text"),
        dialect.to_days("ts").alias("day_number"),
        F.concat(F.lit("p"), F.date_format(F.date_add(F.to_date("ts"), 8), "yyyyMMdd")).alias("partition_ahead"),
        level_rank("level").alias("level_rank"),
    )


# Ranges and lookups


@query
def pruned_range(spark, sf_dir):
    days = time_range(daily(spark, sf_dir), "2024-01-10 06:00:00", "2024-01-12 18:00:00")
    return days.select(*EVENT_COLUMNS)


@query
def range_lookup(spark, sf_dir):
    lo, hi = "2024-01-15 12:00:00", "2024-01-15 14:00:00"
    return analytics.range_lookup(driver_events.log_events(spark, sf_dir, lo, hi), "inventory-service", lo, hi)


@query
def error_lookup(spark, sf_dir):
    lo, hi = "2024-01-15", "2024-01-16"
    return analytics.error_lookup(driver_events.log_events(spark, sf_dir, lo, hi), "notification-service", lo, hi)


@query
def window_events(spark, sf_dir):
    lo, hi = "2024-01-15 14:00:00", "2024-01-15 15:00:00"
    return analytics.window_events(driver_events.log_events(spark, sf_dir, lo, hi), "payment-service", lo, hi)


@query
def error_lookup_by_level(spark, sf_dir):
    """Q5 on a table that is clustered by level within a service."""
    path = store.write_daily(_dealt_events(spark, sf_dir), work_path(spark, "by-level"), "errorifexists", order=store.LEVEL_ORDER)
    return analytics.error_lookup(store.read_store(spark, path), "notification-service", "2024-01-15", "2024-01-16")


@query
def clustered_lookup(spark, sf_dir):
    return analytics.window_events(daily(spark, sf_dir), "payment-service", "2024-01-15", "2024-01-16")


# The analytics queries over all services and the whole period, then with the filters of a dashboard


@query
def error_rate_5min(spark, sf_dir):
    return analytics.error_rate(_events(spark, sf_dir))


@query
def error_rate_5min_service_day(spark, sf_dir):
    lo, hi = "2024-01-10", "2024-01-11"
    return analytics.error_rate(driver_events.log_events(spark, sf_dir, lo, hi), "payment-service", lo, hi)


@query
def p95_rownumber(spark, sf_dir):
    return latency.p95_row_number(_events(spark, sf_dir))


@query
def p95_histogram(spark, sf_dir):
    return latency.p95_histogram(_events(spark, sf_dir))


@query
def p95_service_week(spark, sf_dir):
    lo, hi = "2024-01-08", "2024-01-15"
    return analytics.p95_latency(driver_events.log_events(spark, sf_dir, lo, hi), "order-service", lo, hi)


@query
def p95_disc(spark, sf_dir):
    return latency.p95_disc(_events(spark, sf_dir))


@query
def p95_approx(spark, sf_dir):
    return latency.p95_approx(_events(spark, sf_dir))


@query
def p95_approx_error(spark, sf_dir):
    return latency.approx_rank_error(_events(spark, sf_dir))


@query
def slowest_endpoints_signed(spark, sf_dir):
    return analytics.slowest_endpoints(driver_events.signed_latencies(_events(spark, sf_dir)))


@query
def latency_summary_signed(spark, sf_dir):
    return latency.latency_summary(driver_events.signed_latencies(_events(spark, sf_dir)))


@query
def latency_row_numbers(spark, sf_dir):
    return latency.latency_row_numbers(_events(spark, sf_dir))


@query
def slowest_endpoints(spark, sf_dir):
    return analytics.slowest_endpoints(_events(spark, sf_dir))


@query
def slowest_endpoints_service_week(spark, sf_dir):
    lo, hi = "2024-01-08", "2024-01-15"
    return analytics.slowest_endpoints(driver_events.log_events(spark, sf_dir, lo, hi), "auth-service", lo, hi)


@query
def errors_per_hour(spark, sf_dir):
    return analytics.errors_per_hour(_events(spark, sf_dir))


@query
def errors_per_hour_service_week(spark, sf_dir):
    lo, hi = "2024-01-08", "2024-01-15"
    return analytics.errors_per_hour(driver_events.log_events(spark, sf_dir, lo, hi), "payment-service", lo, hi)


@query
def alert_error_rate(spark, sf_dir):
    # The newest time is read from the stored column; only its range is then read with the other columns.
    as_of = driver_events.log_events(spark, sf_dir).agg(F.max("ts")).first()[0]
    return analytics.alert_error_rate(driver_events.log_events(spark, sf_dir, as_of - DAY), span=DAY, as_of=as_of)


@query
def alert_error_rate_past(spark, sf_dir):
    """Q8 as of a moment that many events follow."""
    return analytics.alert_error_rate(_events(spark, sf_dir), span=DAY, as_of=SPLIT)


@query
def latency_summary(spark, sf_dir):
    return latency.latency_summary(_events(spark, sf_dir))


@query
def latency_pivot(spark, sf_dir):
    return latency.latency_pivot(_events(spark, sf_dir))


@query
def latency_change(spark, sf_dir):
    return latency.latency_change(_events(spark, sf_dir), SPLIT)


# Quality


@query
def dedup_trace_ts(spark, sf_dir):
    return quality.dedup_trace_ts(driver_events.deliveries(_events(spark, sf_dir)))


@query
def dedup_trace(spark, sf_dir):
    return quality.dedup_trace(driver_events.deliveries(_events(spark, sf_dir)))


@query
def idempotent_append(spark, sf_dir):
    path = work_path(spark, "idempotent")
    events = _events(spark, sf_dir)
    first_attempts = events.withColumn("id", F.col("id") * 4)
    store.append_new(first_attempts, path)
    store.append_new(driver_events.deliveries(events), path)
    return _listed(store.read_store(spark, path))


@query
def idempotent_append_trace(spark, sf_dir):
    """The duplicate rule of trace_id alone: retries with a new time add nothing either."""
    path = work_path(spark, "idempotent-trace")
    events = _events(spark, sf_dir)
    traces.append_once(events.withColumn("id", F.col("id") * 4), path)
    traces.append_once(driver_events.deliveries(events), path)
    return _listed(store.read_store(spark, path))


@query
def retry_audit(spark, sf_dir):
    return quality.retry_audit(driver_events.deliveries(_events(spark, sf_dir)))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.parse_messages(driver_events.messages(_events(spark, sf_dir)))


@query
def quarantine(spark, sf_dir):
    return quality.rejected(_parsed(spark, sf_dir), ["message_id", "sent_at", "receive"])


@query
def accepted_messages(spark, sf_dir):
    return quality.accepted(_parsed(spark, sf_dir))


@query
def quarantine_counts(spark, sf_dir):
    return quality.quarantine_counts(_parsed(spark, sf_dir))


@query
def dead_letter(spark, sf_dir):
    return quality.dead_letters(_parsed(spark, sf_dir)).drop("body")


@query
def silent_services(spark, sf_dir):
    events = _events(spark, sf_dir)
    as_of = events.agg(F.max("ts")).first()[0]
    lo = as_of - dt.timedelta(hours=1)
    return quality.silent_services(
        driver_events.log_events(spark, sf_dir, lo), quality.services_of(events), lo
    )


@query
def level_mix(spark, sf_dir):
    return audit.level_mix(_events(spark, sf_dir), EXPECTED_LEVELS)


# Alerts


@query
def rolling_errors(spark, sf_dir):
    return alerts.rolling_errors(_events(spark, sf_dir))


@query
def sliding_error_rate(spark, sf_dir):
    return alerts.sliding_error_rate(_events(spark, sf_dir))


@query
def rollup_minute(spark, sf_dir):
    return alerts.rollup_minute(_events(spark, sf_dir))


@query
def error_rate_from_rollup(spark, sf_dir):
    return alerts.error_rate_from_rollup(_rollup(spark, sf_dir))


@query
def errors_per_hour_from_rollup(spark, sf_dir):
    return alerts.errors_per_hour_from_rollup(_rollup(spark, sf_dir))


@query
def rollup_incremental(spark, sf_dir):
    """The rollup of a store that was filled in two batches and brought up to date after each."""
    path, rollup = work_path(spark, "rolled"), work_path(spark, "rollup")
    noon = SPLIT + DAY / 2
    for lo, hi in ((None, noon), (noon, None)):
        batch = driver_events.log_events(spark, sf_dir, lo, hi)
        store.append_batch(_dealt_events(spark, sf_dir, lo, hi), path)
        alerts.update_rollup(rollup, store.read_store(spark, path), batch)
    return spark.read.parquet(rollup).drop("event_date")


@lru_cache(maxsize=None)
def _histograms(spark: SparkSession, sf_dir: str, version: tuple[int, int]) -> str:
    """Latency counts of a store that was filled in two batches which share a day, brought up to date after each."""
    path, rollup = work_path(spark, "counted"), work_path(spark, "histograms")
    noon = SPLIT + DAY / 2
    for lo, hi in ((None, noon), (noon, None)):
        batch = driver_events.log_events(spark, sf_dir, lo, hi)
        store.append_batch(_dealt_events(spark, sf_dir, lo, hi), path)
        histograms.update_histograms(rollup, store.read_store(spark, path), batch)
    return rollup


@query
def p95_from_rollup(spark, sf_dir):
    """Q2 from the daily counts."""
    daily_counts = histograms.read_level(spark, _histograms(spark, sf_dir, _version(spark, sf_dir)), "day")
    return histograms.p95_from_histogram(daily_counts)


@query
def p95_from_rollup_range(spark, sf_dir):
    """Q2 of a range that is made of days, hours and minutes."""
    path = _histograms(spark, sf_dir, _version(spark, sf_dir))
    return histograms.p95_from_histogram(histograms.between(spark, path, "2024-01-08 10:17:00", "2024-01-15 03:05:00"))


@query
def alert_from_rollup(spark, sf_dir):
    return alerts.alert_from_rollup(_rollup(spark, sf_dir), DAY, SPLIT)


@lru_cache(maxsize=None)
def _stored_rollup(spark: SparkSession, sf_dir: str, version: tuple[int, int]) -> str:
    return alerts.write_rollup(_events(spark, sf_dir), work_path(spark, "rollup"))


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_stored_rollup(spark, sf_dir, _version(spark, sf_dir)))


@query
def threshold_alerts(spark, sf_dir):
    return alerts.threshold_alerts(_events(spark, sf_dir), RULES)


@query
def error_spikes(spark, sf_dir):
    return alerts.error_spikes(_events(spark, sf_dir))


@query
def alert_episodes(spark, sf_dir):
    return alerts.alert_episodes(_events(spark, sf_dir))


@query
def error_sessions(spark, sf_dir):
    return alerts.error_sessions(_events(spark, sf_dir))


# Streams


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_events.to_log_events(driver_events.raw_event_stream(spark, sf_dir))


#: Input of one state store, about 10,000 events. A stream cannot merge small partitions as it runs, as a batch does, so its steps have the session's
#: partitions or, if that is fewer, as many as the table fills.
STATE_BYTES = 1 << 18


def _parts(spark: SparkSession, sf_dir: str) -> int:
    _, size = _version(spark, sf_dir)
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(4, -(-size // STATE_BYTES)))


#: Lines repeat much of each other. A compressed file is read by one task, and has the lines of one part of the dealt events.
LANDING_CODEC = "lz4"


@lru_cache(maxsize=None)
def _ingested(spark: SparkSession, sf_dir: str, version: tuple[int, int]) -> ingest.Sinks:
    sinks = ingest.Sinks(work_path(spark, "ingest"))
    raw = driver_events.raw_event_stream(spark, sf_dir, _spread(spark, sf_dir))
    ingest.ingest(driver_events.messages(driver_events.to_log_events(raw)), sinks, parts=_parts(spark, sf_dir))
    return sinks


def _sinks(spark: SparkSession, sf_dir: str) -> ingest.Sinks:
    return _ingested(spark, sf_dir, _version(spark, sf_dir))


@lru_cache(maxsize=None)
def _landed(spark: SparkSession, sf_dir: str, version: tuple[int, int]) -> ingest.Sinks:
    """The sinks of messages that came as files of lines, some of them cut off."""
    landing, sinks = work_path(spark, "landing"), ingest.Sinks(work_path(spark, "landed"))
    driver_events.landed_lines(_dealt_events(spark, sf_dir)).write.text(landing, compression=LANDING_CODEC)
    ingest.ingest(jobs.message_stream(spark, landing), sinks, parts=_parts(spark, sf_dir))
    return sinks


@query
def stream_ingest(spark, sf_dir):
    return store.read_store(spark, _sinks(spark, sf_dir).store).select(*EVENT_COLUMNS)


@query
def stream_quarantine(spark, sf_dir):
    kept = ingest.read_quarantine(spark, _sinks(spark, sf_dir))
    return kept.select("message_id", "sent_at", "receive", "reject_reason")


@query
def stream_dead_letter(spark, sf_dir):
    return ingest.read_dead_letters(spark, _sinks(spark, sf_dir)).select("message_id", "receives", "reject_reason")


@lru_cache(maxsize=None)
def _late_receives(spark: SparkSession, sf_dir: str, version: tuple[int, int]) -> ingest.Sinks:
    """The sinks of messages whose receives were sent on different days and come in two batches."""
    landing, sinks = work_path(spark, "receives-landing"), ingest.Sinks(work_path(spark, "receives"))
    messages = driver_events.later_receives(driver_events.messages(_dealt_events(spark, sf_dir)))
    for part in (F.col("receive") <= 2, F.col("receive") > 2):
        messages.filter(part).write.mode("append").json(landing, compression=LANDING_CODEC)
        ingest.ingest(jobs.message_stream(spark, landing), sinks, parts=_parts(spark, sf_dir))
    return sinks


@query
def stream_dead_letter_days(spark, sf_dir):
    """Messages are counted by themselves, whenever their receives were sent and whichever batch they came in."""
    letters = ingest.read_dead_letters(spark, _late_receives(spark, sf_dir, _version(spark, sf_dir)))
    return letters.select("message_id", "receives", "reject_reason", F.col("batch").alias("letter_batch"))


@query
def dead_letter_days(spark, sf_dir):
    messages = driver_events.later_receives(driver_events.messages(_events(spark, sf_dir)))
    return quality.dead_letters(quality.parse_messages(messages)).drop("body")


@query
def archive_raw(spark, sf_dir):
    archived = ingest.parse_landed(ingest.read_archive(spark, _sinks(spark, sf_dir).archive))
    return archived.select("message_id", "sent_at", "receive", F.coalesce("reject_reason", F.lit("accepted")).alias("outcome"))


@query
def landed_quarantine(spark, sf_dir):
    """Rejects by reason, and how many characters of them are kept."""
    kept = ingest.read_quarantine(spark, _landed(spark, sf_dir, _version(spark, sf_dir)))
    broken = F.when(F.col("reject_reason") == "broken envelope", F.length("body")).otherwise(0)
    return kept.groupBy("reject_reason").agg(F.count("*").alias("row_count"), F.sum(broken).alias("broken_chars"))


@query
def landed_ingest(spark, sf_dir):
    return store.read_store(spark, _landed(spark, sf_dir, _version(spark, sf_dir)).store).select(*EVENT_COLUMNS)


@query
def landed_archive(spark, sf_dir):
    """The broken lines as archived, and the number of whole messages."""
    archived = ingest.read_archive(spark, _landed(spark, sf_dir, _version(spark, sf_dir)).archive)
    return archived.groupBy(F.col(jobs.BROKEN_LINE).alias("line")).agg(F.count("*").alias("row_count"), F.count("message_id").alias("message_count"))


@query
def landed_dead_letter(spark, sf_dir):
    letters = ingest.read_dead_letters(spark, _landed(spark, sf_dir, _version(spark, sf_dir)))
    return letters.select("message_id", "receives", "reject_reason")


@query
def stream_dedup(spark, sf_dir):
    return dedup.dedup(driver_events.deliveries(_stream(spark, sf_dir)), work_path(spark, "stream-dedup"), DELAY_SPAN, parts=_parts(spark, sf_dir)).drop("id")


@query
def stream_dedup_trace(spark, sf_dir):
    kept = dedup.dedup(driver_events.deliveries(_stream(spark, sf_dir)), work_path(spark, "stream-dedup-trace"), DELAY_SPAN, dedup.TRACE, _parts(spark, sf_dir))
    return kept.drop("id", "ts")


@query
def stream_error_rate(spark, sf_dir):
    return jobs.materialize(windows.stream_error_rate(_stream(spark, sf_dir), "5 minutes", DELAY), "stream-rate", _parts(spark, sf_dir))


@query
def stream_threshold_alerts(spark, sf_dir):
    return jobs.materialize(processors.stream_threshold_alerts(_stream(spark, sf_dir), RULES, DELAY), "stream-alerts", _parts(spark, sf_dir))


@query
def stream_alert_episodes(spark, sf_dir):
    return jobs.materialize(episodes.stream_alert_episodes(_stream(spark, sf_dir), DELAY), "stream-episodes", _parts(spark, sf_dir))


@query
def stream_error_sessions(spark, sf_dir):
    return jobs.materialize(processors.stream_error_sessions(_stream(spark, sf_dir), dt.timedelta(minutes=30), DELAY), "stream-sessions", _parts(spark, sf_dir))


@query
def stream_silent_services(spark, sf_dir):
    """Every hour from the day of the first event on in which a service was silent, and all hours of one that has no events at all."""
    events = _events(spark, sf_dir)
    since = events.agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz")).first()[0] or SPLIT
    known = quality.services_of(events).unionByName(spark.createDataFrame([("search-service",)], "service string"))
    return jobs.materialize(processors.stream_silent_services(_stream(spark, sf_dir), known, since, 60, DELAY), "stream-silent", _parts(spark, sf_dir))


@query
def stream_rolling_errors(spark, sf_dir):
    return jobs.materialize(processors.stream_rolling_errors(_stream(spark, sf_dir), DELAY, chunk=dt.timedelta(hours=6)), "stream-rolling", _parts(spark, sf_dir))


@query
def stream_error_spikes(spark, sf_dir):
    return jobs.materialize(processors.stream_error_spikes(_stream(spark, sf_dir), DELAY), "stream-spikes", _parts(spark, sf_dir))
