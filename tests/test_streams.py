import datetime as dt
import json
import os

import pytest

from faultline.functions.ranking import first_of_each
from faultline.operators import alerts, analytics, quality
from faultline.session import work_path
from faultline.sources import store
from faultline.streaming import dedup, episodes, ingest, jobs, windows
from tests.conftest import at, event, rows_of

DELAY = "10 minutes"


def landed(spark, events_of, *batches):
    """One file per batch, with file times in the order of the batches."""
    path = work_path(spark, "landed")
    for i, rows in enumerate(batches):
        events_of(rows).coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):
            full = os.path.join(path, name)
            if name.endswith(".parquet") and os.stat(full).st_mtime > 1_000_000_000:
                os.utime(full, (1_000_000 + i, 1_000_000 + i))
    return jobs.event_stream(spark, path, max_files=1)


def test_late_rows_are_left_out_and_open_windows_wait(spark, events_of):
    stream = landed(
        spark,
        events_of,
        [event(1, "2024-01-01 00:01:00", level="ERROR"), event(2, "2024-01-01 00:07:00")],
        [event(3, "2024-01-01 00:40:00")],
        # Rows are late by the watermark of the batch before.
        [event(4, "2024-01-01 00:41:00")],
        [event(5, "2024-01-01 00:02:00", level="ERROR"), event(6, "2024-01-01 00:42:00")],
    )
    got = jobs.materialize(windows.stream_error_rate(stream, "5 minutes", DELAY), "late")
    assert rows_of(got) == [
        ("a-service", at("2024-01-01 00:00:00"), 1, 1, 100.0),
        ("a-service", at("2024-01-01 00:05:00"), 1, 0, 0.0),
    ]


def test_copies_in_one_and_in_later_batches_are_dropped(spark, events_of):
    trace = "ab" * 18
    stream = landed(
        spark,
        events_of,
        [event(1, "2024-01-01 00:00:00", trace=trace), event(2, "2024-01-01 00:00:00", trace=trace.upper())],
        [event(3, "2024-01-01 00:00:00", trace=trace), event(4, "2024-01-01 00:00:01", trace=trace)],
    )
    got = dedup.dedup(stream, work_path(spark, "dedup"), dt.timedelta(minutes=10))
    assert rows_of(got, "trace_id", "ts") == [(trace, at("2024-01-01 00:00:00")), (trace, at("2024-01-01 00:00:01"))]


def test_trace_is_dropped_within_the_delay_only(spark, events_of):
    trace = "ab" * 18
    stream = landed(
        spark,
        events_of,
        [event(1, "2024-01-01 00:00:00", trace=trace)],
        [event(2, "2024-01-01 00:05:00", trace=trace)],
        [event(3, "2024-01-01 02:00:00", trace="cd" * 18)],
        [event(4, "2024-01-01 02:01:00", trace="ef" * 18)],
        [event(5, "2024-01-01 03:00:00", trace=trace)],
    )
    path = work_path(spark, "dedup-trace")
    got = dedup.dedup(stream, path, dt.timedelta(minutes=10), dedup.TRACE)
    assert rows_of(got, "id") == [(1,), (3,), (4,), (5,)]
    # A batch that is delivered again finds what it found the first time.
    dedup.dedup_batch(events_of([event(2, "2024-01-01 00:05:00", trace=trace)]), 1, path, dt.timedelta(minutes=10), dedup.TRACE)
    dedup.dedup_batch(events_of([event(5, "2024-01-01 03:00:00", trace=trace)]), 4, path, dt.timedelta(minutes=10), dedup.TRACE)
    assert rows_of(dedup.read_kept(spark, path), "id") == [(1,), (3,), (4,), (5,)]


def test_a_trace_with_a_third_of_all_rows_sends_one_a_task(spark, events_of):
    rows = [event(i, at("2024-01-01") + dt.timedelta(seconds=i), trace="ab" * 18 if i % 3 == 0 else None) for i in range(3000)]
    once = first_of_each(events_of(rows).repartition(6), ["trace_id"], ["ts", "id"])
    assert once.count() == 2001
    once.collect()
    sent, left = [], [once._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            left.append(node.plan())
        elif node.nodeName() == "Exchange":
            sent.append(node.metrics().apply("shuffleRecordsWritten").value())
        left += [node.children().apply(i) for i in range(node.children().size())]
    # All rows once, to spread them, then at most one row of the trace for each of six tasks.
    assert sorted(sent) == [2006, 3000]


def test_expired_keys_leave_with_a_merge(spark, events_of):
    path, wait = work_path(spark, "expiry"), dt.timedelta(minutes=10)
    for batch in range(17):
        dedup.dedup_batch(events_of([event(batch, at("2024-01-01") + dt.timedelta(minutes=5 * batch), trace="ab" * 18)]), batch, path, wait, dedup.TRACE)
    # A copy passes when the one kept before it is more than the delay away.
    assert rows_of(dedup.read_kept(spark, path), "id") == [(i,) for i in range(0, 17, 3)]


def hours(errors_per_hour, first_hour, first_id, service="a-service"):
    return [
        event(first_id + 10 * h + i, at("2024-01-01") + dt.timedelta(hours=first_hour + h, minutes=i), service=service,
              level="ERROR" if i < errors else "INFO")
        for h, errors in enumerate(errors_per_hour)
        for i in range(4)
    ]


def test_one_alert_per_episode_across_batches(spark, events_of):
    batches = [hours([0, 2], 0, 0), hours([3, 4, 0], 2, 100), hours([0, 2, 0, 0], 5, 200)]
    batches[0] += hours([4, 4], 0, 1000, "b-service")
    stream = landed(spark, events_of, *batches)
    got = jobs.materialize(episodes.stream_alert_episodes(stream, DELAY, 60, 2, 40.0), "episodes")
    assert rows_of(got) == [
        ("a-service", at("2024-01-01 01:00:00"), 4, 2),
        ("a-service", at("2024-01-01 06:00:00"), 4, 2),
        ("b-service", at("2024-01-01 00:00:00"), 4, 4),
    ]
    batch = alerts.alert_episodes(events_of(sum(batches, [])), 60, 2, 40.0)
    assert rows_of(batch, "service", "episode_start") == rows_of(got, "service", "episode_start")


def body(i, **changes):
    return json.dumps(
        {"id": i, "trace_id": f"{i:036d}", "service": "s", "host": "h", "level": "INFO", "ts": "2024-01-01 00:00:00"} | changes
    )


def message_file(spark, path, batch, rows):
    os.makedirs(path, exist_ok=True)
    name = f"{path}/{batch}.json"
    with open(name, "w") as out:
        for message_id, text, receive in rows:
            out.write(json.dumps({"message_id": message_id, "sent_at": "2024-01-01T00:00:00", "body": text, "receive": receive}) + "\n")
    os.utime(name, (1_000_000 + batch, 1_000_000 + batch))


@pytest.fixture(scope="module")
def ingested(spark):
    path, sinks = work_path(spark, "messages"), ingest.Sinks(work_path(spark, "sinks"))
    bad = body(2, level="FATAL")
    message_file(spark, path, 0, [("m1", body(1), 1), ("m2", bad, 1), ("m3", "no json", 1)])
    message_file(spark, path, 1, [("m1", body(1), 2), ("m2", bad, 2), ("m4", body(4, ts="2024-01-02 00:00:00"), 1)])
    message_file(spark, path, 2, [("m2", bad, 3), ("m5", body(5), 1)])
    message_file(spark, path, 3, [("m2", bad, 4)])
    ingest.ingest(jobs.message_stream(spark, path, max_files=1), sinks)
    return path, sinks


def contents(spark, sinks):
    return (
        rows_of(store.read_store(spark, sinks.store), "id"),
        rows_of(ingest.read_quarantine(spark, sinks), "message_id", "receive", "reject_reason", "batch"),
        rows_of(ingest.read_dead_letters(spark, sinks), "message_id", "receives", "batch"),
        rows_of(ingest.read_archive(spark, sinks.archive), "message_id", "receive", "body"),
    )


def test_messages_reach_each_sink(spark, ingested):
    _, sinks = ingested
    stored, quarantined, dead, archived = contents(spark, sinks)
    assert stored == [(1,), (4,), (5,)]
    assert [row[:3] for row in quarantined] == [(f"m2", n, "level unknown") for n in (1, 2, 3, 4)] + [("m3", 1, "malformed body")]
    # The third receive makes the dead letter; the fourth does not make another.
    assert dead == [("m2", 3, 2)]
    assert len(archived) == 9 and ("m3", 1, "no json") in archived
    files = [name for _, _, names in os.walk(sinks.archive) for name in names]
    assert files and all(name.endswith((".gz", "_SUCCESS", ".crc")) for name in files)


def test_repeating_batches_changes_nothing(spark, ingested):
    path, sinks = ingested
    before = contents(spark, sinks)
    for batch in (2, 0):
        messages = spark.read.schema(jobs.MESSAGE_SCHEMA).json(f"{path}/{batch}.json")
        ingest.ingest_batch(messages, batch, sinks)
    assert contents(spark, sinks) == before


def test_stream_and_batch_agree_on_good_rows(spark, ingested):
    path, sinks = ingested
    batch = quality.accepted(quality.parse_messages(spark.read.schema(jobs.MESSAGE_SCHEMA).json(path)))
    assert rows_of(quality.dedup_trace_ts(batch), "id") == rows_of(store.read_store(spark, sinks.store), "id")


def test_rate_of_closed_windows_is_the_batch_rate(spark, events_of):
    rows = hours([1, 2, 3, 0, 4], 0, 0) + hours([0, 1], 0, 500, "b-service")
    rows.sort(key=lambda r: r[5])
    stream = landed(spark, events_of, rows[:12], rows[12:])
    got = jobs.materialize(windows.stream_error_rate(stream, "5 minutes", DELAY), "rate")
    newest = max(r[5] for r in rows)
    closed = [
        row for row in rows_of(analytics.error_rate(events_of(rows)))
        if row[1] + dt.timedelta(minutes=5) <= newest - dt.timedelta(minutes=10)
    ]
    assert rows_of(got) == closed
