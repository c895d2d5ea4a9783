import json

import pytest

from faultline.operators import quality
from faultline.operators.audit import level_mix
from tests.conftest import at, event, rows_of

TRACE = "ab" * 18


@pytest.fixture(scope="module")
def duplicates(events_of):
    return events_of(
        [
            event(3, trace=TRACE),
            event(1, trace=TRACE.upper()),
            event(2, "2024-01-01 00:00:01", trace=TRACE),
            event(4, "2024-01-01 00:00:00.0004", trace=TRACE),
            event(5, trace="cd" * 18),
        ]
    )


def test_first_write_of_trace_and_time_stays(duplicates):
    assert rows_of(quality.dedup_trace_ts(duplicates), "id") == [(1,), (2,), (5,)]


def test_earliest_row_of_a_trace_stays(duplicates):
    assert rows_of(quality.dedup_trace(duplicates), "id") == [(1,), (5,)]


def test_copies_are_reduced_before_the_shuffle(duplicates):
    """A (trace, time) with a third of all rows sends one row per map task."""
    for df in (quality.dedup_trace_ts(duplicates), quality.dedup_trace(duplicates)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        before, after = plan.index("row_number(), 1, Final"), plan.index("row_number(), 1, Partial")
        assert before < plan.index("Exchange hashpartitioning") < after


def test_retry_audit_lists_traces_with_two_times(duplicates):
    assert rows_of(quality.retry_audit(duplicates)) == [
        (TRACE, 2, 4, at("2024-01-01 00:00:00"), at("2024-01-01 00:00:01"), 1000)
    ]


def body(**changes):
    sound = {"id": 1, "trace_id": TRACE, "service": "s", "host": "h", "level": "INFO", "ts": "2024-01-01 00:00:00.123",
             "message": "m", "latency_ms": 5, "endpoint": "/x"}
    return json.dumps({k: v for k, v in (sound | changes).items() if v is not ...})


BODIES = {
    "ok": (body(), None),
    "no-id": (body(id=...), None),
    "ok-nulls": (body(message=None, latency_ms=..., endpoint=None), None),
    "iso": (body(ts="2024-01-01T00:00:00.123"), None),
    "level": (body(level="FATAL"), "level unknown"),
    "no-level": (body(level=None), "level missing"),
    "no-service": (body(service=...), "service missing"),
    "service-64": (body(service="s" * 64), None),
    "service-65": (body(service="s" * 65), "service too long"),
    "host-65": (body(host="h" * 65), "host too long"),
    "no-host": (body(host=None), "host missing"),
    "trace-35": (body(trace_id="x" * 35), "trace_id length"),
    "no-trace": (body(trace_id=...), "trace_id missing"),
    "endpoint-129": (body(endpoint="e" * 129), "endpoint too long"),
    "ts": (body(ts="yesterday"), "ts missing or invalid"),
    "no-ts": (body(ts=...), "ts missing or invalid"),
    "cut": (body()[:-1], "malformed body"),
    "word": ("no json", "malformed body"),
    "latency": (body(latency_ms="fast"), "malformed body"),
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(name, at("2024-01-01"), text, 1) for name, (text, _) in BODIES.items()]
    return quality.parse_messages(spark.createDataFrame(rows, "message_id string, sent_at timestamp_ntz, body string, receive int"))


def test_each_broken_rule_is_named(parsed):
    assert {r.message_id: r.reject_reason for r in parsed.collect()} == {name: reason for name, (_, reason) in BODIES.items()}


def test_good_and_rejected_rows_are_all_rows(parsed):
    good = quality.accepted(parsed)
    bad = quality.rejected(parsed, ["message_id", "body"])
    assert good.count() + bad.count() == len(BODIES)
    assert {r.ts for r in good.collect()} == {at("2024-01-01 00:00:00.123")}
    assert {r.message_id: r.body for r in bad.collect()}["cut"] == BODIES["cut"][0]
    counts = {r.outcome: r.row_count for r in quality.quarantine_counts(parsed).collect()}
    assert counts["accepted"] == 5 and counts["malformed body"] == 3 and sum(counts.values()) == len(BODIES)


def test_event_without_id_is_numbered_by_its_key(parsed):
    from pyspark.sql import functions as F

    got = parsed.filter("message_id = 'no-id'").select("id", F.xxhash64("trace_id", "ts").alias("key")).first()
    assert got.id == got.key


def test_body_is_parsed_once(parsed):
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_third_receive_of_a_bad_message_is_a_dead_letter(spark):
    rows = [(f"bad-{n}", at("2024-01-01"), "no json", i) for n in (1, 2, 3, 4) for i in range(n)]
    rows += [("good", at("2024-01-01"), body(), i) for i in range(4)]
    messages = spark.createDataFrame(rows, "message_id string, sent_at timestamp_ntz, body string, receive int")
    got = quality.dead_letters(quality.parse_messages(messages))
    assert rows_of(got) == [("bad-3", 3, "malformed body", "no json"), ("bad-4", 4, "malformed body", "no json")]


def test_level_mix_flags_shares_out_of_tolerance(events_of):
    levels = ["ERROR"] * 5 + ["WARN"] * 25 + ["INFO"] * 50 + ["DEBUG"] * 20
    df = events_of([event(i, level=level) for i, level in enumerate(levels)])
    got = rows_of(level_mix(df, {"ERROR": 5, "WARN": 15, "INFO": 60, "DEBUG": 20}), "level", "share_pct", "within_tolerance")
    assert got == [("DEBUG", 20.0, True), ("ERROR", 5.0, True), ("INFO", 50.0, False), ("WARN", 25.0, False)]
