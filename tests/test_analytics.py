import datetime as dt

from faultline.contract import level_rank
from faultline.functions import exact
from faultline.functions.timeframe import time_range
from faultline.operators import analytics
from faultline.operators.audit import schema_check
from faultline.operators.latency import latency_change, latency_summary
from faultline.operators.quality import services_of, silent_services
from tests.conftest import at, event, rows_of


def test_level_rank_follows_severity(spark):
    df = spark.createDataFrame([(l,) for l in ("WARN", "ERROR", "DEBUG", "INFO")], "level string")
    assert [r.level for r in df.orderBy(level_rank("level")).collect()] == ["DEBUG", "INFO", "WARN", "ERROR"]


def test_rounding_goes_half_away_from_zero(spark):
    df = spark.createDataFrame([(1, 800), (1, 3), (2, 3), (0, 5), (5, 5), (0, 0), (201, 40000)], "e bigint, t bigint")
    got = [r[0] for r in df.select(exact.percent("e", "t")).collect()]
    assert got == [0.13, 33.33, 66.67, 0.0, 100.0, None, 0.5]
    means = spark.createDataFrame([(2001, 200), (1, 3), (0, 0)], "s bigint, n bigint")
    assert [r[0] for r in means.select(exact.mean("s", "n")).collect()] == [10.01, 0.33, None]


def test_range_is_half_open(events_of):
    times = ["2024-01-01 23:59:59.999", "2024-01-02 00:00:00", "2024-01-02 23:59:59.999", "2024-01-03 00:00:00"]
    df = events_of([event(i, ts) for i, ts in enumerate(times)])
    assert rows_of(time_range(df, "2024-01-02", "2024-01-03"), "id") == [(1,), (2,)]
    assert rows_of(time_range(df, "2024-01-02"), "id") == [(1,), (2,), (3,)]
    assert rows_of(time_range(df), "id") == [(0,), (1,), (2,), (3,)]


def test_buckets_start_on_the_edge_and_empty_ones_are_absent(events_of):
    df = events_of(
        [
            event(1, "2024-01-01 00:04:59.999", level="ERROR"),
            event(2, "2024-01-01 00:05:00"),
            event(3, "2024-01-01 00:05:00.001", level="ERROR"),
            event(4, "2024-01-01 00:20:00"),
        ]
    )
    assert rows_of(analytics.error_rate(df)) == [
        ("a-service", at("2024-01-01 00:00:00"), 1, 1, 100.0),
        ("a-service", at("2024-01-01 00:05:00"), 2, 1, 50.0),
        ("a-service", at("2024-01-01 00:20:00"), 1, 0, 0.0),
    ]


def test_equal_rounded_averages_share_a_rank_and_nulls_do_not_count(events_of):
    rows = []
    # 10.0025 and 10.001 both round to 10.00; the third endpoint is slower, the fourth faster.
    for endpoint, values in {
        "/a": [10] * 399 + [11],
        "/b": [10] * 999 + [11],
        "/c": [20, None, None],
        "/d": [5],
    }.items():
        rows += [event(len(rows) + i, endpoint=endpoint, latency=v) for i, v in enumerate(values)]
    got = rows_of(analytics.slowest_endpoints(events_of(rows)), "endpoint", "call_count", "avg_latency_ms", "latency_rank")
    assert got == [("/a", 400, 10.0, 2), ("/b", 1000, 10.0, 2), ("/c", 3, 20.0, 1), ("/d", 1, 5.0, 3)]
    top = analytics.slowest_endpoints(events_of(rows), k=2)
    assert rows_of(top, "endpoint") == [("/a",), ("/b",), ("/c",)]


def test_endpoint_without_latency_has_no_average(events_of):
    got = analytics.slowest_endpoints(events_of([event(1, latency=None)])).first()
    assert (got.call_count, got.avg_latency_ms, got.max_latency_ms) == (1, None, None)


def test_lookups_are_ordered_and_limited(events_of):
    df = events_of([event(i, f"2024-01-01 00:00:{59 - i % 30:02d}", level="ERROR" if i % 2 else "INFO") for i in range(200)])
    got = analytics.range_lookup(df, "a-service", "2024-01-01", "2024-01-02").collect()
    assert len(got) == 100 and [(r.ts, r.id) for r in got] == sorted((r.ts, r.id) for r in got)
    errors = analytics.error_lookup(df, "a-service", "2024-01-01", "2024-01-02", limit=150).collect()
    assert len(errors) == 100 and {r.level for r in errors} == {"ERROR"}


def test_service_filter_exact_and_loose(events_of):
    df = events_of([event(1, service="payment-service"), event(2, service="Payment-Sérvice "), event(3, service="other")])
    assert rows_of(analytics.of_service(df, "payment-service"), "id") == [(1,)]
    assert rows_of(analytics.of_service(df, "payment-service", loose=True), "id") == [(1,), (2,)]


def test_alert_counts_from_the_newest_event(events_of):
    df = events_of(
        [
            event(1, "2024-01-01 00:00:00", level="ERROR"),
            event(2, "2024-01-01 00:05:00", level="ERROR"),
            event(3, "2024-01-01 00:10:00"),
            event(4, "2024-01-01 00:04:59.999", service="b-service"),
        ]
    )
    assert rows_of(analytics.alert_error_rate(df)) == [("a-service", 2, 1, 50.0)]
    assert rows_of(analytics.alert_error_rate(df, as_of="2024-01-01 01:00:00")) == []
    assert rows_of(analytics.alert_error_rate(df.limit(0))) == []


def test_silent_services_have_a_row(events_of):
    df = events_of([event(1, "2024-01-01 00:00:00", service="gone"), event(2, "2024-01-01 00:10:00")])
    got = silent_services(df, services_of(df), at("2024-01-01 00:05:00"))
    assert rows_of(got) == [("a-service", 1, False), ("gone", 0, True)]


def test_medians_and_verdicts(events_of):
    split = dt.datetime(2024, 1, 2)
    rows = []
    for endpoint, before, after in (("/b", [10, 20], [10]), ("/s", [10], [11]), ("/w", [10], [12, 12]), ("/new", [], [1])):
        for day, values in (("2024-01-01", before), ("2024-01-02", after)):
            rows += [event(len(rows) + i, day, endpoint=endpoint, latency=v) for i, v in enumerate(values)]
    got = rows_of(latency_change(events_of(rows), split), "endpoint", "before_ms", "after_ms", "verdict")
    assert got == [("/b", 15.0, 10.0, "better"), ("/s", 10.0, 11.0, "same"), ("/w", 10.0, 12.0, "worse")]
    summary = rows_of(latency_summary(events_of(rows)), "endpoint", "median_latency_ms", "min_latency_ms", "max_latency_ms")
    assert summary[0] == ("/b", 10.0, 10, 20)


def test_schema_check_counts_what_breaks(spark):
    df = spark.createDataFrame(
        [(1, "x" * 36, None, "h" * 65, "FATAL"), (2, "short", "s", "h", "INFO")],
        "id bigint, trace_id string, service string, host string, level string",
    )
    got = {r.column_name: r for r in schema_check(df).collect()}
    assert [got[c].broken_rows for c in ("trace_id", "service", "host", "level")] == [1, 1, 1, 1]
    assert got["ts"].stored_type == "missing" and got["ts"].broken_rows == 2
    assert got["host"].max_length == 65 and got["id"].null_rows == 0
