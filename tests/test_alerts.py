import datetime as dt
import random

import pytest

from faultline.operators import alerts, analytics
from tests.conftest import at, event, rows_of

MINUTES = dt.timedelta(minutes=1)


@pytest.fixture(scope="module")
def busy(events_of):
    """Events around chunk edges, at equal times, before 1970 and in one service with most rows."""
    rng = random.Random(3)
    rows = []
    for base in (at("2024-01-01 00:00:00"), at("1969-12-31 23:50:00")):
        for i in range(250):
            offset = dt.timedelta(milliseconds=rng.choice([rng.randrange(1_800_000), 300_000 * rng.randrange(6), 299_999, 300_001]))
            service = "hot" if rng.random() < 0.7 else "cold"
            rows.append(event(len(rows), base + offset, service=service, level="ERROR" if rng.random() < 0.4 else "INFO"))
    return events_of(rows)


@pytest.mark.parametrize("window", [dt.timedelta(minutes=5), dt.timedelta(seconds=7)])
def test_rolling_errors_equal_brute_force(busy, window):
    events = busy.collect()
    expected = sorted(
        (e.id, sum(o.service == e.service and o.level == "ERROR" and e.ts - window <= o.ts <= e.ts for o in events))
        for e in events
    )
    assert rows_of(alerts.rolling_errors(busy, window), "id", "errors_in_window") == expected


def test_rolling_errors_are_cut_by_time(busy):
    plan = alerts.rolling_errors(busy)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_chunk" in line for line in windows)
    # What the windows run over is one row per (service, time).
    assert "keys=[service" in plan and "partial_count" in plan


def test_sliding_windows_equal_direct_ones(busy):
    from pyspark.sql import functions as F

    direct = busy.groupBy("service", F.window("ts", "5 minutes", "1 minute").start.alias("w")).agg(*analytics.error_counts())
    got = alerts.sliding_error_rate(busy)
    assert rows_of(got, "service", "window_start", "total_events", "error_events") == rows_of(direct)


def test_rollup_answers_the_queries(busy):
    rollup = alerts.rollup_minute(busy)
    assert rows_of(alerts.error_rate_from_rollup(rollup)) == rows_of(analytics.error_rate(busy))
    assert rows_of(alerts.errors_per_hour_from_rollup(rollup)) == rows_of(analytics.errors_per_hour(busy))


def windows_with_errors(*errors_per_hour, total=4, service="a-service", first=0):
    rows = []
    for hour, errors in enumerate(errors_per_hour):
        for i in range(total):
            when = at("2024-01-01") + dt.timedelta(hours=hour, minutes=i)
            rows.append(event(first + len(rows), when, service=service, level="ERROR" if i < errors else "INFO"))
    return rows


def test_one_row_per_episode(events_of):
    df = events_of(windows_with_errors(0, 2, 3, 4, 0, 0, 2))
    got = alerts.alert_episodes(df, minutes=60, min_events=2, max_error_pct=40.0)
    assert rows_of(got) == [
        ("a-service", at("2024-01-01 01:00:00"), at("2024-01-01 04:00:00"), 3, 12, 9),
        ("a-service", at("2024-01-01 06:00:00"), at("2024-01-01 07:00:00"), 1, 4, 2),
    ]


def test_hour_without_events_ends_an_episode(events_of):
    rows = [r for r in windows_with_errors(4, 4, 4) if r[5].hour != 1]
    assert alerts.alert_episodes(events_of(rows)).count() == 2


def test_rules_by_service_and_for_all(events_of):
    df = events_of(windows_with_errors(2, 0, 3) + windows_with_errors(0, 4, service="b-service", first=100))
    rules = [
        alerts.Rule("any", 60, 4, 60.0),
        alerts.Rule("half", 30, 1, 49.9, service="a-service"),
        alerts.Rule("too few", 60, 5, 0.0),
        alerts.Rule("day", 1440, 1, 50.0),
    ]
    got = alerts.threshold_alerts(df, rules)
    assert rows_of(got, "rule", "service", "window_start", "error_events") == [
        ("any", "a-service", at("2024-01-01 02:00:00"), 3),
        ("any", "b-service", at("2024-01-01 01:00:00"), 4),
        ("half", "a-service", at("2024-01-01 00:00:00"), 2),
        ("half", "a-service", at("2024-01-01 02:00:00"), 3),
    ]


def test_rules_carry_no_hint_and_join_by_equality(events_of):
    found = alerts.threshold_alerts(events_of(windows_with_errors(4)), [alerts.Rule("any", 60, 1, 1.0)])
    assert "broadcast" not in found._jdf.queryExecution().logical().toString().lower()
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString() and found.count()


def test_spike_needs_history_and_counts_empty_windows_as_zero(events_of):
    rows = windows_with_errors(9, 1, 1, 1, 5, 3, total=10)
    got = alerts.error_spikes(events_of(rows), minutes=60, history=3, factor=3, min_errors=3)
    assert rows_of(got) == [("a-service", at("2024-01-01 04:00:00"), 5, 3)]
    gap = [r for r in rows if r[5].hour not in (1, 2)]
    sparse = alerts.error_spikes(events_of(gap), minutes=60, history=3, factor=3, min_errors=3)
    assert rows_of(sparse) == [("a-service", at("2024-01-01 04:00:00"), 5, 1)]


def test_sessions_join_up_to_the_gap(events_of):
    times = ["00:00:00", "00:29:59", "00:59:59", "01:29:59.001", "03:00:00"]
    df = events_of([event(i, f"2024-01-01 {t}", level="ERROR") for i, t in enumerate(times)] + [event(9, "2024-01-01 02:00:00")])
    assert rows_of(alerts.error_sessions(df)) == [
        ("a-service", at("2024-01-01 00:00:00"), at("2024-01-01 01:29:59"), 3),
        ("a-service", at("2024-01-01 01:29:59.001"), at("2024-01-01 01:59:59.001"), 1),
        ("a-service", at("2024-01-01 03:00:00"), at("2024-01-01 03:30:00"), 1),
    ]


def test_sessions_equal_the_built_in_ones(busy):
    from pyspark.sql import functions as F

    built_in = (
        busy.filter("level = 'ERROR'")
        .groupBy("service", F.session_window("ts", "5 seconds").alias("w"))
        .agg(F.count("*").alias("n"))
        .select("service", "w.start", "w.end", "n")
    )
    got = alerts.error_sessions(busy, dt.timedelta(seconds=5))
    assert rows_of(got) == rows_of(built_in)
