"""Inputs that the tables of the driver never hold: offsets, broken lines, no times, clocks that run apart, many days."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from faultline.__main__ import main
from faultline.functions import exact
from faultline.operators import alerts, analytics, latency, quality
from faultline.session import work_path
from faultline.sources import store
from faultline.streaming import ingest, jobs
from tests.conftest import at, event, rows_of


def test_means_round_away_from_zero(spark):
    frame = spark.createDataFrame([(-10, 3), (10, 3), (-1, 200), (1, 200), (0, 5), (7, 0)], "total bigint, n bigint")
    got = [r[0] for r in frame.select(exact.mean("total", "n")).collect()]
    assert got == [-3.33, 3.33, -0.01, 0.01, 0.0, None]


def test_a_past_moment_does_not_see_what_follows(events_of):
    rows = [event(1, "2024-01-01 00:00:30", level="ERROR"), event(2, "2024-01-01 00:01:00"), event(3, "2024-01-01 12:00:00", level="ERROR"), event(4, "2024-01-02")]
    got = analytics.alert_error_rate(events_of(rows), as_of="2024-01-01 00:01:00")
    assert rows_of(got) == [("a-service", 2, 1, 50.0)]


def test_offsets_are_honoured(spark):
    body = json.dumps({"trace_id": "a" * 36, "service": "s", "host": "h", "level": "INFO", "ts": "2024-01-15T00:30:00+05:00"})
    messages = spark.createDataFrame([("m", None, body, 1)], jobs.MESSAGE_SCHEMA)
    assert quality.parse_messages(messages).first()["ts"] == at("2024-01-14 19:30:00")


def test_nothing_that_lands_is_lost(spark, tmp_path):
    landing, sinks = str(tmp_path / "landing"), ingest.Sinks(work_path(spark, "probe"))
    bad = json.dumps({"message_id": "bad", "body": "{}", "receive": 0})
    cut = '{"message_id": "cut", "body": "{'
    good = json.dumps({"message_id": "good", "sent_at": "2024-01-01T00:00:00", "receive": 1, "body": json.dumps({"trace_id": "a" * 36, "service": "s", "host": "h", "level": "INFO", "ts": "2024-01-01 00:00:00"})})
    for batch in ([bad, good, cut], [bad, "no json"], [bad], [bad]):
        spark.createDataFrame([(line,) for line in batch], "value string").coalesce(1).write.mode("append").text(landing)
    ingest.ingest(jobs.message_stream(spark, landing, max_files=1), sinks)
    kept = ingest.read_quarantine(spark, sinks)
    assert sorted(r["body"] for r in kept.filter("reject_reason = 'broken envelope'").collect()) == sorted([cut, "no json"])
    assert kept.filter("message_id = 'bad'").count() == 4
    letters = ingest.read_dead_letters(spark, sinks).collect()
    assert [(r["message_id"], r["receives"], r["body"]) for r in letters] == [("bad", 3, "{}")]
    archived = ingest.read_archive(spark, sinks.archive).collect()
    assert sorted(r[jobs.BROKEN_LINE] for r in archived if r[jobs.BROKEN_LINE]) == sorted([cut, "no json"])
    assert len(archived) == 7 and store.read_store(spark, sinks.store).count() == 1


def test_a_batch_reads_the_days_it_is_about(spark):
    sinks = ingest.Sinks(work_path(spark, "days"))
    rows = [(f"m{i}", at(f"2024-01-{1 + i:02d}"), "{", 1) for i in range(20)] + [("none", None, "{", 1)]
    ingest.ingest_batch(spark.createDataFrame(rows, jobs.MESSAGE_SCHEMA), 0, sinks)
    day = ingest.read_quarantine_days(spark, sinks, dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    assert rows_of(day, "message_id") == [("m4",), ("m5",), ("none",)]
    assert len(day.inputFiles()) == 3
    for batch in (1, 2, 2):
        again = spark.createDataFrame([("m4", at("2024-01-05"), "{", batch + 1)], jobs.MESSAGE_SCHEMA)
        ingest.ingest_batch(again, batch, sinks)
    assert rows_of(ingest.read_dead_letters(spark, sinks), "message_id", "receives") == [("m4", 3)]
    assert ingest.read_quarantine(spark, sinks).count() == 23


def test_settings_are_put_back(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with pytest.raises(KeyError), jobs.settings(spark, {name: "77", "spark.faultline.none": "1"}):
        assert spark.conf.get(name) == "77"
        raise KeyError
    assert spark.conf.get(name) == before and spark.conf.get("spark.faultline.none", None) is None


def test_medians_walk_histograms(events_of):
    values = [-5, -5, 0, 70_000, None, 1 << 30, 3]
    rows = [event(i, latency=v, endpoint="/x" if i < 5 else None) for i, v in enumerate(values)]
    got = latency.latency_summary(events_of(rows))
    assert {r["endpoint"]: r["median_latency_ms"] for r in got.collect()} == {"/x": -2.5, None: ((1 << 30) + 3) / 2}
    assert "percentile(" not in got._jdf.queryExecution().executedPlan().toString()


def test_row_numbers_cross_high_bits(events_of):
    values = [5, 1 << 20, -(1 << 20), 5, None, 1 << 20]
    got = latency.latency_row_numbers(events_of([event(i, latency=v) for i, v in enumerate(values)]))
    assert [r["rn"] for r in got.orderBy("id").collect()] == [3, 5, 2, 4, 1, 6]


def test_rules_of_one_length_share_its_windows(events_of):
    rules = [alerts.Rule(f"r{i}", 60, 1, 1.0, None if i % 2 else "a-service") for i in range(6)] + [alerts.Rule("other", 60, 1, 1.0, "b-service")]
    found = alerts.threshold_alerts(events_of([event(1, level="ERROR"), event(2)]), rules)
    assert sorted(r["rule"] for r in found.collect()) == [f"r{i}" for i in range(6)]


def test_verify_lists_every_day(spark, events_of, capsys):
    path = work_path(spark, "sixty")
    start = dt.datetime(2024, 1, 1)
    store.append_batch(events_of([event(i, start + dt.timedelta(days=i)) for i in range(60)]), path)
    main(["verify", "--path", path])
    assert sum("2024-" in line and "p2024" in line for line in capsys.readouterr().out.splitlines()) == 60
    with pytest.raises(SystemExit):
        main(["query", "events", "--path", path])
    main(["retain", "--path", path, "--days", "3", "--dry-run"])
    assert len(store.day_directories(spark, path)) == 60 and "2024-02-25" in capsys.readouterr().out


def test_generate_adds_and_loose_service(spark, capsys):
    path = work_path(spark, "twice")
    main(["generate", "--path", path, "--rows", "1000"])
    main(["generate", "--path", path, "--rows", "500", "--seed", "7"])
    assert store.read_store(spark, path).count() == 1500
    capsys.readouterr()
    main(["query", "p95", "--path", path, "--service", "AUTH-Service ", "--loose"])
    assert "auth-service" in capsys.readouterr().out


def test_rollup_of_touched_days(spark, events_of):
    path, rollup = work_path(spark, "stored"), work_path(spark, "rolled")
    for batch in ([event(1), event(2, "2024-01-03")], [event(3, "2024-01-03 00:00:10", level="ERROR")]):
        store.append_batch(events_of(batch), path)
        alerts.update_rollup(rollup, store.read_store(spark, path), events_of(batch))
    table = spark.read.parquet(rollup)
    assert table.agg(F.sum("event_count")).first()[0] == 3
    assert rows_of(alerts.alert_from_rollup(table, dt.timedelta(minutes=5), "2024-01-03 00:00:30")) == [("a-service", 2, 1, 50.0)]
