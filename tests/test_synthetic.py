import pytest

from faultline.contract import EVENT_SCHEMA
from faultline.operators import analytics
from faultline.sources.synthetic import CALLS, SERVICES, synthesize, synthetic_events
from tests.conftest import at

ROWS = 200_000


@pytest.fixture(scope="module")
def data(spark):
    frame = synthetic_events(spark, ROWS).cache()
    yield frame
    frame.unpersist()


def test_follows_the_contract(data):
    assert dict(data.dtypes) == {f.name: f.dataType.simpleString() for f in EVENT_SCHEMA}
    lo, hi, traces, widths = data.selectExpr("min(ts)", "max(ts)", "count(DISTINCT trace_id)", "max(length(trace_id))").first()
    assert at("2026-09-26") <= lo and hi < at("2026-10-03") and (traces, widths) == (ROWS, 36)


def test_does_not_depend_on_partitions(spark):
    one = synthesize(spark.range(0, 500, 1, 1))
    many = synthesize(spark.range(0, 500, 1, 7))
    assert one.exceptAll(many).count() == 0
    assert one.exceptAll(synthesize(spark.range(500), seed=1)).count() == 500


def test_shares_and_latency(data):
    shares = {r.level: r["count"] / ROWS for r in data.groupBy("level").count().collect()}
    for level, share in (("ERROR", 0.05), ("WARN", 0.15), ("INFO", 0.60), ("DEBUG", 0.20)):
        assert abs(shares[level] - share) < 0.005
    services = data.groupBy("service").count().collect()
    assert {r.service for r in services} == set(SERVICES)
    assert all(abs(r["count"] / ROWS - 0.2) < 0.005 for r in services)
    median, mean = data.filter("level <> 'ERROR'").selectExpr("median(latency_ms)", "avg(latency_ms)").first()
    assert 35 <= median <= 37 and 52 <= mean <= 56
    assert 1650 < data.filter("level = 'ERROR'").selectExpr("avg(latency_ms)").first()[0] - mean < 1850
    assert data.select("host").distinct().count() == 10


def test_shapes_of_the_published_plans(data):
    week = ("2026-09-26", "2026-10-03")
    assert analytics.error_rate(data, "payment-service", "2026-10-02", "2026-10-03").count() == 288
    assert analytics.errors_per_hour(data, "payment-service", *week).count() == 168
    endpoints = analytics.slowest_endpoints(data, "auth-service", *week).collect()
    assert {r.endpoint for r in endpoints} == {f"/api/v1/auth/{call}" for call in CALLS["auth"]}
    assert analytics.p95_latency(data, "order-service", *week).count() == 1
    assert analytics.alert_error_rate(data, "payment-service").count() == 1
    assert analytics.range_lookup(data, "inventory-service", "2026-10-01 12:00:00", "2026-10-01 14:00:00").count() == 100
