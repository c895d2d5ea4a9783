"""Generated log events, the same for any number of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.contract import EVENT_COLUMNS
from faultline.functions.timeframe import Moment, ntz

# Service names, the path of each service and its four calls.
SERVICES = (
    "auth-service",
    "payment-service",
    "order-service",
    "inventory-service",
    "notification-service",
)
CALLS = {
    "auth": ("login", "logout", "refresh", "verify"),
    "payments": ("charge", "refund", "methods", "webhook"),
    "orders": ("create", "status", "cancel", "list"),
    "inventory": ("check", "reserve", "restock", "sku"),
    "notifications": ("email", "sms", "push", "webhook"),
}
# Number of hosts and the form of their names.
HOSTS, HOST_NAME = 10, "host-%02d.ec2.internal"
# Upper bounds of the level shares, lognormal parameters, extra latency of an error.
LEVEL_BOUNDS = (("ERROR", 0.05), ("WARN", 0.20), ("INFO", 0.80))
LATENCY_MU, LATENCY_SIGMA = 3.6, 0.9
ERROR_PENALTIES = (0, 500, 1500, 5000)
# Newest possible time and length of the generated period.
PERIOD_END, PERIOD_SECONDS = "2026-10-03 00:00:00", 7 * 86400

def _uniform(salt: int, seed: int) -> Column:
    """A number in (0, 1) from the row id: 52 bits of a digest, offset by a half so that neither end occurs.

    The digest is of text, which any engine can repeat; each holds the bits of two numbers.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.lit(salt // 2), "id"))
    bits = F.conv(F.substring(digest, 1 + 16 * (salt % 2), 13), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / F.lit(float(2**52))


def _pick(values: tuple, salt: int, seed: int) -> Column:
    index = F.floor(_uniform(salt, seed) * len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)


def _message() -> Column:
    """What the event says of itself: how its call ended, after how long, and its number."""
    outcome = F.when(F.col("level") == "ERROR", "failed").when(F.col("level") == "WARN", "was slow").when(F.col("level") == "INFO", "done").otherwise("traced")
    return F.concat_ws(" ", F.element_at(F.split("endpoint", "/"), -1), outcome, F.concat(F.lit("after="), F.col("latency_ms"), F.lit("ms")), F.concat(F.lit("n="), F.col("id")))


def synthesize(ids: DataFrame, seed: int = 42, end: Moment = PERIOD_END, seconds: int = PERIOD_SECONDS) -> DataFrame:
    """One event per row of a frame with a column id."""
    level_draw = _uniform(3, seed)
    level = F.lit("DEBUG")
    for name, bound in reversed(LEVEL_BOUNDS):
        level = F.when(level_draw < bound, name).otherwise(level)

    paths = F.array(*[F.array(*[F.lit(f"/api/v1/{area}/{call}") for call in calls]) for area, calls in CALLS.items()])
    call = F.floor(_uniform(5, seed) * 4).cast("int") + 1

    # Box-Muller: two uniforms make one standard normal.
    normal = F.sqrt(-2 * F.log(_uniform(6, seed))) * F.cos(2 * F.pi() * _uniform(7, seed))
    base = F.floor(F.exp(LATENCY_MU + LATENCY_SIGMA * normal)).cast("int")
    penalty = F.when(F.col("level") == "ERROR", _pick(ERROR_PENALTIES, 8, seed)).otherwise(0)

    offset_ms = F.floor(_uniform(4, seed) * (seconds * 1000))
    start = ntz(end) - F.make_dt_interval(secs=F.lit(seconds))
    digest = F.md5(F.concat_ws(":", F.lit(seed), "id"))
    trace = F.concat_ws("-", *[F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    service_index = F.floor(_uniform(1, seed) * len(SERVICES)).cast("int") + 1
    return (
        ids.select("id")
        .withColumns(
            {
                "trace_id": trace,
                "_service": service_index,
                "host": F.format_string(HOST_NAME, F.floor(_uniform(2, seed) * HOSTS).cast("int") + 1),
                "level": level,
                "ts": start + F.make_dt_interval(secs=(offset_ms / 1000).cast("decimal(18,6)")),
            }
        )
        .withColumns(
            {
                "service": F.element_at(F.array(*[F.lit(s) for s in SERVICES]), F.col("_service")),
                "endpoint": F.element_at(F.element_at(paths, F.col("_service")), call),
                "latency_ms": base + penalty,
            }
        )
        .withColumn("message", _message())
        .select(*EVENT_COLUMNS)
    )


def synthetic_events(spark: SparkSession, rows: int, seed: int = 42) -> DataFrame:
    return synthesize(spark.range(rows), seed)
