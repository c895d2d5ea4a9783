"""Percentile forms of Q2 and latency summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.contract import LEVELS
from faultline.functions.ranking import median, median_of_ranks, median_ranks, nearest_rank, row_numbers, target_rank, value_counts, value_runs, values_at
from faultline.functions.timeframe import Moment, ntz


def latency_row_numbers(events: DataFrame) -> DataFrame:
    """ROW_NUMBER and COUNT over each service by latency, for every event; ties by id."""
    return row_numbers(events, "service", "latency_ms", "id")


def p95_row_number(events: DataFrame, q: str = "0.95") -> DataFrame:
    """The value whose row numbers include CEIL(q * cnt)."""
    rank = target_rank(q, F.col("cnt"))
    return (
        value_runs(value_counts(events, ["service"], "latency_ms"), ["service"], "latency_ms")
        .filter((F.col("first_rn") <= rank) & (rank <= F.col("last_rn")))
        .select("service", rank.alias("rn"), "cnt", F.col("latency_ms").alias("p95_latency_ms"))
    )


def p95_histogram(events: DataFrame, q: str = "0.95") -> DataFrame:
    return nearest_rank(events, ["service"], "latency_ms", q, "p95_latency_ms")


def p95_disc(events: DataFrame, q: str = "0.95") -> DataFrame:
    """PERCENTILE_DISC: as nearest rank, but NULL latencies do not count.

    The built-in aggregate ends with the whole value map of a service in one task from every map task;
    the histogram combines those counts across tasks first.
    """
    known = events.filter(F.col("latency_ms").isNotNull())
    return nearest_rank(known, ["service"], "latency_ms", q, "p95_latency_ms")


def p95_approx(events: DataFrame, q: float = 0.95, sketch_size: int = 800, parts: int = 64) -> DataFrame:
    """A KLL sketch per service, merged in two steps so that no task merges the sketches of all map tasks.

    With size 800 the rank is off by about 0.3% of the rows. NULL latencies are not counted, as in PERCENTILE_DISC. Sketches are
    random, so the value may differ from run to run; approx_rank_error says how far it is off.
    """
    part = F.spark_partition_id() % parts
    return (
        events.groupBy("service", part.alias("_part"))
        .agg(F.kll_sketch_agg_bigint(F.col("latency_ms").cast("bigint"), F.lit(sketch_size)).alias("_sketch"))
        .groupBy("service")
        .agg(F.kll_merge_agg_bigint("_sketch", F.lit(sketch_size)).alias("_sketch"))
        .select("service", F.kll_sketch_get_quantile_bigint("_sketch", F.lit(q)).cast("int").alias("p95_latency_ms"))
    )


def approx_rank_error(events: DataFrame, q: float = 0.95, most: float = 0.01) -> DataFrame:
    """Whether the sketch's value stands within `most` of the rank q, per service."""
    known = events.filter(F.col("latency_ms").isNotNull())
    shares = (
        known.join(p95_approx(known, q), "service")
        .groupBy("service")
        .agg(
            (F.count_if(F.expr("latency_ms < p95_latency_ms")) / F.count("*")).alias("_below"),
            (F.count_if(F.expr("latency_ms <= p95_latency_ms")) / F.count("*")).alias("_upto"),
        )
    )
    return shares.select("service", ((F.col("_below") <= q + most) & (F.col("_upto") >= q - most)).alias("within_one_percent"))


def latency_summary(events: DataFrame) -> DataFrame:
    """Median, minimum and maximum latency per service and endpoint."""
    keys = ["service", "endpoint"]
    known = events.filter(F.col("latency_ms").isNotNull())
    # All four are ranks of one histogram.
    ranks = median_ranks() | {"min_latency_ms": F.lit(1), "max_latency_ms": F.col("cnt")}
    found = values_at(known, keys, "latency_ms", ranks)
    return found.select(*keys, median_of_ranks("median_latency_ms"), "min_latency_ms", "max_latency_ms")


def latency_pivot(events: DataFrame) -> DataFrame:
    """Median latency, one row per endpoint and one column per level."""
    keys = ["service", "endpoint"]
    found = median(events, [*keys, "level"], "latency_ms", "_median")
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("level") == level, F.col("_median"))).alias(level.lower()) for level in LEVELS])


def midpoint(events: DataFrame) -> dt.datetime:
    """Half of the period the events cover, cut to the second."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    return (first + (last - first) / 2).replace(microsecond=0)


def latency_change(events: DataFrame, split: Moment) -> DataFrame:
    """Median per endpoint before and from `split`, their ratio, and a verdict at 0.9 and 1.1.

    Both medians come from one histogram, of which the side of the split is a key.
    """
    keys = ["service", "endpoint"]
    sides = events.withColumn("_side", F.when(F.col("ts") < ntz(split), "before_ms").otherwise("after_ms"))
    found = median(sides, [*keys, "_side"], "latency_ms", "_median")
    ratio = F.col("after_ms") / F.nullif("before_ms", F.lit(0.0))
    return (
        found.groupBy(*keys)
        .agg(*[F.max(F.when(F.col("_side") == side, F.col("_median"))).alias(side) for side in ("before_ms", "after_ms")])
        .filter(F.col("before_ms").isNotNull() & F.col("after_ms").isNotNull())
        .withColumn("ratio", ratio)
        .withColumn(
            "verdict",
            F.when(F.col("after_ms") < 0.9 * F.col("before_ms"), "better")
            .when(F.col("after_ms") <= 1.1 * F.col("before_ms"), "same")
            .otherwise("worse"),
        )
    )
