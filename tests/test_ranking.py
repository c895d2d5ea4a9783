import math
import random
from fractions import Fraction

import pytest

from faultline.functions.ranking import row_numbers, target_rank, tie_shift
from faultline.operators.latency import latency_row_numbers, p95_approx, p95_disc, p95_histogram, p95_row_number
from tests.conftest import event, rows_of


def nearest(values, q=Fraction(95, 100)):
    ordered = sorted(values, key=lambda v: (v is not None, v or 0))
    return ordered[math.ceil(q * len(ordered)) - 1]


def by_service(groups):
    return [
        event(1000 * g + i, service=name, latency=value, ts=f"2024-01-01 00:{i % 60:02d}:00")
        for g, (name, values) in enumerate(groups.items())
        for i, value in enumerate(values)
    ]


random.seed(7)
GROUPS = {
    "one": [5],
    "n19": list(range(19)),
    "n20": list(range(20)),
    "n21": list(range(21)),
    "nulls": [None] * 3 + list(range(17)),
    "only-nulls": [None] * 4,
    "one-value": [42] * 50 + [1, 99],
    "wide": [random.choice([-(2**31), 2**31 - 1, -70000, 70000, 65535, 65536, 0, -1, None]) for _ in range(200)],
    "spread": [random.randint(-(2**31), 2**31 - 1) for _ in range(100)],
}


@pytest.mark.parametrize("form", [p95_histogram, p95_row_number])
def test_nearest_rank_counts_nulls_first(form, events_of):
    expected = {name: nearest(values) for name, values in GROUPS.items()}
    got = {row["service"]: row["p95_latency_ms"] for row in form(events_of(by_service(GROUPS))).collect()}
    assert got == expected


@pytest.mark.parametrize("q", ["0.5", "0.07", "0.99", "1"])
def test_other_ranks(q, events_of):
    expected = {name: nearest(values, Fraction(q)) for name, values in GROUPS.items()}
    got = {row["service"]: row["p95_latency_ms"] for row in p95_histogram(events_of(by_service(GROUPS)), q).collect()}
    assert got == expected


def test_disc_ignores_nulls(events_of):
    kept = {name: [v for v in values if v is not None] for name, values in GROUPS.items()}
    expected = {name: nearest(values) for name, values in kept.items() if values}
    got = {row["service"]: row["p95_latency_ms"] for row in p95_disc(events_of(by_service(GROUPS))).collect()}
    assert got == expected


def test_target_rank_is_exact_in_decimals(spark):
    # In doubles 0.07 * 100 is a little more than 7, and its ceiling 8.
    df = spark.range(1, 20001)
    wrong = df.select(df.id, target_rank("0.07", df.id).alias("r")).collect()
    assert all(r == math.ceil(Fraction(7, 100) * n) for n, r in wrong)


@pytest.mark.parametrize("shift", [None, 0, 3])
def test_row_numbers_equal_the_plain_window(shift, spark, events_of):
    df = events_of(by_service(GROUPS))
    df.createOrReplaceTempView("ranked_input")
    plain = spark.sql(
        """SELECT id, row_number() OVER (PARTITION BY service ORDER BY latency_ms NULLS FIRST, id) AS rn,
             count(*) OVER (PARTITION BY service) AS cnt FROM ranked_input"""
    )
    assert rows_of(row_numbers(df, "service", "latency_ms", "id", shift), "id", "rn", "cnt") == rows_of(plain)


def test_blocks_of_ties_are_bounded(spark):
    for ids in (spark.range(10), spark.range(0, 2**40, 2**38), spark.sql("SELECT explode(array(-(1L << 62), 1L << 62)) AS id")):
        shift = tie_shift(ids, "id")
        lo, hi = ids.selectExpr(f"shiftright(min(id), {shift})", f"shiftright(max(id), {shift})").first()
        assert shift >= 16 and hi - lo <= 2**20
    assert tie_shift(spark.range(0, 2**40, 2**38), "id") <= 20
    assert tie_shift(spark.range(0), "id") == 16


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_window_sees_rows_of_a_whole_service(events_of):
    """Windows by service alone run over counts; the one over events is also cut by value and block of ids."""
    plan = plan_of(latency_row_numbers(events_of(by_service(GROUPS))))
    row_windows = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert row_windows and all("_block" in line and "_key" in line for line in row_windows)
    assert "Window" not in plan_of(p95_approx(events_of(by_service(GROUPS))))


def test_sketch_is_close(spark, events_of):
    from faultline.sources.synthetic import synthetic_events

    data = synthetic_events(spark, 50_000).cache()
    sketched = {r["service"]: r["p95_latency_ms"] for r in p95_approx(data).collect()}
    for service, value in sketched.items():
        rows = data.filter(data.service == service)
        share = rows.filter(rows.latency_ms <= value).count() / rows.count()
        assert abs(share - 0.95) < 0.01
    data.unpersist()
