from __future__ import annotations

import math
from fractions import Fraction
from functools import reduce

import pytest
from conftest import SIX_AMOUNTS, as_dict, as_set, frame, order
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.operators import metrics
from orderflow.operators.windows import duration_micros, orders_in_last_minute, windowed_orders
from orderflow.plans.rollup import metrics_snapshot
from orderflow.schema import PROCESSED_SCHEMA, RAW_SCHEMA, validate_columns


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_amounts(six):
    amounts = [r.total_amount for r in six.orderBy("order_id").collect()]
    assert amounts == pytest.approx(SIX_AMOUNTS)


def test_amount_formula(spark):
    rows = frame(spark, [order(quantity=4, price=3299.0, discount=20.0)])
    assert rows.first().total_amount == pytest.approx(10556.8)


def test_amount_null_if_any_part_is(spark):
    rows = frame(spark, [order(quantity=None), order(price=None), order(discount=None)])
    assert [r.total_amount for r in rows.collect()] == [None] * 3


def test_scalars(six):
    assert one(metrics.total_orders(six)) == {"total_orders": 6}
    assert one(metrics.completed_orders(six)) == {"completed_orders": 3}
    assert one(metrics.returned_orders(six)) == {"returned_orders": 2}
    assert one(metrics.completed_revenue(six)) == {"completed_revenue": 215.85}
    assert one(metrics.kpis(six)) == {
        "total_orders": 6,
        "completed_orders": 3,
        "returned_orders": 2,
        "completed_revenue": 215.85,
    }


def test_breakdowns(six):
    # Returned and cancelled orders add to their categories: every status counts.
    assert as_dict(metrics.revenue_by_category(six)) == {
        "Lighting": 168.35, "Kitchen": 109.0, "Garden": 175.5,
    }
    assert as_dict(metrics.orders_by_city(six)) == {"Porto": 2, "Ghent": 2, "Turku": 2}
    assert as_dict(metrics.payment_method_distribution(six)) == {"Card": 3, "Cash": 2, "Voucher": 1}
    assert as_dict(metrics.order_status_distribution(six)) == {
        "Completed": 3, "Returned": 2, "Cancelled": 1,
    }


def test_empty_input(nothing):
    assert one(metrics.kpis(nothing)) == {
        "total_orders": 0, "completed_orders": 0, "returned_orders": 0, "completed_revenue": 0.0,
    }
    assert one(orders_in_last_minute(nothing)) == {"orders_in_last_minute": 0}
    assert metrics.revenue_by_category(nothing).collect() == []
    assert windowed_orders(nothing).collect() == []


def test_status_is_exact_and_others_count_in_totals(spark):
    rows = frame(spark, [order(status=s) for s in ("completed", "Pending", None, "Returned ")])
    found = one(metrics.kpis(rows))
    assert (found["total_orders"], found["completed_orders"], found["returned_orders"]) == (4, 0, 0)
    assert found["completed_revenue"] == 0.0
    assert len(metrics.order_status_distribution(rows).collect()) == 4


def test_null_group_and_null_revenue(spark):
    rows = frame(spark, [order(category=None), order(category=None), order("X", category="A", price=None)])
    assert as_dict(metrics.revenue_by_category(rows)) == {None: 20.0, "A": None}


def test_rounding_is_half_up_after_the_sum(spark):
    rows = frame(spark, [order(price=0.0625), order(price=0.0625)])
    assert one(metrics.completed_revenue(rows)) == {"completed_revenue": 0.13}


def test_repeated_order_ids_count(spark):
    assert one(metrics.total_orders(frame(spark, [order(), order()]))) == {"total_orders": 2}


def test_status_ratios(six, nothing):
    found = one(metrics.status_ratios(metrics.kpis(six)))
    assert (found["completed_percent"], found["returned_percent"]) == (50.0, 33.3)
    found = one(metrics.status_ratios(metrics.kpis(nothing)))
    assert (found["completed_percent"], found["returned_percent"]) == (0.0, 0.0)


def test_ranked_breaks_ties_by_key(six):
    cities = [r.city for r in metrics.ranked(metrics.orders_by_city(six), "order_count").collect()]
    assert cities == ["Ghent", "Porto", "Turku"]
    windows = metrics.ranked(windowed_orders(six), "window_start").collect()
    assert [w.order_count for w in windows] == [2, 1, 2, 1]


def test_tumbling_windows(six):
    found = {(str(r.window_start), str(r.window_end), r.order_count) for r in windowed_orders(six).collect()}
    assert found == {
        ("2025-03-14 08:59:00", "2025-03-14 09:00:00", 1),
        ("2025-03-14 09:00:00", "2025-03-14 09:01:00", 2),
        ("2025-03-14 09:01:00", "2025-03-14 09:02:00", 1),
        ("2025-03-14 09:03:00", "2025-03-14 09:04:00", 2),
    }


def test_window_bounds_and_null_times(spark):
    times = ["2026-09-21 10:00:00", "2026-09-21 10:00:59", "2026-09-21 10:01:00", None]
    rows = frame(spark, [order(time=t) for t in times])
    assert sorted(r.order_count for r in windowed_orders(rows).collect()) == [1, 2]


@pytest.mark.parametrize("duration, slide", [("2 minutes", "1 minute"), ("3 minutes", "2 minutes"),
                                             ("1 hour", "20 minutes"), ("50 hours", "7 hours"), ("90 minutes", "1 minute"),
                                             ("1 hour 30 minutes", "25 minutes"), ("1 minute", "1 minute")])
def test_sliding_windows_equal_brute_force(spark, six, duration, slide):
    width, step = (duration_micros(d) // 1_000_000 for d in (duration, slide))
    expected = {}
    for row in six.collect():
        seconds = int((row.timestamp - row.timestamp.min.replace(year=1970)).total_seconds())
        start = seconds - seconds % step
        while start > seconds - width:
            expected[start] = expected.get(start, 0) + 1
            start -= step
    found = windowed_orders(six, duration, slide).selectExpr(
        "unix_timestamp(window_start)", "order_count",
        "unix_timestamp(window_end) - unix_timestamp(window_start) AS width")
    rows = found.collect()
    assert {r[0]: r[1] for r in rows} == expected
    assert {r.width for r in rows} == {width}


def test_last_minute(spark, six):
    assert one(orders_in_last_minute(six)) == {"orders_in_last_minute": 2}
    assert one(orders_in_last_minute(six, "2 minutes")) == {"orders_in_last_minute": 2}
    assert one(orders_in_last_minute(six, "2 minutes 3 seconds")) == {"orders_in_last_minute": 3}
    # The bound itself belongs to the minute; rows without time do not.
    times = ["2026-09-21 10:00:00", "2026-09-21 10:01:00", "2026-09-21 09:59:59", None]
    rows = frame(spark, [order(time=t) for t in times])
    assert one(orders_in_last_minute(rows)) == {"orders_in_last_minute": 2}
    assert one(orders_in_last_minute(frame(spark, [order(time=None)]))) == {"orders_in_last_minute": 0}


def test_durations():
    second = 1_000_000
    for text, micros in {
        "1 minute": 60 * second,
        "2 Hours": 7200 * second,
        "1 hour 30 minutes": 5400 * second,
        "interval 1 day 1 second": 86_401 * second,
        "500 milliseconds": second // 2,
        "1.5 seconds": 3 * second // 2,
        "7 microseconds": 7,
    }.items():
        assert duration_micros(text) == micros
    for text in ("", "minute", "1 fortnight", "-1 minute", "1 month", "1 minute ago", "1 minute, 2 seconds"):
        with pytest.raises(ValueError):
            duration_micros(text)


@pytest.mark.parametrize("duration", ["1 hour 30 minutes", "1500 milliseconds", "1 week"])
def test_every_duration_works_with_and_without_a_slide(six, duration):
    assert as_set(windowed_orders(six, duration, duration)) == as_set(windowed_orders(six, duration))
    half = f"{duration_micros(duration) // 2} microseconds"
    found = windowed_orders(six, duration, half).collect()
    assert sum(r.order_count for r in found) == 2 * six.count()
    assert one(orders_in_last_minute(six, duration))["orders_in_last_minute"] >= 1


def test_sliding_windows_over_many_days_and_before_the_epoch(spark):
    times = ["1969-12-31 23:59:30", "1970-01-01 00:00:10", "1970-01-03 12:00:00", "2024-02-29 00:00:00", None]
    rows = frame(spark, [order(time=t) for t in times])
    found = {(str(r.window_start), r.order_count) for r in windowed_orders(rows, "1 minute", "30 seconds").collect()}
    assert found == {
        ("1969-12-31 23:59:00", 1), ("1969-12-31 23:59:30", 2), ("1970-01-01 00:00:00", 1),
        ("1970-01-03 11:59:30", 1), ("1970-01-03 12:00:00", 1),
        ("2024-02-28 23:59:30", 1), ("2024-02-29 00:00:00", 1),
    }
    assert windowed_orders(rows.limit(0), "1 minute", "30 seconds").count() == 0
    with pytest.raises(ValueError):
        windowed_orders(rows, "1 minute", "2 minutes")


def test_schema_check(spark, six):
    assert validate_columns(six) is six
    assert validate_columns(six.withColumn("more", six.quantity))
    with pytest.raises(ValueError, match="order_id.*total_amount"):
        validate_columns(spark.createDataFrame([(1, "bad")], "id bigint, val string"))


def test_schemas():
    assert len(RAW_SCHEMA) == 12 and len(PROCESSED_SCHEMA) == 13
    assert RAW_SCHEMA["timestamp"].dataType.simpleString() == "string"
    assert PROCESSED_SCHEMA["timestamp"].dataType.simpleString() == "timestamp"
    assert all(field.nullable for field in [*RAW_SCHEMA, *PROCESSED_SCHEMA])


def test_results_do_not_depend_on_partitioning(spark, six):
    expected = as_set(metrics.revenue_by_category(six)), as_set(windowed_orders(six, "2 minutes", "1 minute"))
    for parts in (1, 5, 16):
        shuffled = six.repartition(parts, "order_id")
        assert as_set(metrics.revenue_by_category(shuffled)) == expected[0]
        assert as_set(windowed_orders(shuffled, "2 minutes", "1 minute")) == expected[1]


def amounts_past_1e13(spark):
    """Amounts of both signs and many sizes, whose doubles add up differently by order."""
    amounts = "CAST((id * 7919 % 8999) AS DOUBLE) * 1e6 + id % 997 * 0.0137D - IF(id % 3 = 0, 4.1e9D, 0D)"
    return spark.range(6000).selectExpr(
        f"{amounts} AS total_amount", "'Books' AS category", "'Completed' AS order_status", "'x' AS city",
        "'y' AS payment_method", "timestamp'2026-01-01 00:00:00' AS timestamp", "id")


def test_revenue_does_not_depend_on_the_order_of_rows(spark):
    rows = amounts_past_1e13(spark).cache()
    exact = sum(Fraction(r.total_amount).limit_denominator(10**9) for r in rows.collect())
    assert exact > 10**13
    cents = float(round(exact, 2))
    shuffled = [rows.repartition(1 + n % 7, F.xxhash64("id", F.lit(n))).sortWithinPartitions(F.xxhash64("id", F.lit(-n)))
                .withColumn("category", F.lit(str(n))) for n in range(64)]
    found = metrics.revenue_by_category(reduce(DataFrame.unionAll, shuffled)).collect()
    assert len(found) == 64 and {r.revenue for r in found} == {cents}
    for n in (3, 11):
        assert metrics.kpis(shuffled[n]).first().completed_revenue == cents
        row = metrics_snapshot(shuffled[n]).where("metric = 'revenue_by_category'").first()
        assert row.revenue == cents
    rows.unpersist()


def test_amounts_beyond_the_exact_range_count_too(spark):
    rows = spark.createDataFrame(
        [("a", 1e300), ("a", 0.25), ("b", float("nan")), ("b", 1.0), ("c", float("inf")), ("d", None),
         ("e", -9e9), ("e", 9e9), ("e", 0.1), ("e", -8.9e9), ("f", None), ("f", 2.005)],
        "category string, total_amount double")
    found = as_dict(metrics.revenue_by_category(rows))
    assert math.isnan(found.pop("b"))
    assert found == {"a": 1e300, "c": math.inf, "d": None, "e": -8899999999.9, "f": 2.01}
