from __future__ import annotations

import random

import pytest
from conftest import as_set, frame, order

from orderflow.operators import metrics
from orderflow.operators.windows import orders_in_last_minute, windowed_orders
from orderflow.plans.rollup import (
    MARGIN_COLUMNS,
    all_metrics,
    margins,
    metrics_snapshot,
    snapshot_rows,
    state_of,
)

SINGLE = {
    "total_orders": metrics.total_orders,
    "completed_orders": metrics.completed_orders,
    "returned_orders": metrics.returned_orders,
    "completed_revenue": metrics.completed_revenue,
    "orders_in_last_minute": orders_in_last_minute,
    "revenue_by_category": metrics.revenue_by_category,
    "orders_by_city": metrics.orders_by_city,
    "payment_method_distribution": metrics.payment_method_distribution,
    "order_status_distribution": metrics.order_status_distribution,
    "windowed_orders": windowed_orders,
}


def random_orders(seed, count):
    """Orders with nulls in every dimension, and one value holding most rows."""
    pick = random.Random(seed)
    return [
        order(
            order_id=f"O{n}",
            time=pick.choice(["2026-09-21 10:00:00", None, f"2026-09-21 10:0{n % 7}:{n % 60:02d}"]),
            category=pick.choice(["A", "A", "A", "B", None]),
            quantity=pick.choice([1, 2, 3]),
            price=pick.choice([0.5, 2.25, None]),
            city=pick.choice(["X", "X", "Y", None, ""]),
            payment=pick.choice(["P", None]),
            status=pick.choice(["Completed", "Returned", "Pending", None]),
        )
        for n in range(count)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_all_metrics_equal_the_single_ones(spark, seed):
    df = frame(spark, random_orders(seed, 200))
    with all_metrics(df) as found:
        assert set(found) == set(SINGLE)
        for name, metric in SINGLE.items():
            assert as_set(found[name]) == as_set(metric(df)), name
            assert found[name].columns == metric(df).columns


@pytest.mark.parametrize("stage", [False, True])
def test_golden(six, stage):
    with all_metrics(six, stage) as found:
        assert found["completed_revenue"].first()[0] == 215.85
        assert found["orders_in_last_minute"].first()[0] == 2
        assert found["windowed_orders"].count() == 4


def test_empty_input_has_zero_scalars_and_empty_tables(nothing):
    with all_metrics(nothing) as found:
        scalars = {name: found[name].collect() for name in list(SINGLE)[:5]}
        assert {name: rows[0][0] for name, rows in scalars.items()} == {
            "total_orders": 0, "completed_orders": 0, "returned_orders": 0,
            "completed_revenue": 0.0, "orders_in_last_minute": 0,
        }
        for name in list(SINGLE)[5:]:
            assert found[name].collect() == []
            assert found[name].columns == SINGLE[name](nothing).columns


def test_missing_columns(spark):
    with pytest.raises(ValueError):
        all_metrics(spark.range(1))


def test_each_dimension_counts_every_row(spark):
    df = frame(spark, random_orders(4, 100))
    sums = margins(df).groupBy("dimension").sum("order_count").collect()
    assert {r[0]: r[1] for r in sums} == dict.fromkeys(
        ["category", "city", "payment_method", "order_status", "minute"], 100
    )


@pytest.mark.parametrize("seed", [5, 6])
def test_merged_states_equal_one_state(spark, seed):
    rows = random_orders(seed, 150)
    parts = [frame(spark, rows[:10]), frame(spark, rows[10:90]), frame(spark, rows[90:])]
    state = state_of(parts[0])
    for part in parts[1:]:
        state = state_of(part, state)
    assert state.columns == list(MARGIN_COLUMNS)
    assert as_set(snapshot_rows(state)) == as_set(metrics_snapshot(frame(spark, rows)))


def test_tail_follows_late_and_newer_rows(spark):
    def last(*batches):
        state = None
        for times in batches:
            state = state_of(frame(spark, [order(time=t) for t in times]), state)
        return snapshot_rows(state).where("metric = 'orders_in_last_minute'").first().order_count

    day = "2026-09-21 10:0"
    assert last([f"{day}0:00", f"{day}0:30"], [f"{day}1:00"]) == 3
    assert last([f"{day}0:00", f"{day}0:30"], [f"{day}1:01"]) == 2
    assert last([f"{day}5:00"], [f"{day}0:00", f"{day}4:00"]) == 2
    assert last([None], [f"{day}5:00"]) == 1
    assert last([f"{day}5:00"], [None]) == 1
    assert last([None], [None]) == 0


def test_a_staged_copy_goes_with_its_metrics(spark, six):
    from orderflow.session import path_exists

    found = all_metrics(six, stage=True)
    assert path_exists(spark, found._staged_at)
    found.release()
    assert not path_exists(spark, found._staged_at)
