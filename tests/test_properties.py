"""Messages of any make against a plain Python account of what should come out."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderflow.functions.parse import process
from orderflow.functions.quality import split_valid
from orderflow.plans.rollup import metrics_snapshot

MISSING = object()
START = datetime(2026, 9, 21, 23, 58)

times = st.integers(0, 300).map(lambda s: str(START + timedelta(seconds=s)))
records = st.fixed_dictionaries(
    {
        "order_id": st.sampled_from(["O1", "O2", "", " ", None, MISSING]),
        "timestamp": st.one_of(times, times, times, st.sampled_from(["x", None, "2026-09-21"])),
        "category": st.sampled_from(["A", "B", None]),
        "quantity": st.sampled_from([0, 1, 2, 3, -1, "2", 1.5, None]),
        "unit_price": st.sampled_from([0.5, 2.0, 10, -0.5, "2", None]),
        "discount_percent": st.sampled_from([0, 50, 100.0, 101, -1, None]),
        "city": st.sampled_from(["X", "Y", MISSING]),
        "payment_method": st.sampled_from(["P", "Q"]),
        "order_status": st.sampled_from(["Completed", "Returned", "completed", None]),
    }
)
texts = st.one_of(records, records, records, st.sampled_from(["junk", "[]", None]))


def as_text(record):
    if record is None or isinstance(record, str):
        return record
    return json.dumps({name: value for name, value in record.items() if value is not MISSING})


def is_int(value):
    return isinstance(value, int)


def broken_rules(record):
    if not isinstance(record, dict):
        return "malformed_message"
    codes = []
    if not str(record["order_id"] if isinstance(record["order_id"], str) else "").strip():
        codes.append("missing_order_id")
    if len(record["timestamp"] or "") != 19:
        codes.append("bad_timestamp")
    if not is_int(record["quantity"]):
        codes.append("bad_quantity")
    elif record["quantity"] < 0:
        codes.append("negative_quantity")
    if not isinstance(record["unit_price"], (int, float)):
        codes.append("bad_unit_price")
    elif record["unit_price"] < 0:
        codes.append("negative_unit_price")
    if record["discount_percent"] is None:
        codes.append("bad_discount")
    elif not 0 <= record["discount_percent"] <= 100:
        codes.append("discount_out_of_range")
    return ",".join(codes)


def expected_metrics(orders):
    found = Counter()
    counted = {"revenue_by_category": {}, "orders_by_city": Counter(),
               "payment_method_distribution": Counter(), "order_status_distribution": Counter(),
               "windowed_orders": Counter()}
    revenue, moments = 0.0, []
    for order in orders:
        amount = order["quantity"] * order["unit_price"] * (1 - order["discount_percent"] / 100.0)
        status = order["order_status"]
        city = None if order["city"] is MISSING else order["city"]
        found["total_orders"] += 1
        found["completed_orders"] += status == "Completed"
        found["returned_orders"] += status == "Returned"
        revenue += amount if status == "Completed" else 0.0
        by_category = counted["revenue_by_category"]
        by_category[order["category"]] = by_category.get(order["category"], 0.0) + amount
        counted["orders_by_city"][city] += 1
        counted["payment_method_distribution"][order["payment_method"]] += 1
        counted["order_status_distribution"][status] += 1
        moment = datetime.fromisoformat(order["timestamp"])
        moments.append(moment)
        counted["windowed_orders"][moment.replace(second=0)] += 1
    last = sum(moment >= max(moments) - timedelta(minutes=1) for moment in moments)
    rows = {("completed_revenue", None, None, None, revenue),
            ("orders_in_last_minute", None, None, last, None)}
    for name in ("total_orders", "completed_orders", "returned_orders"):
        rows.add((name, None, None, found[name], None))
    for name, groups in counted.items():
        for key, value in groups.items():
            if name == "revenue_by_category":
                rows.add((name, key, None, None, value))
            elif name == "windowed_orders":
                rows.add((name, None, key, value, None))
            else:
                rows.add((name, key, None, value, None))
    return rows


# All amounts are multiples of a quarter, so sums are exact in any order.
@settings(max_examples=12, deadline=None, database=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=1, max_size=40))
def test_messages_to_metrics(spark, sent):
    processed = process(
        spark.createDataFrame([(as_text(record),) for record in sent], "value string").repartition(3)
    )
    valid, refused = split_valid(processed)
    reasons = Counter(",".join(row.reasons) for row in refused.collect())
    assert reasons == Counter(filter(None, map(broken_rules, sent)))
    rows = metrics_snapshot(valid).collect()
    assert {(r.metric, r.key, r.window_start, r.order_count, r.revenue) for r in rows} == (
        expected_metrics([record for record in sent if not broken_rules(record)])
    )
    assert len(rows) == len({(r.metric, r.key, r.window_start) for r in rows})
