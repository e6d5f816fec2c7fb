from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from orderflow.functions.parse import with_total_amount  # noqa: E402
from orderflow.schema import PROCESSED_SCHEMA  # noqa: E402
from orderflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "orderflow-tests",
        "local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "2",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# order id, time of day, customer, product id and name, category, quantity,
# price, discount, city, payment method, status
SIX_ORDERS = [
    ("A-01", "08:59:58", "C7", "P3", "Desk lamp", "Lighting", 3, 45.5, 10.0, "Porto", "Card", "Completed"),
    ("A-02", "09:00:05", "C2", "P9", "Tea kettle", "Kitchen", 1, 80.0, 25.0, "Ghent", "Cash", "Completed"),
    ("A-03", "09:00:41", "C2", "P4", "Bread knife", "Kitchen", 4, 12.25, 0.0, "Ghent", "Card", "Returned"),
    ("A-04", "09:01:17", "C5", "P3", "Desk lamp", "Lighting", 1, 45.5, 0.0, "Turku", "Voucher", "Cancelled"),
    ("A-05", "09:03:03", "C9", "P6", "Garden hose", "Garden", 2, 33.0, 50.0, "Porto", "Cash", "Completed"),
    ("A-06", "09:03:20", "C1", "P8", "Tool box", "Garden", 1, 150.0, 5.0, "Turku", "Card", "Returned"),
]
SIX_AMOUNTS = [122.85, 60.00, 49.00, 45.50, 33.00, 142.50]


def frame(spark, rows):
    """Processed transactions from rows whose time is a text or null."""
    schema = [f for f in PROCESSED_SCHEMA if f.name != "total_amount"]
    typed = [
        (r[0], r[1] and datetime.fromisoformat(r[1]), *r[2:])
        for r in rows
    ]
    return with_total_amount(spark.createDataFrame(typed, type(PROCESSED_SCHEMA)(schema)))


@pytest.fixture(scope="session")
def six(spark):
    return frame(spark, [(r[0], f"2025-03-14 {r[1]}", *r[2:]) for r in SIX_ORDERS]).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], PROCESSED_SCHEMA)


def order(order_id="O1", time="2026-09-21 10:00:00", category="Books", quantity=1, price=10.0,
          discount=0.0, city="Salem", payment="UPI", status="Completed", product="Pen"):
    """One raw order with its time as text."""
    return (order_id, time, "C1", "P1", product, category, quantity, price, discount, city, payment, status)


def as_set(df):
    return {tuple(row) for row in df.collect()}


def as_dict(df):
    return {row[0]: row[1] for row in df.collect()}
