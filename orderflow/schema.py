"""Columns, types and status values of an order transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType, TimestampType

# The fields of a transaction message, in message order.
RAW_SCHEMA = (
    StructType()
    .add("order_id", "string")
    .add("timestamp", "string")
    .add("customer_id", "string")
    .add("product_id", "string")
    .add("product_name", "string")
    .add("category", "string")
    .add("quantity", "integer")
    .add("unit_price", "double")
    .add("discount_percent", "double")
    .add("city", "string")
    .add("payment_method", "string")
    .add("order_status", "string")
)

# A processed transaction has its event time parsed and its amount derived.
PROCESSED_SCHEMA = StructType(
    [
        StructField("timestamp", TimestampType()) if field.name == "timestamp" else field
        for field in RAW_SCHEMA
    ]
    + [StructField("total_amount", DoubleType())]
)

# Order states with a meaning of their own. Any other text is
# a valid state that only shows up in totals and in the status breakdown.
COMPLETED = "Completed"
RETURNED = "Returned"
CANCELLED = "Cancelled"


def validate_columns(
    df: DataFrame, required: Sequence[str] = tuple(PROCESSED_SCHEMA.fieldNames())
) -> DataFrame:
    """Return ``df``, or raise ``ValueError`` naming the processed columns it lacks."""
    present = set(df.columns)
    missing = [name for name in required if name not in present]
    if missing:
        raise ValueError(f"not a processed transaction frame, missing columns: {missing}")
    return df
