"""Presentation columns and texts, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from orderflow.schema import CANCELLED, COMPLETED, RETURNED

# Each display column and the input names it may come from,
# the most telling first.
DISPLAY_SOURCES = {
    "Order ID": ["order_id", "orderId"],
    "Product": ["product_name", "product", "product_id"],
    "Category": ["category"],
    "Amount": ["total_amount", "amount", "unit_price"],
    "City": ["city"],
    "Status": ["order_status", "status"],
}
MISSING_TEXT = "—"

# The labels of the known order states.
STATUS_LABELS = {
    COMPLETED: "✅ Completed",
    RETURNED: "↩️ Returned",
    CANCELLED: "❌ Cancelled",
}

# Every character Unicode counts as white space.
WHITESPACE = "".join(
    chr(code) for code in range(0x3001) if chr(code).isspace()
)

# Java reads "1d" and "1f" as numbers, which no order amount is.
_JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"


def _number(value: Column) -> Column:
    """``value`` as double, null where it is no number."""
    # The type test is a constant, so numeric columns keep only the cast.
    java_only = (F.typeof(value) == "string") & value.cast("string").rlike(_JAVA_SUFFIX)
    return F.when(java_only, F.lit(None)).otherwise(value.try_cast("double"))


def to_display(df: DataFrame) -> DataFrame:
    """The six display columns of transactions under any of their known names.

    Where several inputs map to one column the first filled one wins. Text
    that is missing shows as a dash, an amount that is no number as 0.0.
    """
    columns = []
    for shown, names in DISPLAY_SOURCES.items():
        present = [F.col(name) for name in [shown, *names] if name in df.columns]
        if shown == "Amount":
            values, default = [_number(value) for value in present], F.lit(0.0)
            amount = F.coalesce(*values, default)
            columns.append(F.when(F.isnan(amount), default).otherwise(amount).alias(shown))
        else:
            values = [value.cast("string") for value in present]
            columns.append(F.coalesce(*values, F.lit(MISSING_TEXT)).alias(shown))
    return df.select(*columns)


def currency_text(value: Column) -> Column:
    """Rupee text with two decimals, ``₹0.00`` for anything that is no number."""
    number = _number(value)
    number = F.when(~F.isnan(number), number)
    return F.concat(F.lit("₹"), F.coalesce(F.format_number(number, 2), F.lit("0.00")))


def integer_text(value: Column) -> Column:
    """Integer text with thousands separators, ``0`` for anything that is no integer."""
    return F.coalesce(F.format_number(value.try_cast("bigint"), 0), F.lit("0"))


def status_label(value: Column) -> Column:
    """Label of an order state: known states with an icon, others as they are."""
    trimmed = F.btrim(value, F.lit(WHITESPACE))
    label = F.when(value.isNull() | (value == ""), F.lit("Unknown"))
    for state, text in STATUS_LABELS.items():
        label = label.when(F.lower(trimmed) == state.lower(), F.lit(text))
    return label.otherwise(trimmed)


def with_display_formats(
    df: DataFrame,
    currency: tuple[str, ...] = ("Amount",),
    integers: tuple[str, ...] = (),
    status: tuple[str, ...] = ("Status",),
) -> DataFrame:
    """Replace the named columns by their display texts, where present."""
    texts: dict[str, Column] = {}
    for name in currency:
        texts[name] = currency_text(F.col(f"`{name}`"))
    for name in integers:
        texts[name] = integer_text(F.col(f"`{name}`"))
    for name in status:
        is_text = name in df.columns and isinstance(df.schema[name].dataType, StringType)
        texts[name] = status_label(F.col(f"`{name}`")) if is_text else F.lit("Unknown")
    return df.withColumns({name: text for name, text in texts.items() if name in df.columns})
