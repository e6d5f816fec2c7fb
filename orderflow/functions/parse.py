"""From message text to processed transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.schema import PROCESSED_SCHEMA, RAW_SCHEMA

# Fixed value: the text form of event times.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"


def parse_transactions(df: DataFrame, keep_message: bool = False) -> DataFrame:
    """Parse the JSON in ``value`` (binary or text) into the raw fields.

    A field of the wrong type becomes null, and so do all fields of a message
    that is no JSON object. Unknown keys are dropped. ``keep_message`` adds
    the text as ``message`` so that a refused row can be looked at later.
    """
    text = F.col("value").cast("string")
    # As a generator of one row each, the parser runs once per message. As a
    # plain column Spark repeats it for every use of a field in later filters.
    record = F.inline(F.array(F.from_json(text, RAW_SCHEMA)))
    if keep_message:
        return df.select(text.alias("message"), record)
    return df.select(record)


def event_time(text: Column) -> Column:
    """Event time of a text, null where it does not follow the pattern."""
    return F.try_to_timestamp(text, F.lit(TIME_PATTERN))


def with_event_time(df: DataFrame) -> DataFrame:
    """Replace the text in ``timestamp`` by the event time."""
    return df.withColumn("timestamp", event_time(F.col("timestamp")))


def discounted_amount(quantity: Column, unit_price: Column, discount_percent: Column) -> Column:
    """Price of an order line after discount, unrounded; null if any part is."""
    return quantity * unit_price * (F.lit(1) - discount_percent / F.lit(100.0))


def with_total_amount(df: DataFrame) -> DataFrame:
    """Add ``total_amount``."""
    return df.withColumn(
        "total_amount",
        discounted_amount(F.col("quantity"), F.col("unit_price"), F.col("discount_percent")),
    )


def process_records(df: DataFrame) -> DataFrame:
    """Raw records to processed transactions, keeping ``message`` and ``corrupt`` if they are there."""
    extra = [name for name in ("message", "corrupt") if name in df.columns]
    return with_total_amount(with_event_time(df)).select(*PROCESSED_SCHEMA.fieldNames(), *extra)


def process(df: DataFrame) -> DataFrame:
    """Messages in ``value`` to processed transactions with their ``message``."""
    return process_records(parse_transactions(df, keep_message=True))
