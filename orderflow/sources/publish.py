"""Transactions out as JSON messages, one per order line.

As a job it publishes a CSV data set:
``spark-submit orderflow/sources/publish.py <csv path>``.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType

from orderflow.schema import RAW_SCHEMA
from orderflow.session import build_session
from orderflow.sources.files import CORRUPT, field, read_csv_records
from orderflow.sources.kafka import kafka_settings

_NUMBERS = [f.name for f in RAW_SCHEMA if f.dataType != StringType()]


def _json(fields: list) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_messages(df: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``, with all raw fields, nulls included.

    A row that could not be read (``corrupt``) is sent as the text it was, for
    the parser downstream to refuse and the quarantine to keep.
    """
    value = _json(RAW_SCHEMA.names)
    if {"corrupt", "message"} <= set(df.columns):
        value = F.when(F.col("corrupt"), F.col("message")).otherwise(value)
    return df.select(value.alias("value"))


def _number_or_text(name: str) -> Column:
    """A number where the text is one that JSON knows, else the text."""
    text = field(name)
    if name == "quantity":
        number = text.try_cast("bigint")
    else:
        number = text.try_cast("double")
        number = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
    return F.coalesce(number.cast("variant"), text.cast("variant")).alias(name)


def record_messages(records: DataFrame) -> DataFrame:
    """One JSON object per row in ``value``, with every field the row has.

    Takes the text fields of ``read_csv_records``. Quantity, price and discount
    become numbers, or stay the text they are if that is none; further fields
    stay text. An unreadable row is sent as the text it was.
    """
    names = [name for name in records.columns if name != CORRUPT]
    fields = [_number_or_text(n) if n in _NUMBERS else field(n).alias(n) for n in names]
    return records.select(F.coalesce(F.col(CORRUPT), _json(fields)).alias("value"))


def publish_transactions(
    df: DataFrame,
    fmt: str = "kafka",
    checkpoint: str | None = None,
    **options: str,
) -> StreamingQuery | None:
    """Send transactions, or records with all their fields, to Kafka or with ``fmt="text"`` to text files.

    A streaming frame needs a ``checkpoint`` and gives its running query. The
    Kafka writer retries and acknowledges on its own, in parallel per task.
    """
    messages = record_messages(df) if CORRUPT in df.columns else to_messages(df)
    if fmt == "kafka":
        servers, topic = kafka_settings()
        options = {"kafka.bootstrap.servers": servers, "topic": topic, **options}
    if df.isStreaming:
        return (
            messages.writeStream.format(fmt)
            .options(checkpointLocation=checkpoint, **options)
            .trigger(availableNow=True)
            .start()
        )
    messages.write.format(fmt).mode("append").options(**options).save()
    return None


if __name__ == "__main__":
    session = build_session("orderflow-publish")
    publish_transactions(read_csv_records(session, sys.argv[1]))
