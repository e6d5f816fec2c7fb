"""Transactions derived from the order and event tables of a data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.parse import with_total_amount
from orderflow.schema import COMPLETED, PROCESSED_SCHEMA, RETURNED, CANCELLED


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _by_value(column: str, mapping: dict[str, str]) -> Column:
    """``column`` with some values replaced and the others kept."""
    replaced = F.col(column)
    for value, new in mapping.items():
        replaced = F.when(F.col(column) == value, F.lit(new)).otherwise(replaced)
    return replaced


def line_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their order, part, customer and nation.

    Customers meet nations, and orders meet customers, before the lines join:
    lines are the widest input, so they shuffle for two joins only. Which
    sides are broadcast is left to Spark, which knows their sizes.
    """
    customers = (
        _table(spark, folder, "customer")
        .join(_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_name")
    )
    orders = _table(spark, folder, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )
    lines = (
        _table(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    raw = lines.select(
        F.concat(
            F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
        ).alias("order_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        (F.col("l_discount") * F.lit(100.0)).alias("discount_percent"),
        F.col("n_name").alias("city"),
        F.col("o_orderpriority").alias("payment_method"),
        _by_value("l_returnflag", {"N": COMPLETED, "R": RETURNED, "A": CANCELLED}).alias(
            "order_status"
        ),
    )
    return with_total_amount(raw)


def transactions_of_events(events: DataFrame) -> DataFrame:
    """Processed transactions from rows of the event table, batch or stream."""
    k = F.get_json_object("props", "$.k").cast("int")
    raw = events.withColumn("k", k).select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("k").cast("string").alias("product_id"),
        F.concat(F.lit("Product "), F.col("k").cast("string")).alias("product_name"),
        F.col("event_type").alias("category"),
        (F.col("k") % 5 + 1).alias("quantity"),
        F.col("value").alias("unit_price"),
        (F.col("k") % 50).cast("double").alias("discount_percent"),
        F.concat(F.lit("CITY_"), (F.col("user_id") % 10).cast("string")).alias("city"),
        F.concat(F.lit("PM_"), (F.col("k") % 4).cast("string")).alias("payment_method"),
        _by_value(
            "event_type", {"purchase": COMPLETED, "signup": RETURNED, "error": CANCELLED}
        ).alias("order_status"),
    )
    return with_total_amount(raw)


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as transactions, times without zone as in the table."""
    return transactions_of_events(_table(spark, folder, "events"))


def event_transaction_stream(spark: SparkSession, folder: str, **options: object) -> DataFrame:
    """The event table as a stream of transactions, with zoned event times."""
    schema = _table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).options(**options).parquet(f"{folder}/events*.parquet")
    rows = transactions_of_events(events)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp")).select(
        *PROCESSED_SCHEMA.fieldNames()
    )
