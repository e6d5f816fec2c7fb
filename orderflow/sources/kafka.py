"""Transactions from and to a Kafka topic."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Where a local pipeline finds its broker and topic.
DEFAULT_SERVERS = "localhost:9092"
DEFAULT_TOPIC = "shopping-transactions"


def kafka_settings() -> tuple[str, str]:
    """Servers and topic from the environment, or the defaults."""
    return (
        os.environ.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_SERVERS),
        os.environ.get("KAFKA_TOPIC", DEFAULT_TOPIC),
    )


def kafka_options(
    servers: str | None = None,
    topic: str | None = None,
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options. ``min_partitions`` splits a narrow topic over more tasks."""
    default_servers, default_topic = kafka_settings()
    options = {
        "kafka.bootstrap.servers": servers or default_servers,
        "subscribe": topic or default_topic,
        "startingOffsets": starting,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_transactions_kafka(
    spark: SparkSession,
    servers: str | None = None,
    topic: str | None = None,
    starting: str = "latest",
    **limits: int | None,
) -> DataFrame:
    """Stream of messages of one topic; needs Spark's Kafka connector package."""
    options = kafka_options(servers, topic, starting, **limits)
    return spark.readStream.format("kafka").options(**options).load()
