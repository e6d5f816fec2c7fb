"""The stored streaming pipeline: messages in, tables and snapshots out."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from orderflow.functions.parse import process
from orderflow.session import build_session, shared_folder
from orderflow.sources.kafka import read_transactions_kafka
from orderflow.streaming.heartbeat import attach_heart
from orderflow.streaming.store import TransactionStore


# What the service takes per batch, and when it archives, unless the session says otherwise.
MAX_OFFSETS_PER_TRIGGER = 1_000_000
ARCHIVE_EVERY = 360
ARCHIVE_LEAVE = 100
ARCHIVE_WAIT_SECONDS = 3600


def process_batch(
    batch_df: DataFrame,
    batch_id: int,
    root: str,
    validate: bool = True,
    archive_every: int | None = None,
    archive_leave: int = ARCHIVE_LEAVE,
    archive_wait_seconds: int = ARCHIVE_WAIT_SECONDS,
    epochs: dict[str, int] | None = None,
    **options: object,
) -> bool:
    """Add one micro-batch of processed rows to the tables below ``root``.

    For use with ``foreachBatch``. The stream's own id ties the tables to its
    checkpoint, so that batch numbers of another stream are not mixed in.

    After every ``archive_every`` batches, all but the newest ``archive_leave``
    move into the archive, and their own folders go once they have been there
    for ``archive_wait_seconds``: so long may a reader be on an older plan.

    Calls with the same ``epochs`` are one writer, which stops with an error
    once another has begun; a call without takes over.
    """
    spark = batch_df.sparkSession
    stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
    store = TransactionStore(spark, root, epochs)
    added = store.add_batch(batch_df, batch_id, stream_id, validate=validate, **options)
    if archive_every and (batch_id + 1) % archive_every == 0:
        store.compact(archive_leave)
        store.drop_archived(archive_wait_seconds)
    return added


def start_stream(
    processed: DataFrame,
    root: str,
    checkpoint: str | None = None,
    trigger: dict[str, object] | None = None,
    validate: bool = True,
    **options: object,
) -> StreamingQuery:
    """Start the pipeline. Its checkpoint lies beside its tables unless one is given.

    It is the one writer of its tables from its first batch on; a pipeline
    started before it below the same root fails at its next batch. It leaves
    beats there, by which ``TransactionStore.freshness`` tells idle from dead.
    """
    epochs: dict[str, int] = {}
    query = (
        processed.writeStream.outputMode("append")
        .foreachBatch(
            lambda batch_df, batch_id: process_batch(
                batch_df, batch_id, root, validate=validate, epochs=epochs, **options
            )
        )
        .option("checkpointLocation", checkpoint or f"{root}/checkpoint")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
    attach_heart(query, processed.sparkSession, root)
    return query


def main() -> None:
    """Run the pipeline from Kafka until it is stopped.

    Servers, topic and folders come from the environment, figures from the
    session, below ``spark.orderflow``: ``maxOffsetsPerTrigger`` (by default
    ``MAX_OFFSETS_PER_TRIGGER``), ``minPartitions``, over which a narrow topic
    is spread, and ``archiveEvery``, ``archiveLeave`` and ``archiveWaitSeconds``.
    """
    spark = build_session("orderflow-stream")

    def figure(name: str, default: int | None) -> int | None:
        value = spark.conf.get(f"spark.orderflow.{name}", None)
        return int(value) if value else default

    messages = read_transactions_kafka(
        spark,
        max_offsets_per_trigger=figure("maxOffsetsPerTrigger", MAX_OFFSETS_PER_TRIGGER),
        min_partitions=figure("minPartitions", None),
    )
    root = os.environ.get("ANALYTICS_OUTPUT_PATH") or f"{shared_folder(spark)}/orderflow/service"
    checkpoint = os.environ.get("ANALYTICS_CHECKPOINT_LOCATION")
    start_stream(
        process(messages),
        root,
        checkpoint,
        archive_every=figure("archiveEvery", ARCHIVE_EVERY),
        archive_leave=figure("archiveLeave", ARCHIVE_LEAVE),
        archive_wait_seconds=figure("archiveWaitSeconds", ARCHIVE_WAIT_SECONDS),
    ).awaitTermination()


if __name__ == "__main__":
    main()
