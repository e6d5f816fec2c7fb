"""Metrics kept up to date by Spark's own streaming state."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from orderflow.operators.metrics import METRICS
from orderflow.operators.windows import windowed_orders
from orderflow.session import child_names, create_new, delete_path, modified_at, stored_bytes
from orderflow.streaming.store import ARCHIVE_FILE_BYTES

#: Batches of results that are merged together, at least.
MERGED_BATCHES = 8


def streaming_metrics(stream: DataFrame, metric: str) -> DataFrame:
    """A metric over everything a stream has brought so far.

    For complete mode, or update mode to get changed groups only. State has
    one row per group.
    """
    return METRICS[metric](stream)


def streaming_windowed_orders(
    stream: DataFrame, lateness: str, duration: str = "1 minute", slide: str | None = None
) -> DataFrame:
    """Window counts with bounded state: rows later than ``lateness`` are dropped.

    Update mode gives each change of a window, append mode each window once
    its time has passed. To count late rows whatever their age, use the stored
    pipeline, whose per-minute state never closes.
    """
    return windowed_orders(stream.withWatermark("timestamp", lateness), duration, slide)


def dedup_orders(stream: DataFrame, lateness: str) -> DataFrame:
    """Drop repeats of an order id that come within ``lateness`` of each other.

    Off unless called: repeated order ids count as orders of their own. Belongs
    after the row rules, which refuse rows without an order id; those would
    all be repeats of one another.
    """
    return stream.withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["order_id"])


def write_results(
    results: DataFrame,
    folder: str,
    output_mode: str,
    checkpoint: str | None = None,
    trigger: dict[str, object] | None = None,
    keys: list[str] | None = None,
    keep_seconds: int = 3600,
) -> StreamingQuery:
    """Write what each micro-batch of a streaming aggregate gives below ``folder``.

    Tasks write the rows; a batch that runs again replaces its own folder.
    Complete mode replaces the result before. In append mode, and in update mode
    where ``keys`` are given, batches are merged into one table whenever they
    hold as much as it does: then the folder stays within a few times the present
    result, and a row is written again a logarithmic number of times. What is
    replaced stays for ``keep_seconds``: so long may a reader be on a frame it made.
    """
    mergeable = output_mode == "append" or (output_mode == "update" and bool(keys))

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        owner = f"stream={spark.sparkContext.getLocalProperty('sql.streaming.queryId') or ''}"
        if child_names(spark, f"{folder}/owner") not in ([], [owner]):
            raise ValueError(f"the results below {folder} belong to another stream checkpoint")
        create_new(spark, f"{folder}/owner/{owner}")
        if max(_numbers(spark, folder, _DONE), default=-1) >= batch_id:
            return
        batch_df.write.mode("overwrite").parquet(_part(folder, _BATCHES, batch_id))
        if output_mode == "complete":
            create_new(spark, _part(folder, _DONE, batch_id))
        elif mergeable:
            _merge_results(spark, folder, batch_df.schema, batch_id, keys)
        _drop_merged(spark, folder, keep_seconds, output_mode == "complete")

    return (
        results.writeStream.outputMode(output_mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint or f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


# Below a result folder: what each batch gave, the merged table up to a batch, and
# an empty file for each number whose folder is finished and replaces those before.
_BATCHES, _MERGED, _DONE = "results", "merged", "done"


def _part(folder: str, table: str, number: int) -> str:
    return f"{folder}/{table}/batch_id={number}"


def _numbers(spark: SparkSession, folder: str, table: str) -> list[int]:
    names = [name.partition("=") for name in child_names(spark, f"{folder}/{table}")]
    return sorted(int(number) for kind, _, number in names if kind == "batch_id")


def _read_parts(spark: SparkSession, folder: str, schema: StructType, parts: list[tuple[str, int]]) -> DataFrame:
    """The rows of some folders, with the number of theirs as ``batch_id``."""
    stored = StructType([*schema, StructField("batch_id", LongType())])
    frames = [
        spark.read.schema(stored).option("basePath", f"{folder}/{table}").parquet(
            *[_part(folder, t, number) for t, number in parts if t == table]
        )
        for table in sorted({table for table, _ in parts})
    ]
    return reduce(DataFrame.unionAll, frames, spark.createDataFrame([], stored))


def _last_per_key(rows: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    values = F.struct(*[name for name in names if name not in keys])
    last = rows.groupBy(*keys).agg(F.max_by(values, "batch_id").alias("last"))
    return last.select(*keys, "last.*").select(*names)


def _live_parts(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """The merged table, if there is one, and the batches since."""
    merged = max(_numbers(spark, folder, _DONE), default=-1)
    since = [(_BATCHES, n) for n in _numbers(spark, folder, _BATCHES) if n > merged]
    return [(_MERGED, merged), *since] if merged >= 0 else since


def _merge_results(
    spark: SparkSession, folder: str, schema: StructType, batch_id: int, keys: list[str] | None
) -> None:
    """Merge batches with the table before once they are several and hold as many bytes as it."""
    parts = _live_parts(spark, folder)
    sizes = {part: stored_bytes(spark, _part(folder, *part)) for part in parts}
    fresh = [part for part in parts if part[0] == _BATCHES]
    if len(fresh) < MERGED_BATCHES or 2 * sum(sizes[part] for part in fresh) < sum(sizes.values()):
        return
    rows = _read_parts(spark, folder, schema, parts)
    rows = _last_per_key(rows, schema.names, keys) if keys else rows.drop("batch_id")
    # By key, so that each file has its share of them; only as many as the data fills.
    files = 1 + sum(sizes.values()) // ARCHIVE_FILE_BYTES
    rows.repartition(files, *(keys or [])).write.mode("overwrite").parquet(_part(folder, _MERGED, batch_id))
    create_new(spark, _part(folder, _DONE, batch_id))


def _drop_merged(spark: SparkSession, folder: str, keep_seconds: int, complete: bool) -> None:
    """Remove what a finished folder has replaced for ``keep_seconds``."""
    since = datetime.now(timezone.utc) - timedelta(seconds=keep_seconds)
    done = _numbers(spark, folder, _DONE)
    old = [n for n in done if modified_at(spark, _part(folder, _DONE, n)) <= since]
    if not old:
        return
    upto = old[-1]
    for n in done:
        if n < upto:
            delete_path(spark, _part(folder, _DONE, n))
    for n in _numbers(spark, folder, _MERGED):
        # One without its mark was broken off and is written anew.
        if n < upto:
            delete_path(spark, _part(folder, _MERGED, n))
    for n in _numbers(spark, folder, _BATCHES):
        if n < upto or (n == upto and not complete):
            delete_path(spark, _part(folder, _BATCHES, n))


def read_results(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    output_mode: str,
    keys: list[str] | None = None,
) -> DataFrame:
    """The present state of what ``write_results`` wrote.

    Complete mode: the last finished batch. Append mode: all batches. Update
    mode: the last row per key.
    """
    if output_mode == "complete":
        done = _numbers(spark, folder, _DONE)
        return _read_parts(spark, folder, schema, [(_BATCHES, n) for n in done[-1:]]).drop("batch_id")
    rows = _read_parts(spark, folder, schema, _live_parts(spark, folder))
    return rows.drop("batch_id") if output_mode == "append" else _last_per_key(rows, schema.names, keys)
