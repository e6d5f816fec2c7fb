"""Stored metric snapshots and the freshness of a pipeline.

A snapshot is the long metric frame of ``rollup``, kept as one folder of
Parquet files per version, so that a reader never meets half of one. Snapshot
documents, single JSON objects with five numbers and five lists, are read too.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderflow.functions.display import MISSING_TEXT
from orderflow.operators.metrics import ranked
from orderflow.plans.rollup import (
    KEYED_METRICS,
    REVENUE_METRICS,
    SCALAR_METRICS,
    SNAPSHOT_COLUMNS,
    WINDOWED_METRIC,
    metric_frames,
)
from orderflow.session import path_exists, staged
from orderflow.sources.files import json_value

SNAPSHOT_SCHEMA = (
    StructType()
    .add("metric", "string")
    .add("key", "string")
    .add("window_start", "timestamp")
    .add("window_end", "timestamp")
    .add("order_count", "long")
    .add("revenue", "double")
    .add("computed_at", "timestamp")
    .add("batch_id", "long")
)

UNKNOWN = "Unknown"


def write_snapshot(rows: DataFrame, path: str, batch_id: int, computed_at: Column) -> None:
    """Store the long metric frame as version ``batch_id``; a rewrite replaces it."""
    (
        rows.select(*SNAPSHOT_COLUMNS, computed_at.alias("computed_at"))
        .write.mode("overwrite")
        .parquet(f"{path}/batch_id={batch_id}")
    )


def empty_snapshot(spark: SparkSession) -> DataFrame:
    """The long frame of a pipeline that has seen nothing."""
    return spark.createDataFrame([], SNAPSHOT_SCHEMA)


def read_snapshot_rows(
    spark: SparkSession, path: str, version: int | None = None
) -> DataFrame:
    """The long metric frame of a version, by default the newest.

    Empty if none was asked for and none is stored; a version that was asked
    for and is not there is an error. The tables of a stream are read through
    ``TransactionStore.snapshot_rows``.
    """
    if version is not None:
        folder = f"{path}/batch_id={version}"
        if not path_exists(spark, folder):
            raise ValueError(f"version {version} is not stored at {path}")
        return spark.read.schema(SNAPSHOT_SCHEMA).option("basePath", path).parquet(folder)
    if not path_exists(spark, path):
        return empty_snapshot(spark)
    stored = spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)
    wanted = stored.select(F.max("batch_id")).scalar()
    return stored.where(F.col("batch_id") == wanted)


def snapshot_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The metrics of a long frame, scalars as one row each and tables sorted."""
    frames = metric_frames(rows)
    tables = {}
    for metric, frame in frames.items():
        if metric in SCALAR_METRICS:
            # An aggregate gives a row even where the snapshot has none.
            zero = F.lit(0.0 if metric in REVENUE_METRICS else 0)
            tables[metric] = frame.agg(F.coalesce(F.max(metric), zero).alias(metric))
        elif metric == WINDOWED_METRIC:
            tables[metric] = ranked(frame, "window_start")
        else:
            tables[metric] = ranked(frame, frame.columns[-1])
    return tables


def read_snapshot(
    spark: SparkSession, path: str, version: int | None = None
) -> dict[str, DataFrame]:
    """The metrics of a stored snapshot by name."""
    return snapshot_tables(read_snapshot_rows(spark, path, version))


def export_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Write each metric as JSON lines below ``path``, window bounds as text."""
    for name, table in tables.items():
        times = [f.name for f in table.schema if f.dataType.typeName().startswith("timestamp")]
        texts = {time: F.date_format(time, "yyyy-MM-dd HH:mm:ss") for time in times}
        rows = table.withColumns(texts) if texts else table
        rows.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}")


def document_of(
    rows: DataFrame, recent: DataFrame | None = None, windows: bool = True
) -> DataFrame:
    """The long metric frame as one JSON object, in one row of one column ``value``.

    Five numbers and five lists, sorted as the tables are, window bounds as
    text; with ``recent``, its rows as ``recent_transactions``, in their order. A
    document is made by one task and is for what one reader can take at once;
    ``windows=False`` leaves out the list of windows, which grows with the time.
    """
    measures = {
        metric: ("revenue", F.lit(0.0)) if metric in REVENUE_METRICS else ("order_count", F.lit(0))
        for metric in (*SCALAR_METRICS, *KEYED_METRICS, WINDOWED_METRIC)
    }
    found = []
    for metric in SCALAR_METRICS:
        measure, zero = measures[metric]
        value = F.max(F.when(F.col("metric") == metric, F.col(measure)))
        found.append(F.coalesce(value, zero).alias(metric))

    def listed(metric: str, order: list[Column], *fields: Column) -> Column:
        item = F.struct(F.struct(*order).alias("order"), F.struct(*fields).alias("item"))
        sorted_items = F.array_sort(F.collect_list(F.when(F.col("metric") == metric, item)))
        return F.transform(sorted_items, lambda entry: entry["item"]).alias(metric)

    for metric, column in KEYED_METRICS.items():
        measure, _ = measures[metric]
        place = [(-F.col(measure)).alias("measure"), F.col("key")]
        found.append(listed(metric, place, F.col("key").alias(column), F.col(measure)))
    times = [
        F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name) for name in ("window_start", "window_end")
    ]
    newest = [(-F.unix_micros(F.col("window_start").cast("timestamp"))).alias("newest")]
    if windows:
        found.append(listed(WINDOWED_METRIC, newest, *times, F.col("order_count")))
    document = rows.agg(*found)
    if recent is not None:
        numbered = recent.select(
            F.struct(F.monotonically_increasing_id().alias("place"), F.struct("*").alias("row")).alias("item")
        )
        items = numbered.agg(F.array_sort(F.collect_list("item")).alias("items")).select(
            F.transform("items", lambda item: item["row"])
        )
        document = document.withColumn("recent_transactions", items.scalar())
    everything = F.struct(*[F.col(name) for name in document.columns])
    return document.select(F.to_json(everything, {"ignoreNullFields": "false"}).alias("value"))


def write_document(rows: DataFrame, path: str, recent: DataFrame | None = None) -> None:
    """Write the long metric frame as one JSON document, for ``read_documents``."""
    document_of(rows, recent).write.mode("overwrite").text(path)


def write_document_parts(rows: DataFrame, path: str) -> None:
    """The document without its windows below ``path``, and these beside it as JSON lines."""
    rows = staged(rows, "parts")
    document_of(rows, windows=False).write.mode("overwrite").text(f"{path}/document")
    export_tables({WINDOWED_METRIC: metric_frames(rows)[WINDOWED_METRIC]}, path)


def read_document_parts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of ``write_document_parts``; lines are read in parallel, newest window first."""
    windows = spark.read.schema("window_start string, window_end string, order_count bigint").json(
        f"{path}/{WINDOWED_METRIC}"
    )
    tables = document_tables(read_documents(spark, f"{path}/document"))
    return tables | {WINDOWED_METRIC: windows.orderBy(F.desc("window_start"))}


def _member(name: str, kind: str, of: str = "document") -> Column:
    return F.try_variant_get(F.col(of), f"$.{name}", kind)


def _document_items(documents: DataFrame, name: str, *fields: str) -> DataFrame:
    """The items of one list, with ``has_<field>``: whether any item has that field."""

    def given(field: str) -> Column:
        return F.exists(
            "items", lambda item: F.try_variant_get(item, f"$.{field}", "variant").isNotNull()
        ).alias(f"has_{field}")

    lists = documents.select(_member(name, "array<variant>").alias("items"))
    return lists.select(*[given(field) for field in fields], F.explode("items").alias("item"))


def _item_text(field: str, default: str) -> Column:
    """A text field of the items, or the default where no item has the field at all."""
    return F.when(F.col(f"has_{field}"), _member(field, "string", "item")).otherwise(default)


def _item_number(field: str, kind: str) -> Column:
    number = _member(field, "string", "item").try_cast("double")
    return F.coalesce(number, F.lit(0.0)).cast(kind)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A snapshot document as ``text`` and ``document``, null where it is no JSON.

    No row where there is no file.
    """
    if not path_exists(spark, path):
        text = spark.createDataFrame([], "text string, computed_at timestamp")
        return text.withColumn("document", json_value(F.col("text")))
    text = spark.read.text(path, wholetext=True).select(
        F.btrim("value", F.lit(" \t\r\n")).alias("text"),
        F.col("_metadata.file_modification_time").alias("computed_at"),
    )
    return text.withColumn("document", json_value(F.col("text")))


def document_tables(documents: DataFrame) -> dict[str, DataFrame]:
    """The metrics of a snapshot document by name, made good where it is incomplete.

    A missing number is 0 and so is one that is none, a missing name column is
    ``Unknown``, and the tables are sorted again.
    """
    tables = {}
    for metric in SCALAR_METRICS:
        kind = "double" if metric in REVENUE_METRICS else "bigint"
        value = F.coalesce(F.max(_member(metric, kind)), F.lit(0).cast(kind))
        tables[metric] = documents.agg(value.alias(metric))
    for metric, column in KEYED_METRICS.items():
        measure, kind = "order_count", "bigint"
        if metric in REVENUE_METRICS:
            measure, kind = "revenue", "double"
        items = _document_items(documents, metric, column).select(
            _item_text(column, UNKNOWN).alias(column), _item_number(measure, kind).alias(measure)
        )
        tables[metric] = ranked(items, measure)
    bounds = ("window_start", "window_end")
    tables[WINDOWED_METRIC] = _document_items(documents, WINDOWED_METRIC, *bounds).select(
        *[_item_text(name, MISSING_TEXT).alias(name) for name in bounds],
        _item_number("order_count", "bigint").alias("order_count"),
    )
    return tables


def snapshot_freshness(rows: DataFrame) -> DataFrame:
    """Order total and time of a stored snapshot in one row, without error."""
    total = F.max(F.when(F.col("metric") == "total_orders", F.col("order_count")))
    return rows.agg(
        F.coalesce(total, F.lit(0)).alias("total_orders"),
        F.max("computed_at").alias("computed_at"),
        F.lit(None).cast("string").alias("error"),
    )


def document_freshness(documents: DataFrame) -> DataFrame:
    """Order total, time and read error of a snapshot document in one row."""
    filled = F.col("text") != ""
    # The beginnings of the two messages.
    problem = F.when(
        filled & F.col("document").isNull(),
        F.lit("Error reading analytics output: not valid JSON"),
    ).when(
        filled & ~F.schema_of_variant("document").startswith("OBJECT"),
        F.lit("Invalid analytics format (expected JSON object)"),
    )
    return documents.agg(
        F.coalesce(F.max(_member("total_orders", "bigint")), F.lit(0)).alias("total_orders"),
        F.max(F.when(filled, F.col("computed_at"))).alias("computed_at"),
        F.max(problem).alias("error"),
    )


def read_freshness(spark: SparkSession, path: str) -> DataFrame:
    """Freshness row of the snapshot stored at ``path``, with the error if it is unreadable."""
    schema = "total_orders bigint, computed_at timestamp, error string"
    try:
        found = snapshot_freshness(read_snapshot_rows(spark, path)).first()
    except (PySparkException, Py4JJavaError) as problem:
        reason = str(getattr(problem, "java_exception", problem)).splitlines()[0]
        found = (0, None, f"Error reading analytics output: {reason}")
    return spark.createDataFrame([tuple(found)], schema)


def pipeline_status(freshness: DataFrame, now: Column, stale_seconds: int = 60) -> DataFrame:
    """Whether the pipeline behind a snapshot is live, from its freshness row.

    ``ERROR`` if the snapshot cannot be read, ``WAITING`` without orders,
    ``LIVE`` up to ``stale_seconds`` of age, else ``PAUSED``. Where the row has the
    stream's last sign of life as ``alive_at``, that counts like new data, so an
    idle stream stays ``LIVE``; one that has ``stopped`` is ``PAUSED`` at once.
    """
    beats = {"alive_at", "stopped"} <= set(freshness.columns)
    failed = F.col("error").isNotNull()
    has_data = ~failed & (F.col("total_orders") > 0) & F.col("computed_at").isNotNull()

    def seconds_since(time: Column) -> Column:
        micros = F.unix_micros(now.cast("timestamp")) - F.unix_micros(time.cast("timestamp"))
        return F.greatest(micros / F.lit(1e6), F.lit(0.0))

    age = seconds_since(F.col("computed_at"))
    quiet = F.least(age, seconds_since(F.col("alive_at"))) if beats else age
    live = (quiet <= stale_seconds) & ~F.col("stopped") if beats else quiet <= stale_seconds
    updated = F.date_format("computed_at", "yyyy-MM-dd HH:mm:ss")
    status = (
        F.when(failed, "ERROR")
        .when(~has_data, "WAITING")
        .when(live, "LIVE")
        .otherwise("PAUSED")
    )
    # Badges and messages of each status.
    badge = (
        F.when(F.col("status") == "ERROR", "🔴 ERROR")
        .when(F.col("status") == "WAITING", "⚪ WAITING")
        .when(F.col("status") == "LIVE", "🟢 LIVE • Kafka + Spark Streaming")
        .otherwise("🟡 PAUSED • Stream Inactive")
    )
    message = (
        F.when(F.col("status") == "ERROR", F.col("error"))
        .when(F.col("status") == "WAITING", "Waiting for streaming data...")
        .when(
            F.col("status") == "LIVE",
            F.concat(
                F.lit("LIVE • Streaming active (updated "),
                F.floor("age_seconds").cast("string"),
                F.lit("s ago)"),
            ),
        )
        .otherwise(
            F.concat(
                F.lit("PAUSED • Stream inactive (last active: "),
                F.col("last_updated"),
                F.lit(")"),
            )
        )
    )
    return (
        freshness.select(
            status.alias("status"),
            has_data.alias("has_data"),
            "error",
            updated.alias("last_updated"),
            F.col("computed_at").alias("last_updated_ts"),
            age.alias("age_seconds"),
        )
        .withColumn("is_live", F.col("status") == "LIVE")
        .withColumn("status_badge", badge)
        .withColumn("status_message", message)
    )
