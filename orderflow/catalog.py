"""Every operator as a query over the tables of a data folder.

Each query takes (spark, folder) and returns a frame. ``line`` queries use the
order lines joined to their dimensions, ``event`` queries the event table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from orderflow.functions.display import (
    currency_text,
    integer_text,
    to_display,
    with_display_formats,
)
from orderflow.functions.parse import (
    TIME_PATTERN,
    parse_transactions,
    process,
    process_records,
    with_event_time,
)
from orderflow.functions.quality import split_valid
from orderflow.operators import metrics
from orderflow.operators.explore import facet_values, filter_transactions, recent_transactions
from orderflow.operators.windows import as_interval, orders_in_last_minute, windowed_orders
from orderflow.plans.rollup import (
    KEYED_METRICS,
    METRIC_COLUMNS,
    REVENUE_METRICS,
    WINDOWED_METRIC,
    all_metrics,
    metric_frames,
    metrics_snapshot,
)
from orderflow.plans.snapshot import (
    document_freshness,
    document_of,
    export_tables,
    pipeline_status,
    read_document_parts,
    read_documents,
    read_snapshot_rows,
    snapshot_freshness,
    write_document_parts,
    write_snapshot,
)
from orderflow.schema import RAW_SCHEMA, validate_columns
from orderflow.session import apply_settings, delete_path, new_folder, staged
from orderflow.sources.files import read_csv_records, read_transactions_files, recent_from_file
from orderflow.sources.publish import publish_transactions, record_messages, to_messages
from orderflow.sources.views import (
    event_transaction_stream,
    event_transactions,
    line_transactions,
)
from orderflow.streaming.aggregates import (
    dedup_orders,
    read_results,
    streaming_metrics,
    streaming_windowed_orders,
    write_results,
)
from orderflow.streaming.jobs import process_batch, start_stream
from orderflow.streaming.store import TransactionStore

Query = Callable[[SparkSession, str], DataFrame]

SNAPSHOT_LAYOUT = ["metric", "key", "window_start", "window_end", "order_count", "revenue"]


def zoneless(df: DataFrame) -> DataFrame:
    """Times as the tables have them, without zone."""
    times = [f.name for f in df.schema if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast(TimestampNTZType()) for name in times})


def _on_lines(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(line_transactions(apply_settings(spark), folder))


def _on_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return zoneless(operator(event_transactions(apply_settings(spark), folder)))

    return query


# --- projections, filters, order ------------------------------------------------


def _amounts(df: DataFrame) -> DataFrame:
    return df.select(
        "order_id", "product_id", "quantity", "unit_price", "discount_percent", "total_amount"
    )


def _positions(metric: DataFrame, by: str) -> DataFrame:
    """The ranked metric with its positions; one row per group, so small."""
    keys = [F.col(name).asc() for name in metric.columns if name != by]
    order = Window.orderBy(F.col(by).desc(), *keys)
    return metrics.ranked(metric, by).withColumn("position", F.row_number().over(order))


def _chosen(df: DataFrame, city: str) -> DataFrame:
    found = filter_transactions(df, status="Returned", city=city, search=" 7 ")
    return found.select("order_id", "product_id", "product_name", "city", "order_status")


def _snake_case(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower().replace(" ", "_") for name in df.columns])


def _formatted(df: DataFrame) -> DataFrame:
    shown = with_display_formats(to_display(df))
    return _snake_case(shown)


def _kpi_texts(df: DataFrame) -> DataFrame:
    return metrics.kpis(df).select(
        integer_text(F.col("total_orders")).alias("total_orders"),
        integer_text(F.col("completed_orders")).alias("completed_orders"),
        currency_text(F.col("completed_revenue")).alias("completed_revenue"),
    )


# --- messages -------------------------------------------------------------------


def raw_records(processed: DataFrame) -> DataFrame:
    """Processed transactions back as raw records, times as text."""
    return processed.withColumn("timestamp", F.date_format("timestamp", TIME_PATTERN)).select(
        *RAW_SCHEMA.names
    )


def _parsed_props(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON column of the event table through a message of our own schema."""
    events = apply_settings(spark).read.parquet(f"{folder}/events.parquet")
    # The events' only key becomes the quantity, so that the parser types it.
    value = F.regexp_replace("props", '"k"', '"quantity"')
    parsed = parse_transactions(events.select(value.alias("value")))
    return parsed.groupBy("quantity").agg(F.count("*").alias("order_count"))


def _message_round_trip(df: DataFrame) -> DataFrame:
    processed = process(to_messages(raw_records(df)))
    return validate_columns(processed).drop("message")


def _event_times(df: DataFrame) -> DataFrame:
    text = df.select("order_id", F.date_format("timestamp", TIME_PATTERN).alias("timestamp"))
    return with_event_time(text)


def faulty_messages(df: DataFrame) -> DataFrame:
    """Messages of transactions, some with a fault that goes by the product id."""
    kind = F.col("product_id").cast("int") % 10
    raw = raw_records(df)
    broken = raw.withColumns(
        {
            "unit_price": F.when(kind == 2, -F.col("unit_price") - 1).otherwise(F.col("unit_price")),
            "discount_percent": F.when(kind == 3, F.col("discount_percent") + 101).otherwise(
                F.col("discount_percent")
            ),
            "timestamp": F.when(kind == 4, F.replace("timestamp", F.lit(" "), F.lit("T"))).otherwise(
                F.col("timestamp")
            ),
            "order_id": F.when(kind == 5, F.lit(" ")).otherwise(F.col("order_id")),
            "fault": kind,
        }
    )
    message = F.to_json(F.struct(*RAW_SCHEMA.names))
    quoted = F.regexp_replace(message, r'"quantity":(\d+)', '"quantity":"$1"')
    return broken.select(
        F.when(F.col("fault") == 1, quoted)
        .when(F.col("fault") == 6, F.lit("not json"))
        .when(F.col("fault") == 7, F.lit(None))
        .otherwise(message)
        .alias("value")
    )


def _refused_by_reason(df: DataFrame) -> DataFrame:
    _, refused = split_valid(process(faulty_messages(df)))
    return refused.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(
        F.count("*").alias("order_count")
    )


def _valid_only(df: DataFrame) -> DataFrame:
    valid, _ = split_valid(process(faulty_messages(df)))
    return metrics.revenue_by_category(valid)


# --- files ----------------------------------------------------------------------


def _through_files(fmt: str) -> Query:
    """The event transactions written in a file format and read back from it."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = new_folder(apply_settings(spark), fmt)
        raw = raw_records(event_transactions(spark, folder))
        if fmt == "csv":
            raw.write.options(header=True, escape='"').csv(path)
        else:
            publish_transactions(raw, "text", path=path)
        return zoneless(process_records(read_transactions_files(spark, path, fmt))).drop("message", "corrupt")

    return query


def _faulty_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Refused rows by reason, of a CSV whose faults go by the product id.

    Rows that miss their last field, that have one too many, and with text for a number.
    """
    path = new_folder(apply_settings(spark), "csv")
    raw = raw_records(event_transactions(spark, folder))
    kind = F.col("product_id").cast("int") % 10
    fields = [F.col(name).cast("string") for name in RAW_SCHEMA.names]
    number = RAW_SCHEMA.names.index("quantity")
    bad = [*fields[:number], F.lit("x"), *fields[number + 1 :]]
    line = (
        F.when(kind == 1, F.concat_ws(",", *fields[:-1]))
        .when(kind == 2, F.concat_ws(",", *fields, F.lit("more")))
        .when(kind == 3, F.concat_ws(",", *bad))
        .otherwise(F.concat_ws(",", *fields))
    )
    # One column that bears the whole header as its name; its separator occurs nowhere.
    whole = raw.select(line.alias(",".join(RAW_SCHEMA.names)))
    whole.write.options(header=True, sep="\u0001").csv(path)
    _, refused = split_valid(process_records(read_transactions_files(spark, path)))
    return refused.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(
        F.count("*").alias("order_count"),
        F.count_if(F.col("message").isNotNull()).alias("with_text"),
    )


def _quoted_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Events through CSV files whose texts hold line breaks, quotes and separators."""
    path = new_folder(apply_settings(spark), "csv")
    raw = raw_records(event_transactions(spark, folder))
    name = F.concat(F.lit('two\nlines, "'), "order_id", F.lit('"\n'))
    broken = raw.withColumn("product_name", F.when(F.col("product_id").cast("int") % 3 == 1, name))
    # The writer would cut blanks, line breaks among them, off the ends of fields.
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    broken.write.options(header=True, escape='"', **whole).csv(path)
    read = process_records(read_transactions_files(spark, path, quoted_lines=True))
    return zoneless(read.where("not corrupt").drop("message", "corrupt"))


def _published_fields(spark: SparkSession, folder: str) -> DataFrame:
    """What messages of CSV files hold that have further columns, bad numbers and short rows.

    Two sets of files with different headers; faults go by the product id.
    """
    path = new_folder(apply_settings(spark), "csv")
    raw = raw_records(event_transactions(spark, folder))
    kind = F.col("product_id").cast("int") % 10
    fields = [F.col(name).cast("string").alias(name) for name in RAW_SCHEMA.names]
    number = RAW_SCHEMA.names.index("quantity")
    bad = [*fields[:number], F.lit("two"), *fields[number + 1 :]]
    coupon, note = F.concat(F.lit("C"), "product_id"), F.concat(F.lit("note "), "order_id")
    line = (
        F.when(kind == 1, F.concat_ws(",", *fields))
        .when(kind == 2, F.concat_ws(",", *bad, coupon, note))
        .otherwise(F.concat_ws(",", *fields, coupon, note))
    )
    header = ",".join([*RAW_SCHEMA.names, "coupon", "note"])
    raw.where(kind < 5).select(line.alias(header)).write.options(header=True, sep="\u0001").csv(f"{path}/more")
    raw.where(kind >= 5).select(*fields[::-1]).write.options(header=True).csv(f"{path}/plain")
    messages = record_messages(read_csv_records(spark, path, recursiveFileLookup=True))
    whole = messages.select("value", F.try_parse_json("value").alias("fields"))
    of = lambda name, kind="string": F.try_variant_get("fields", f"$.{name}", kind)
    return whole.select(
        F.coalesce(of("order_id"), F.split_part("value", F.lit(","), F.lit(1))).alias("order_id"),
        of("quantity").alias("quantity"),
        F.schema_of_variant(of("quantity", "variant")).alias("quantity_type"),
        of("unit_price", "double").alias("unit_price"),
        of("city").alias("city"),
        of("coupon").alias("coupon"),
        of("note").alias("note"),
    )


def _recent_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The last rows of sorted files of JSON lines, written and read in parallel."""
    path = new_folder(apply_settings(spark), "json")
    events = event_transactions(spark, folder).orderBy("timestamp", "order_id")
    publish_transactions(events, "text", path=path)
    return _snake_case(recent_from_file(spark, path, "ndjson"))


# --- all metrics ----------------------------------------------------------------


def _line_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """All metrics of the order lines. The joins run once, into a staged table."""
    lines = line_transactions(apply_settings(spark), folder)
    return zoneless(metrics_snapshot(staged(lines.select(*METRIC_COLUMNS), "lines")))


def _metric_table(name: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: metric_frames(metrics_snapshot(df))[name]


def _stored_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(apply_settings(spark), "snapshot")
    rows = metrics_snapshot(event_transactions(spark, folder))
    write_snapshot(rows, path, 0, F.current_timestamp())
    return zoneless(read_snapshot_rows(spark, path).select(*SNAPSHOT_LAYOUT))


def _document_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All metrics through a snapshot document and its windows' lines, in the long layout."""
    path = new_folder(apply_settings(spark), "document")
    write_document_parts(metrics_snapshot(event_transactions(spark, folder)), path)
    tables = read_document_parts(spark, path)
    parts = []
    for metric, table in tables.items():
        keyed = {"key": table.columns[0]} if metric in KEYED_METRICS else {}
        measure = "revenue" if metric in REVENUE_METRICS else "order_count"
        value = table.columns[-1]
        columns = {**dict.fromkeys(SNAPSHOT_LAYOUT, "NULL"), **keyed, measure: f"`{value}`"}
        if metric == WINDOWED_METRIC:
            columns |= {"window_start": "window_start", "window_end": "window_end"}
        columns["metric"] = f"'{metric}'"
        kinds = ("string", "string", "timestamp_ntz", "timestamp_ntz", "bigint", "double")
        parts.append(
            table.selectExpr(
                *[f"CAST({columns[c]} AS {k}) AS {c}" for c, k in zip(SNAPSHOT_LAYOUT, kinds)]
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _document_status(spark: SparkSession, folder: str) -> DataFrame:
    """Status of a document, of one with text behind it, and of one without orders."""
    events = event_transactions(apply_settings(spark), folder)
    whole = document_of(metrics_snapshot(events), windows=False)
    cases = {
        "whole": whole,
        "broken": whole.select(F.concat("value", F.lit(" and more {")).alias("value")),
        "empty": document_of(metrics_snapshot(events.limit(0)), windows=False),
    }
    found = []
    for case, document in cases.items():
        path = new_folder(spark, "document")
        document.write.text(path)
        freshness = document_freshness(read_documents(spark, path))
        now = F.col("computed_at") + as_interval("30 seconds")
        found.append(
            pipeline_status(freshness, now).select(
                F.lit(case).alias("document"), "status", "status_badge", "status_message", "error", "has_data"
            )
        )
    return reduce(DataFrame.unionByName, found)


def _exported_windows(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(apply_settings(spark), "export")
    with all_metrics(event_transactions(spark, folder)) as tables:
        export_tables({"windowed_orders": tables["windowed_orders"]}, path)
    schema = "window_start string, window_end string, order_count bigint"
    return spark.read.schema(schema).json(f"{path}/windowed_orders")


def _freshness(df: DataFrame) -> DataFrame:
    """Status of a snapshot as old as the last event, half a minute and two hours on."""
    newest = df.select(F.max(F.col("timestamp").cast("timestamp"))).scalar()
    freshness = snapshot_freshness(metrics_snapshot(df).withColumn("computed_at", newest))

    def status(case: str, later: str) -> DataFrame:
        now: Column = F.col("computed_at") + as_interval(later)
        return pipeline_status(freshness, now).select(
            F.lit(case).alias("looked_at"),
            "status",
            "status_badge",
            "status_message",
            "last_updated",
            "age_seconds",
            "is_live",
            "has_data",
        )

    return status("soon", "30 seconds").unionByName(status("late", "2 hours"))


# --- streams --------------------------------------------------------------------


def _drained(results: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """What a streaming frame has given once all input is through."""
    spark = results.sparkSession
    folder = new_folder(spark, "stream")
    write_results(results, folder, mode, keys=keys).awaitTermination()
    return zoneless(read_results(spark, folder, results.schema, mode, keys))


# Files of a micro-batch, and micro-batches, of the streams below.
FILES_PER_BATCH = 2
EVENT_BATCHES = 5
# Every so many of the first events come last in the stream with late rows.
HELD_BACK = 50


def _in_time_order(spark: SparkSession, folder: str, held_back: bool = False) -> str:
    """The event table as files that arrive slice of time by slice of time.

    With ``held_back``, some events of the first two slices come with the last.
    """
    path = new_folder(apply_settings(spark), "events")
    events = spark.read.parquet(f"{folder}/events.parquet")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = (events.select(pick(micros)).scalar() for pick in (F.min, F.max))
    piece = F.floor((micros - first) * EVENT_BATCHES / (last - first + 1))
    if held_back:
        late = (F.col("event_id") % HELD_BACK == 0) & (piece <= 1)
        piece = F.when(late, EVENT_BATCHES - 1).otherwise(piece)
    for number in range(EVENT_BATCHES):
        slice_ = events.where(piece == number).repartition(FILES_PER_BATCH)
        slice_.write.mode("append").parquet(f"{path}/events.parquet")
    return path


def _event_stream(spark: SparkSession, folder: str, held_back: bool = False) -> DataFrame:
    """The events in time order, in several micro-batches."""
    arriving = _in_time_order(spark, folder, held_back)
    return event_transaction_stream(spark, arriving, maxFilesPerTrigger=FILES_PER_BATCH)


def _stream_metric(name: str) -> Query:
    return lambda spark, folder: _drained(
        streaming_metrics(_event_stream(spark, folder), name), "complete"
    )


def _stream_windows(
    mode: str,
    duration: str,
    slide: str | None = None,
    lateness: str = "10 minutes",
    held_back: bool = False,
) -> Query:
    return lambda spark, folder: _drained(
        streaming_windowed_orders(
            _event_stream(spark, folder, held_back), lateness, duration, slide
        ),
        mode,
        ["window_start", "window_end"],
    )


def _stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event sent twice, and the second one dropped."""
    arriving = _in_time_order(spark, folder)
    first, second = (
        event_transaction_stream(spark, arriving, maxFilesPerTrigger=FILES_PER_BATCH)
        for _ in range(2)
    )
    twice = first.unionByName(second)
    unique = _drained(dedup_orders(twice, "10 minutes"), "append")
    return metrics.order_status_distribution(unique)


def message_stream(spark: SparkSession, messages: DataFrame, batches: int = 4) -> DataFrame:
    """Messages as a stream of files in this many micro-batches."""
    path = new_folder(spark, "messages")
    messages.repartition(batches * FILES_PER_BATCH).write.text(path)
    return spark.readStream.option("maxFilesPerTrigger", FILES_PER_BATCH).text(path)


def _run_store(spark: SparkSession, messages: DataFrame) -> TransactionStore:
    """The stored tables after all messages went through as a stream."""
    root = new_folder(spark, "store")
    processed = process(message_stream(spark, messages))
    start_stream(processed, root, trigger={"availableNow": True}).awaitTermination()
    return TransactionStore(spark, root)


def _stream_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    messages = to_messages(raw_records(event_transactions(apply_settings(spark), folder)))
    return zoneless(_run_store(spark, messages).snapshot_rows().select(*SNAPSHOT_LAYOUT))


def _stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    messages = faulty_messages(event_transactions(apply_settings(spark), folder))
    refused = _run_store(spark, messages).quarantine()
    return refused.groupBy(F.array_join("reasons", ",").alias("reasons")).agg(
        F.count("*").alias("order_count")
    )


def _stream_history(spark: SparkSession, folder: str) -> DataFrame:
    messages = faulty_messages(event_transactions(apply_settings(spark), folder))
    return zoneless(_run_store(spark, messages).history().drop("batch_id"))


def _archived_history(spark: SparkSession, folder: str) -> DataFrame:
    """History after two archive runs, of which the first lost its record."""
    messages = to_messages(raw_records(event_transactions(apply_settings(spark), folder)))
    store = _run_store(spark, messages)
    store.compact(leave=2)
    delete_path(spark, store.path("archives"))
    store.compact(leave=1)
    store.drop_archived()
    return zoneless(store.history().drop("batch_id"))


def _replayed(spark: SparkSession, folder: str) -> TransactionStore:
    """The tables after one batch was handed in twice."""
    root = new_folder(apply_settings(spark), "replay")
    events = event_transactions(spark, folder)
    for _ in range(2):
        process_batch(events, 0, root)
    return TransactionStore(spark, root)


def _replayed_batch(spark: SparkSession, folder: str) -> DataFrame:
    return zoneless(_replayed(spark, folder).snapshot_rows().select(*SNAPSHOT_LAYOUT))


def _stored_recent(n: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        recent = _replayed(spark, folder).recent(n)
        return _snake_case(with_display_formats(to_display(recent)))

    return query


QUERIES: dict[str, Query] = {
    # scalars and breakdowns over the order lines
    "kpis": _on_lines(metrics.kpis),
    "total_orders": _on_lines(metrics.total_orders),
    "completed_orders": _on_lines(metrics.completed_orders),
    "returned_orders": _on_lines(metrics.returned_orders),
    "completed_revenue": _on_lines(metrics.completed_revenue),
    "revenue_by_category": _on_lines(metrics.revenue_by_category),
    "orders_by_city": _on_lines(metrics.orders_by_city),
    "payment_method_distribution": _on_lines(metrics.payment_method_distribution),
    "order_status_distribution": _on_lines(metrics.order_status_distribution),
    "status_ratios": _on_lines(lambda df: metrics.status_ratios(metrics.kpis(df))),
    "ranked_categories": _on_lines(
        lambda df: _positions(metrics.revenue_by_category(df), "revenue")
    ),
    "ranked_cities": _on_lines(lambda df: _positions(metrics.orders_by_city(df), "order_count")),
    "total_amounts": _on_lines(_amounts),
    "filter_transactions": _on_lines(lambda df: _chosen(df, "NATION_3")),
    "city_facet": _on_lines(lambda df: facet_values(df, "city")),
    "status_facet": _on_lines(lambda df: facet_values(df, "order_status")),
    "display_transactions": _on_lines(lambda df: _snake_case(to_display(df))),
    "line_metrics": _line_metrics,
    # the same and more over the events
    "event_kpis": _on_events(metrics.kpis),
    "event_revenue_by_category": _on_events(metrics.revenue_by_category),
    "event_orders_by_city": _on_events(metrics.orders_by_city),
    "event_payment_methods": _on_events(metrics.payment_method_distribution),
    "event_statuses": _on_events(metrics.order_status_distribution),
    "event_filter": _on_events(lambda df: _chosen(df, "CITY_3")),
    "event_formats": _on_events(_formatted),
    "event_kpi_texts": _on_events(_kpi_texts),
    "event_metrics": _on_events(metrics_snapshot),
    "event_metric_windows": _on_events(_metric_table("windowed_orders")),
    "event_metric_revenue": _on_events(_metric_table("completed_revenue")),
    "recent_transactions": _on_events(lambda df: _snake_case(recent_transactions(df))),
    "windowed_orders": _on_events(windowed_orders),
    "sliding_windowed_orders": _on_events(
        lambda df: windowed_orders(df, "10 minutes", "5 minutes")
    ),
    "day_by_minute_windows": _on_events(lambda df: windowed_orders(df, "1 day", "1 minute")),
    "uneven_sliding_windows": _on_events(
        lambda df: windowed_orders(df, "1 hour 30 minutes", "25 minutes")
    ),
    "orders_in_last_minute": _on_events(orders_in_last_minute),
    "orders_in_last_hour": _on_events(lambda df: orders_in_last_minute(df, "1 hour")),
    # messages and files
    "parsed_messages": _parsed_props,
    "message_round_trip": _on_events(_message_round_trip),
    "event_times": _on_events(_event_times),
    "refused_by_reason": _on_events(_refused_by_reason),
    "valid_revenue_by_category": _on_events(_valid_only),
    "csv_round_trip": _through_files("csv"),
    "ndjson_round_trip": _through_files("ndjson"),
    "csv_refused_by_reason": _faulty_csv,
    "quoted_csv_round_trip": _quoted_csv,
    "published_fields": _published_fields,
    "recent_json_lines": _recent_of_lines,
    # snapshots
    "stored_snapshot": _stored_snapshot,
    "exported_windows": _exported_windows,
    "freshness_status": _on_events(_freshness),
    "document_round_trip": _document_round_trip,
    "document_status": _document_status,
    # streams
    "stream_kpis": _stream_metric("kpis"),
    "stream_revenue_by_category": _stream_metric("revenue_by_category"),
    "stream_orders_by_city": _stream_metric("orders_by_city"),
    "stream_payment_methods": _stream_metric("payment_method_distribution"),
    "stream_statuses": _stream_metric("order_status_distribution"),
    "stream_windowed_orders": _stream_windows("update", "1 minute"),
    "stream_sliding_windowed_orders": _stream_windows("update", "10 minutes", "5 minutes"),
    "stream_closed_windows": _stream_windows("append", "1 minute"),
    "stream_late_rows": _stream_windows("update", "1 minute", held_back=True),
    "stream_dedup": _stream_dedup,
    "stream_snapshot": _stream_snapshot,
    "stream_history": _stream_history,
    "stream_quarantine": _stream_quarantine,
    "replayed_batch": _replayed_batch,
    "stored_recent": _stored_recent(20),
    "stored_recent_500": _stored_recent(500),
    "archived_history": _archived_history,
}
