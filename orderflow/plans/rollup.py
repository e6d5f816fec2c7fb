"""All metrics of a frame together.

A *margin* is the count and amount of the rows that share one value of one
dimension. Margins of disjoint inputs add up, so they serve both as the
pre-aggregation of a batch and as the state a stream carries along. There are
as many as the dimensions have values in sum, not in product, and Spark
combines them per task before the shuffle, so a value holding a third of all
rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.operators.metrics import UNITS_TYPE, as_revenue, outsize, sum_units, units
from orderflow.operators.windows import as_interval
from orderflow.schema import COMPLETED, RETURNED, validate_columns
from orderflow.session import delete_path, new_folder

# The dimension holding the metric's key, for each metric with a key.
KEYED_METRICS = {
    "revenue_by_category": "category",
    "orders_by_city": "city",
    "payment_method_distribution": "payment_method",
    "order_status_distribution": "order_status",
}
SCALAR_METRICS = (
    "total_orders",
    "completed_orders",
    "returned_orders",
    "completed_revenue",
    "orders_in_last_minute",
)
WINDOWED_METRIC = "windowed_orders"
REVENUE_METRICS = ("completed_revenue", "revenue_by_category")

TEXT_DIMENSIONS = tuple(KEYED_METRICS.values())
MINUTE = "minute"
# Rows of this dimension count the event times of the last minute; see ``state_of``.
TAIL = "tail"

METRIC_COLUMNS = (*TEXT_DIMENSIONS, "timestamp", "total_amount")
# Amounts up to a bound add up in ``amount``, in units, the few beyond in ``outsize``.
MARGIN_COLUMNS = ("dimension", "key", "time", "order_count", "amount", "outsize")
NO_AMOUNTS = (f"CAST(NULL AS {UNITS_TYPE}) AS amount", "CAST(NULL AS DOUBLE) AS outsize")
SNAPSHOT_COLUMNS = ("metric", "key", "window_start", "window_end", "order_count", "revenue")


def text_margins(df: DataFrame) -> DataFrame:
    """Margins of processed transactions over each text dimension."""
    grouped = (
        df.select(
            *TEXT_DIMENSIONS,
            units(F.col("total_amount")).alias("units"),
            outsize(F.col("total_amount")).alias("beyond"),
        )
        .groupingSets([[name] for name in TEXT_DIMENSIONS], *TEXT_DIMENSIONS)
        .agg(
            F.count("*").alias("order_count"),
            sum_units(F.col("units")).alias("amount"),
            F.sum("beyond").alias("outsize"),
            F.grouping_id().alias("left_out"),
        )
    )
    # A bit is set for each dimension a row is not grouped by, first one highest;
    # only this tells a null value from a dimension left out.
    everything = 2 ** len(TEXT_DIMENSIONS) - 1
    places = " ".join(
        f"WHEN {everything - 2**place} THEN '{name}'"
        for place, name in enumerate(reversed(TEXT_DIMENSIONS))
    )
    return grouped.selectExpr(
        f"CASE left_out {places} END AS dimension",
        f"coalesce({', '.join(TEXT_DIMENSIONS)}) AS key",
        "CAST(NULL AS TIMESTAMP) AS time",
        "order_count",
        "amount",
        "outsize",
    )


def _counts_by_time(df: DataFrame, dimension: str, time: Column) -> DataFrame:
    """Rows per ``time``, in margin columns."""
    counted = df.groupBy(time.alias("time")).agg(F.count("*").alias("order_count"))
    return counted.selectExpr(
        f"'{dimension}' AS dimension",
        "CAST(NULL AS STRING) AS key",
        "time",
        "order_count",
        *NO_AMOUNTS,
    )


def minute_margins(df: DataFrame) -> DataFrame:
    """Rows per minute of processed transactions.

    Apart from the text dimensions: minutes may be many, and a task that has to
    spill them should not spill the few text values along with them. Of a
    columnar input this reads the one column the others leave out.
    """
    minute = F.date_trunc("minute", F.col("timestamp").cast("timestamp"))
    return _counts_by_time(df, MINUTE, minute)


def margins(df: DataFrame) -> DataFrame:
    """Margins of processed transactions over each text dimension and each minute."""
    return text_margins(df).unionByName(minute_margins(df))


def tail(df: DataFrame, bound: Column) -> DataFrame:
    """Rows per distinct event time from ``bound`` on, in margin columns."""
    late = df.where(F.col("timestamp") >= bound)
    return _counts_by_time(late, TAIL, F.col("timestamp").cast("timestamp"))


def tail_bound(df: DataFrame, before: DataFrame | None, span: str) -> Column:
    """The start of the last ``span`` of ``df`` and earlier input, as a scalar subquery."""
    latest = df.select(F.max("timestamp").alias("time"))
    if before is not None:
        earlier = before.where(F.col("dimension") == TAIL).select("time")
        latest = latest.unionByName(earlier)
    # In the type of the column, so that the comparison reaches the scan.
    kind = df.schema["timestamp"].dataType
    return latest.select((F.max("time") - as_interval(span)).cast(kind)).scalar()


def state_of(
    df: DataFrame,
    before: DataFrame | None = None,
    bound: Column | None = None,
    span: str = "1 minute",
) -> DataFrame:
    """Everything the metrics of ``df`` follow from, in margin columns.

    With ``before``, the state of earlier input, both together. Counts and
    amounts add up. The last-minute count does not, so the state keeps the rows
    per event time of the last ``span``, its tail: messages carry whole
    seconds, so a minute has at most 61 of them, and later input only moves
    its ``bound`` forward. A caller who knows that bound saves looking for it.
    """
    if bound is None:
        bound = tail_bound(df, before, span)
    state = margins(df).unionByName(tail(df, bound))
    if before is None:
        return state
    kept = before.where((F.col("dimension") != TAIL) | (F.col("time") >= bound))
    return (
        kept.select(*MARGIN_COLUMNS)
        .unionByName(state)
        .groupBy("dimension", "key", "time")
        .agg(
            F.sum("order_count").alias("order_count"),
            F.sum("amount").cast(UNITS_TYPE).alias("amount"),
            F.sum("outsize").alias("outsize"),
        )
    )


def _entry(
    metric: str,
    key: str = "NULL",
    start: str = "NULL",
    end: str = "NULL",
    order_count: str = "NULL",
    revenue: str = "NULL",
) -> str:
    """SQL for what one state row adds to one metric."""
    return (
        f"struct('{metric}' AS metric, CAST({key} AS STRING) AS key, "
        f"CAST({start} AS TIMESTAMP) AS window_start, CAST({end} AS TIMESTAMP) AS window_end, "
        f"CAST({order_count} AS BIGINT) AS order_count, CAST({revenue} AS DOUBLE) AS revenue)"
    )


def _if_status(status: str, value: str) -> str:
    return f"IF(key = '{status}', {value}, NULL)"


# The entries of a state row, by its dimension.
_ENTRIES = {
    "category": [_entry("revenue_by_category", key="key", revenue="total")],
    "city": [_entry("orders_by_city", key="key", order_count="order_count")],
    "payment_method": [
        _entry("payment_method_distribution", key="key", order_count="order_count")
    ],
    "order_status": [
        _entry("order_status_distribution", key="key", order_count="order_count"),
        _entry("total_orders", order_count="order_count"),
        _entry("completed_orders", order_count=_if_status(COMPLETED, "order_count")),
        _entry("returned_orders", order_count=_if_status(RETURNED, "order_count")),
        _entry("completed_revenue", revenue=_if_status(COMPLETED, "total")),
    ],
    TAIL: [_entry("orders_in_last_minute", order_count="order_count")],
}

# One zero per scalar metric, so that an empty input has them all.
_ZEROS = [
    _entry(metric, revenue="0") if metric in REVENUE_METRICS else _entry(metric, order_count="0")
    for metric in SCALAR_METRICS
]


def _keyed_and_scalar_rows(state: DataFrame) -> DataFrame:
    """Metrics of the state rows that are not minutes; each status row adds to several."""
    cases = " ".join(
        f"WHEN '{dimension}' THEN array({', '.join(entries)})"
        for dimension, entries in _ENTRIES.items()
    )
    zeros = state.sparkSession.range(1).selectExpr(f"inline(array({', '.join(_ZEROS)}))")
    return (
        state.withColumn("total", as_revenue(F.col("amount"), F.col("outsize")))
        .selectExpr(f"inline(CASE dimension {cases} END)")
        .unionByName(zeros)
        .groupBy("metric", "key", "window_start", "window_end")
        .agg(
            F.sum("order_count").alias("order_count"),
            F.round(F.sum("revenue"), 2).alias("revenue"),
        )
    )


def _window_rows(minutes: DataFrame) -> DataFrame:
    """Minute rows, all with a time, as windows, one each and without a shuffle."""
    return minutes.selectExpr(
        f"'{WINDOWED_METRIC}' AS metric",
        "CAST(NULL AS STRING) AS key",
        "time AS window_start",
        "time + INTERVAL '1' MINUTE AS window_end",
        "order_count",
        "CAST(NULL AS DOUBLE) AS revenue",
    )


def snapshot_rows(state: DataFrame) -> DataFrame:
    """All metrics of a stored state in one long frame, amounts rounded.

    Scalars have neither key nor window; windows have no key. A metric fills
    either ``order_count`` or ``revenue``.
    """
    minute = F.col("dimension") == MINUTE
    others = _keyed_and_scalar_rows(state.where(~minute))
    minutes = state.where(minute & F.col("time").isNotNull())
    return others.unionByName(_window_rows(minutes)).select(*SNAPSHOT_COLUMNS)


def metrics_snapshot(df: DataFrame, span: str = "1 minute") -> DataFrame:
    """All metrics of processed transactions in one long frame and one plan.

    Reads the text columns and the event time of ``df`` once each, and of the
    last ``span`` the time again: the minutes carry their latest time, from
    which its bound follows, and Spark computes them once for both uses. A frame
    that is not stored by column, such as parsed text or a join, should go
    through ``session.staged`` first.
    """
    validate_columns(df, METRIC_COLUMNS)
    minute = F.date_trunc("minute", F.col("timestamp").cast("timestamp"))
    minutes = df.groupBy(minute.alias("time")).agg(
        F.count("*").alias("order_count"), F.max("timestamp").alias("latest")
    )
    # Both uses need both figures, so that neither is pruned and the plans are equal.
    minutes = minutes.where("latest IS NOT NULL AND order_count > 0")
    kind = df.schema["timestamp"].dataType
    bound = minutes.select((F.max("latest") - as_interval(span)).cast(kind)).scalar()
    small = text_margins(df).unionByName(tail(df, bound))
    rows = _keyed_and_scalar_rows(small).unionByName(_window_rows(minutes))
    return rows.select(*SNAPSHOT_COLUMNS)


class MetricSet(dict):
    """Metric frames by name over one small cached snapshot.

    Use as a context manager, or call ``release``, to drop the cache and the
    staged copy. The frames are of no use after that.
    """

    def __init__(self, snapshot: DataFrame, staged_at: str | None = None):
        self._snapshot = snapshot.persist()
        self._staged_at = staged_at
        super().__init__(metric_frames(self._snapshot))

    def release(self) -> None:
        self._snapshot.unpersist()
        if self._staged_at:
            delete_path(self._snapshot.sparkSession, self._staged_at)

    def __enter__(self) -> MetricSet:
        return self

    def __exit__(self, *_: object) -> None:
        self.release()


def metric_frames(snapshot: DataFrame) -> dict[str, DataFrame]:
    """The long frame cut into one frame per metric, unsorted."""

    def rows(metric: str) -> DataFrame:
        return snapshot.where(F.col("metric") == metric)

    frames = {}
    for metric in SCALAR_METRICS:
        measure = "revenue" if metric in REVENUE_METRICS else "order_count"
        frames[metric] = rows(metric).select(F.col(measure).alias(metric))
    for metric, column in KEYED_METRICS.items():
        measure = "revenue" if metric in REVENUE_METRICS else "order_count"
        frames[metric] = rows(metric).select(F.col("key").alias(column), measure)
    frames[WINDOWED_METRIC] = rows(WINDOWED_METRIC).select(
        "window_start", "window_end", "order_count"
    )
    return frames


def all_metrics(df: DataFrame, stage: bool = False) -> MetricSet:
    """All metrics of processed transactions, each as a small frame.

    With ``stage`` the columns needed are first written to the shared folder:
    for parsed text or joins, which would otherwise run once per column group.
    """
    validate_columns(df)
    if not stage:
        return MetricSet(metrics_snapshot(df))
    path = new_folder(df.sparkSession, "metrics")
    columns = df.select(*METRIC_COLUMNS)
    columns.write.parquet(path)
    rows = df.sparkSession.read.schema(columns.schema).parquet(path)
    return MetricSet(metrics_snapshot(rows), path)
