"""Counts over event time."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Microseconds per unit of a duration text such as "10 minutes".
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}
#: Up to so many windows per count, copying counts costs less than running sums.
MOST_COPIES = 64
_PART = re.compile(r"([+-]?\d+(?:\.\d+)?)\s+([a-z]+?)s?(?:\s+|$)")


def duration_micros(duration: str) -> int:
    """Microseconds of a duration text: units from microseconds to weeks, as often as wanted.

    The texts that Spark's ``window`` takes, such as ``1 hour 30 minutes``.
    """
    text = re.sub(r"^\s*interval\s+", "", duration.lower()).strip()
    total, at = 0, 0
    for part in _PART.finditer(text):
        if part.start() != at or part[2] not in UNIT_MICROS or "." in part[1] and part[2] != "second":
            break
        total += round(float(part[1]) * 1_000_000) if "." in part[1] else int(part[1]) * UNIT_MICROS[part[2]]
        at = part.end()
    if not text or at != len(text) or total <= 0:
        raise ValueError(f"not a duration: {duration!r}")
    return total


def as_interval(duration: str) -> Column:
    """A duration text as an interval to add to or take from a time."""
    seconds, micros = divmod(duration_micros(duration), 1_000_000)
    return F.expr(f"INTERVAL '{seconds}.{micros:06d}' SECOND")


def _bounds(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "order_count",
    )


def windowed_orders(
    df: DataFrame, duration: str = "1 minute", slide: str | None = None
) -> DataFrame:
    """Order lines per time window ``[start, end)``; windows without any are absent.

    With ``slide`` the windows overlap. Batch input is then counted without
    copying rows into windows, see ``_copied`` and ``_sliding``: which of the two
    follows from the durations alone. A stream keeps a count per open window.
    """
    width = duration_micros(duration)
    step = width if slide is None else duration_micros(slide)
    if step > width:
        raise ValueError("windows that slide by more than their width leave rows out")
    times = df.select("timestamp")
    if slide is not None and step < width and not df.isStreaming:
        return (_copied if width <= MOST_COPIES * step else _sliding)(times, width, step)
    micros = [f"{n} microseconds" for n in (width, step)]
    counted = times.groupBy(F.window("timestamp", *micros)).agg(F.count("*").alias("order_count"))
    return _bounds(counted)


def _counts(times: DataFrame, width: int, step: int) -> DataFrame:
    """Rows per common divisor of window and slide: within one, all rows are in the same windows."""
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    grain = F.lit(math.gcd(width, step))
    return (
        times.where(F.col("timestamp").isNotNull())
        .groupBy((micros - F.pmod(micros, grain)).alias("at"))
        .agg(F.count("*").alias("n"))
    )


def _first_start_behind(time: Column, step: int) -> Column:
    return time - F.pmod(time, F.lit(step)) + F.lit(step)


def _from_starts(windows: DataFrame, width: int, kind: DataType) -> DataFrame:
    return windows.select(
        F.timestamp_micros("start").cast(kind).alias("window_start"),
        F.timestamp_micros(F.col("start") + F.lit(width)).cast(kind).alias("window_end"),
        F.col("order_count").cast("bigint").alias("order_count"),
    )


def _copied(times: DataFrame, width: int, step: int) -> DataFrame:
    """Counts of overlapping windows: each count is copied into the few windows it is in."""
    first = _first_start_behind(F.col("at") - F.lit(width), step)
    last = F.col("at") - F.pmod(F.col("at"), F.lit(step))
    copies = _counts(times, width, step).select(F.explode(F.sequence(first, last, F.lit(step))).alias("start"), "n")
    windows = copies.groupBy("start").agg(F.sum("n").alias("order_count"))
    return _from_starts(windows, width, times.schema["timestamp"].dataType)


def _sliding(times: DataFrame, width: int, step: int) -> DataFrame:
    """Counts of overlapping windows, of ``width`` and a start every ``step`` microseconds.

    Rows are counted per common divisor of the two. A count then raises the
    number of rows in a window from the first start whose window reaches it,
    and lowers it again at the first start behind it; between two such points
    all windows hold the same. So a count is touched twice however many windows
    it is in, and only the windows of the result are made. Running sums go day
    by day, on top of the sums of the days before.
    """
    day = UNIT_MICROS["day"]
    changes = F.array(
        F.struct(_first_start_behind(F.col("at") - F.lit(width), step).alias("start"), F.col("n").alias("change")),
        F.struct(_first_start_behind(F.col("at"), step).alias("start"), (-F.col("n")).alias("change")),
    )
    points = (
        _counts(times, width, step).select(F.inline(changes))
        .groupBy("start")
        .agg(F.sum("change").alias("change"))
        .withColumn("day", F.floor(F.col("start") / F.lit(float(day))))
    )
    # One row per day, few enough to be put in order together.
    in_order = Window.orderBy("day")
    days = points.groupBy("day").agg(F.sum("change").alias("sum"), F.min("start").alias("first"))
    days = days.select(
        "day",
        F.coalesce(F.sum("sum").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.lead("first").over(in_order).alias("next_day"),
    )
    within = Window.partitionBy("day").orderBy("start")
    held = points.join(days, "day").select(
        "start",
        (F.col("before") + F.sum("change").over(within)).alias("order_count"),
        F.coalesce(F.lead("start").over(within), F.col("next_day")).alias("until"),
    )
    starts = F.sequence(F.col("start"), F.col("until") - F.lit(step), F.lit(step))
    windows = held.where("order_count > 0").select(F.explode(starts).alias("start"), "order_count")
    return _from_starts(windows, width, times.schema["timestamp"].dataType)


def last_span(df: DataFrame, span: str = "1 minute") -> DataFrame:
    """The rows at most ``span`` older than the latest event time, that bound included.

    The bound is a scalar subquery, so it reaches the file scan as a pushed
    filter and skips row groups by their time statistics.
    """
    bound = df.select(F.max("timestamp") - as_interval(span)).scalar()
    return df.where(F.col("timestamp") >= bound)


def orders_in_last_minute(df: DataFrame, span: str = "1 minute") -> DataFrame:
    """Order lines in the last ``span`` of event time; 0 if there is no event time.

    For batch input. A stream has no latest time yet: count its windows, or
    read the snapshot of the stored stream.
    """
    if df.isStreaming:
        raise ValueError("the last span of a stream is open; use streaming_windowed_orders")
    return last_span(df, span).agg(F.count("*").alias("orders_in_last_minute"))
