"""Order metrics. Each takes processed transactions, batch or stream, and is lazy.

None of them sorts, so that all of them run on streams; see ``ranked``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.schema import COMPLETED, RETURNED


#: Amounts are added as whole numbers of billionths, in which no order of adding matters.
UNITS = 1e9
#: The type of a sum of them.
UNITS_TYPE = "decimal(38,0)"
#: Amounts from here on, and those that are no number, are added as doubles.
OUTSIZE = 9e9
# A number of units is added in three parts of so many bits, so that four trillion
# rows fit a long each; sums of decimals take twice the time of all other work.
_PART_BITS = 21
_LOW = (1 << _PART_BITS) - 1


def units(amount: Column) -> Column:
    """An amount in billionths, null from ``OUTSIZE`` on."""
    return F.when(F.abs(amount) < OUTSIZE, F.rint(amount * UNITS).cast("bigint"))


def outsize(amount: Column) -> Column:
    """An amount that ``units`` leaves out: too large, infinite or not a number."""
    return F.when(F.abs(amount) >= OUTSIZE, amount)


def sum_units(count: Column) -> Column:
    """The exact sum of numbers of units."""
    high = F.shiftright(count, 2 * _PART_BITS)
    middle = F.shiftright(count, _PART_BITS).bitwiseAND(_LOW)
    sums = [F.sum(part).cast(UNITS_TYPE) for part in (high, middle, count.bitwiseAND(_LOW))]
    base = F.lit(1 << _PART_BITS).cast("decimal(8,0)")
    return ((sums[0] * base + sums[1]).cast(UNITS_TYPE) * base + sums[2]).cast(UNITS_TYPE)


def as_revenue(exact: Column, rest: Column) -> Column:
    """Sums of units and of outsize amounts together; null if both are."""
    exact = exact.cast("double") / UNITS
    return F.coalesce(exact + rest, exact, rest)


def revenue(amount: Column) -> Column:
    """The sum of amounts, the same in any order of rows, rounded to cents."""
    return F.round(as_revenue(sum_units(units(amount)), F.sum(outsize(amount))), 2)


def _orders_with_status(status: str) -> Column:
    return F.count_if(F.col("order_status") == status)


def _revenue_of_completed() -> Column:
    amount = F.when(F.col("order_status") == COMPLETED, F.col("total_amount"))
    return F.coalesce(revenue(amount), F.lit(0.0))


# The scalar metrics, by name.
SCALARS: dict[str, Callable[[], Column]] = {
    "total_orders": lambda: F.count("*"),
    "completed_orders": lambda: _orders_with_status(COMPLETED),
    "returned_orders": lambda: _orders_with_status(RETURNED),
    "completed_revenue": _revenue_of_completed,
}


def _scalars(df: DataFrame, *names: str) -> DataFrame:
    return df.agg(*[SCALARS[name]().alias(name) for name in names])


def total_orders(df: DataFrame) -> DataFrame:
    """Number of order lines; a repeated order id counts again."""
    return _scalars(df, "total_orders")


def completed_orders(df: DataFrame) -> DataFrame:
    """Number of order lines whose status is exactly ``Completed``."""
    return _scalars(df, "completed_orders")


def returned_orders(df: DataFrame) -> DataFrame:
    """Number of order lines whose status is exactly ``Returned``."""
    return _scalars(df, "returned_orders")


def completed_revenue(df: DataFrame) -> DataFrame:
    """Amount of all completed order lines, 0.0 if there are none."""
    return _scalars(df, "completed_revenue")


def kpis(df: DataFrame) -> DataFrame:
    """The four scalar metrics in one row and one pass."""
    return _scalars(df, *SCALARS)


def revenue_by_category(df: DataFrame) -> DataFrame:
    """Amount per category over order lines of every status."""
    return df.groupBy("category").agg(revenue(F.col("total_amount")).alias("revenue"))


def _orders_per(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("order_count"))


def orders_by_city(df: DataFrame) -> DataFrame:
    """Order lines per city."""
    return _orders_per(df, "city")


def payment_method_distribution(df: DataFrame) -> DataFrame:
    """Order lines per payment method."""
    return _orders_per(df, "payment_method")


def order_status_distribution(df: DataFrame) -> DataFrame:
    """Order lines per status."""
    return _orders_per(df, "order_status")


# Every metric that also runs on a stream, by name.
METRICS: dict[str, Callable[[DataFrame], DataFrame]] = {
    metric.__name__: metric
    for metric in (
        total_orders,
        completed_orders,
        returned_orders,
        completed_revenue,
        kpis,
        revenue_by_category,
        orders_by_city,
        payment_method_distribution,
        order_status_distribution,
    )
}


def status_ratios(kpi_row: DataFrame) -> DataFrame:
    """Completed and returned share of all orders, in percent with one decimal."""

    def percent(name: str) -> Column:
        share = F.lit(100.0) * F.col(name) / F.nullif(F.col("total_orders"), F.lit(0))
        return F.coalesce(F.round(share, 1), F.lit(0.0))

    return kpi_row.select(
        "total_orders",
        "completed_orders",
        "returned_orders",
        percent("completed_orders").alias("completed_percent"),
        percent("returned_orders").alias("returned_percent"),
    )


def ranked(metric: DataFrame, by: str, *ties: str) -> DataFrame:
    """A metric in descending order of ``by``; ties in order of the other columns."""
    keys = ties or [name for name in metric.columns if name != by]
    return metric.orderBy(F.col(by).desc(), *[F.col(key).asc() for key in keys])
