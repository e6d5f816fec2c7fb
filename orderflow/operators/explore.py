"""Looking at single transactions: filters, facets, the latest ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions.display import DISPLAY_SOURCES, MISSING_TEXT, to_display

ALL = "All"


def _source_columns(df: DataFrame, shown: str) -> list[Column]:
    """The columns of ``df`` behind a display column, display frames included."""
    names = [name for name in [shown, *DISPLAY_SOURCES[shown]] if name in df.columns]
    return [F.col(f"`{name}`") for name in names]


def _equals(df: DataFrame, shown: str, wanted: str) -> Column:
    columns = _source_columns(df, shown)
    if not columns:
        return F.lit(wanted == MISSING_TEXT)
    # One source is compared as it is, so that the comparison reaches the scan;
    # of several the first that is filled counts, as it does on display.
    value = columns[0] if len(columns) == 1 else F.coalesce(*[c.cast("string") for c in columns])
    if wanted == MISSING_TEXT:
        return value.isNull() | (value == wanted)
    return value == wanted


def _matches(df: DataFrame, shown: str, term: str, regex: bool) -> Column:
    columns = _source_columns(df, shown)
    if not columns:
        return F.lit(False)
    text = F.lower(F.coalesce(*[column.cast("string") for column in columns]))
    return text.rlike(term) if regex else F.contains(text, F.lit(term))


def filter_transactions(
    df: DataFrame,
    status: str | None = None,
    city: str | None = None,
    search: str | None = None,
    regex: bool = False,
) -> DataFrame:
    """Transactions with this status and city whose order id or product contains a term.

    ``None`` and ``"All"`` do not restrict. The term ignores case and outer
    white space; it is plain text unless ``regex`` is set. Takes processed
    transactions and display frames alike.
    """
    chosen = df
    if status not in (None, ALL):
        chosen = chosen.where(_equals(df, "Status", status))
    if city not in (None, ALL):
        chosen = chosen.where(_equals(df, "City", city))
    term = (search or "").strip().lower()
    if term:
        chosen = chosen.where(
            _matches(df, "Order ID", term, regex) | _matches(df, "Product", term, regex)
        )
    return chosen


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """The sorted distinct values of a column, as offered for filtering."""
    value = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(MISSING_TEXT))
    return df.select(value.alias("value")).distinct().orderBy("value")


def latest(df: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` transactions, newest first.

    Arrival is known by batch; within one, event time and order id decide. The
    n-th largest value of the leading column, found from that column alone,
    bounds what is read in full; it reaches the scan as a filter. The top list
    is then kept per task, nothing is sorted as a whole.
    """
    order = [name for name in ("batch_id", "timestamp", "order_id") if name in df.columns]
    lead = F.col(order[0])
    largest = df.select(lead).where(lead.isNotNull()).orderBy(lead.desc()).limit(n)
    bound = largest.select(F.min(lead)).scalar()
    # Rows without the leading value come last, but they may be needed.
    candidates = df.where((lead >= bound) | lead.isNull())
    return candidates.orderBy(*[F.col(name).desc_nulls_last() for name in order]).limit(n)


def recent_transactions(df: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` transactions in display columns, newest first."""
    return to_display(latest(df, n))
