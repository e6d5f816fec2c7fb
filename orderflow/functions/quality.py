"""Row rules: which transactions count, and why the others do not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.schema import RAW_SCHEMA

# The sensible range of a discount, in percent.
DISCOUNT_RANGE = (0, 100)

MALFORMED = "malformed_message"
# A record its reader could not make out, though its fields break no other rule:
# too few or too many of them, or text that is left over.
CORRUPT = "corrupt_record"


def _number(column: str) -> str:
    """SQL test for a finite number; Spark holds NaN to be above infinity."""
    return f"coalesce(abs({column}) < double('infinity'), false)"


# Reason code of each rule and the SQL condition under which a row breaks it.
# The conditions are never null.
RULES = {
    "missing_order_id": "coalesce(trim(order_id), '') = ''",
    "bad_timestamp": "timestamp IS NULL",
    "bad_quantity": "quantity IS NULL",
    "negative_quantity": "coalesce(quantity < 0, false)",
    "bad_unit_price": f"NOT {_number('unit_price')}",
    "negative_unit_price": f"{_number('unit_price')} AND unit_price < 0",
    "bad_discount": f"NOT {_number('discount_percent')}",
    "discount_out_of_range": (
        f"{_number('discount_percent')} AND discount_percent "
        f"NOT BETWEEN {DISCOUNT_RANGE[0]} AND {DISCOUNT_RANGE[1]}"
    ),
}


def _rules(columns: Sequence[str]) -> dict[str, str]:
    """The rules for a frame with these columns; records from files tell if they are corrupt."""
    if "corrupt" not in columns:
        return RULES
    others = " OR ".join(f"({rule})" for rule in RULES.values())
    return {**RULES, CORRUPT: f"coalesce(corrupt, false) AND NOT ({others})"}


def is_valid(columns: Sequence[str] = ()) -> Column:
    """Whether a processed row of a frame with ``columns`` breaks no rule; never null."""
    return F.expr(f"NOT ({' OR '.join(f'({rule})' for rule in _rules(columns).values())})")


def reasons(columns: Sequence[str] = ()) -> Column:
    """Codes of the rules a processed row breaks, as an array.

    A row without a single field came from a message that could not be read
    at all; it gets that one reason instead of one per field.
    """
    fields = ", ".join(f"CAST({name} AS STRING)" for name in RAW_SCHEMA.names)
    codes = ", ".join(f"IF({rule}, '{code}', NULL)" for code, rule in _rules(columns).items())
    return F.expr(
        f"IF(coalesce({fields}) IS NULL, array('{MALFORMED}'), split(concat_ws(',', {codes}), ','))"
    )


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows as they are, and the refused rows with their ``reasons``.

    Two frames over one source: whoever uses both reads it twice. Where that
    is dear, as with parsed text, stage the source first, or use
    ``streaming.store.judged``, which marks the rows in one pass.
    """
    accepted = is_valid(df.columns)
    return df.where(accepted), df.where(~accepted).withColumn("reasons", reasons(df.columns))
