from __future__ import annotations

import json

import pytest
from conftest import order

from orderflow.functions.parse import parse_transactions, process
from orderflow.functions.quality import split_valid
from orderflow.operators import metrics
from orderflow.schema import PROCESSED_SCHEMA, RAW_SCHEMA

GOOD = dict(zip(RAW_SCHEMA.names, order()))


def message(**changes):
    fields = {**GOOD, **changes}
    return json.dumps({name: value for name, value in fields.items() if value is not ...})


def messages(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def reasons_of(spark, *texts):
    _, refused = split_valid(process(messages(spark, *texts)))
    return [row.reasons for row in refused.collect()]


def test_parse_gives_the_raw_schema(spark):
    parsed = parse_transactions(messages(spark, message()))
    assert parsed.schema == RAW_SCHEMA
    assert tuple(parsed.first()) == order()


def test_binary_values_unknown_keys_and_number_ids(spark):
    text = json.dumps({**GOOD, "order_id": 17, "unit_price": 3, "other": [1]})
    binary = spark.createDataFrame([(bytearray(text.encode()),)], "value binary")
    row = parse_transactions(binary).first()
    assert (row.order_id, row.unit_price) == ("17", 3.0)


@pytest.mark.parametrize("text", ["not json", None, "[1, 2]", "", "{ broken"])
def test_unreadable_message_is_one_row_of_nulls(spark, text):
    rows = parse_transactions(messages(spark, text)).collect()
    assert [tuple(row) for row in rows] == [(None,) * 12]
    assert reasons_of(spark, text) == [["malformed_message"]]


@pytest.mark.parametrize(
    "changes, codes",
    [
        ({"quantity": "2"}, ["bad_quantity"]),
        ({"quantity": 2.0}, ["bad_quantity"]),
        ({"quantity": 2.5}, ["bad_quantity"]),
        ({"quantity": "abc"}, ["bad_quantity"]),
        ({"quantity": ...}, ["bad_quantity"]),
        ({"quantity": -1}, ["negative_quantity"]),
        ({"unit_price": "5.0"}, ["bad_unit_price"]),
        ({"unit_price": float("nan")}, ["bad_unit_price"]),
        ({"unit_price": float("inf")}, ["bad_unit_price"]),
        ({"unit_price": -0.01}, ["negative_unit_price"]),
        ({"discount_percent": None}, ["bad_discount"]),
        ({"discount_percent": -1}, ["discount_out_of_range"]),
        ({"discount_percent": 100.5}, ["discount_out_of_range"]),
        ({"timestamp": "x"}, ["bad_timestamp"]),
        ({"timestamp": "2026-09-21T10:00:13"}, ["bad_timestamp"]),
        ({"timestamp": "2026-09-21 10:00:13.5"}, ["bad_timestamp"]),
        ({"timestamp": ...}, ["bad_timestamp"]),
        ({"order_id": ""}, ["missing_order_id"]),
        ({"order_id": "  "}, ["missing_order_id"]),
        ({"order_id": None, "quantity": -1}, ["missing_order_id", "negative_quantity"]),
    ],
)
def test_refused_rows_say_why(spark, changes, codes):
    assert reasons_of(spark, message(**changes)) == [codes]


@pytest.mark.parametrize(
    "changes",
    [{}, {"quantity": 0}, {"discount_percent": 0}, {"discount_percent": 100}, {"city": None},
     {"order_status": "Pending"}, {"order_id": 5}],
)
def test_accepted_rows(spark, changes):
    valid, refused = split_valid(process(messages(spark, message(**changes))))
    assert valid.count() == 1 and refused.count() == 0


def test_split_keeps_every_row_and_the_text(spark):
    texts = [message(), "junk", message(quantity=-1), None]
    valid, refused = split_valid(process(messages(spark, *texts)))
    assert valid.columns == [*PROCESSED_SCHEMA.names, "message"]
    assert valid.count() == 1
    assert {row.message for row in refused.collect()} == {"junk", message(quantity=-1), None}


def test_counts_see_valid_rows_only(spark):
    processed = process(messages(spark, message(), "junk"))
    valid, _ = split_valid(processed)
    assert metrics.total_orders(valid).first()[0] == 1
    assert metrics.total_orders(processed).first()[0] == 2
