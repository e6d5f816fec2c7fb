"""Record starts of CSV files with line breaks in quotes, found block by block."""

from __future__ import annotations

import csv
import io
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import order
from orderflow.schema import RAW_SCHEMA
from orderflow.sources.files import read_csv_records, read_transactions_files
from orderflow.sources.records import csv_lines_of_records, line_ends


@pytest.fixture
def small_blocks(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def parsed(text, **how):
    return list(csv.reader(io.StringIO(text, newline=""), **how))


def found(spark, folder, **how):
    rows = csv_lines_of_records(spark, str(folder), **how).rows
    return rows.orderBy("file", "start", "record").collect()


@given(st.lists(st.text(alphabet='ab",\n', max_size=12), min_size=1, max_size=8))
@settings(max_examples=300, deadline=None)
def test_lines_end_as_the_standard_parser_says(fields):
    buffer = io.StringIO(newline="")
    csv.writer(buffer, lineterminator="\n").writerow(fields)
    outside, within = line_ends()
    inside = False
    lines = buffer.getvalue().split("\n")[:-1]
    for number, line in enumerate(lines, 1):
        inside = (within if inside else outside).fullmatch(line) is None
        assert inside == (number < len(lines))


@pytest.mark.parametrize("text, inside", [('5" pipe,a', False), ('a,"b', True), ('"a"b"c,d', False), ('"a""', True), ('""', False)])
def test_only_a_field_s_first_character_opens_quotes(text, inside):
    assert (line_ends()[0].fullmatch(text) is None) == inside


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_in_eight_blocks(spark, tmp_path, small_blocks, end):
    draw = random.Random(len(end))
    buffer = io.StringIO(newline="")
    writer = csv.writer(buffer, lineterminator=end)
    writer.writerow(["number", "two\nlines", "text"])
    for i in range(1200):
        odd = "".join(draw.choice('ab,"\n \r') for _ in range(draw.randint(0, 50)))
        writer.writerow([i, odd, draw.choice(["x", "longer text " * 4, "\n" * 9])])
    # One record is longer than two blocks.
    writer.writerow(["big", "line\n" * 6000, "x"])
    writer.writerow(["last", "", "x"])
    (tmp_path / "orders.csv").write_bytes(buffer.getvalue().encode())
    small_blocks(len(buffer.getvalue()) // 8 + 1)
    rows = found(spark, tmp_path)
    assert [parsed(r.value)[0] for r in rows] == parsed(buffer.getvalue())[1:]
    assert len({r.start for r in rows}) > 4
    records = read_csv_records(spark, str(tmp_path), quoted_lines=True)
    assert records.columns == ["number", "two\nlines", "text", "_corrupt_record"]
    assert records.rdd.getNumPartitions() > 4
    want = {tuple(v or None for v in row) for row in parsed(buffer.getvalue())[1:]}
    assert {tuple(r)[:3] for r in records.collect()} == want


def test_files_of_different_headers_with_line_breaks(spark, tmp_path):
    names = RAW_SCHEMA.names
    first, second = order("O1", product="Pen\n\"blue\""), order("O2", product="Ink")
    for name, header, row in (("a", names, first), ("b", names[::-1], second[::-1]), ("c", [], None)):
        with open(tmp_path / f"{name}.csv", "w", newline="") as file:
            if row:
                csv.writer(file).writerows([header, row])
    rows = read_transactions_files(spark, str(tmp_path), quoted_lines=True)
    assert {tuple(r)[:12] for r in rows.collect()} == {first, second}
    assert rows.where("corrupt").count() == 0
    with pytest.raises(ValueError, match="other headers"):
        read_transactions_files(spark, str(tmp_path), quoted_lines=True, header=names)


def test_rows_of_the_wrong_length_and_wrong_numbers(spark, tmp_path):
    header = ",".join(RAW_SCHEMA.names)
    good = ",".join(map(str, order("O1")))
    bad = ",".join(map(str, order("O2"))).replace(",1,", ",two,")
    (tmp_path / "f.csv").write_text(f'﻿{header}\n{good}\n\n  \nO3,"a\nb"\n{bad}\n{good}," more\n')
    rows = read_transactions_files(spark, str(tmp_path), quoted_lines=True)
    texts = {r.message for r in rows.where("corrupt").collect()}
    assert texts == {'O3,"a\nb"', bad, f'{good}," more'}
    assert [tuple(r)[:12] for r in rows.where("not corrupt").collect()] == [order("O1")]


def test_other_separators_empty_files_and_open_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;'x;\ny'\n2;'never\nclosed\n")
    (tmp_path / "b.csv").write_text("")
    rows = found(spark, tmp_path, sep=";", quote="'")
    assert [r.value for r in rows] == ["1;'x;\ny'", "2;'never\nclosed"]
    assert {r.header for r in rows} == {"a;b"}
