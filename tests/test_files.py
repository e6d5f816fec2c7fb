from __future__ import annotations

import json

import pytest
from conftest import SIX_ORDERS, order
from pyspark.errors import AnalysisException, StreamingQueryException

from orderflow.catalog import raw_records
from orderflow.functions.parse import process, process_records
from orderflow.functions.quality import split_valid
from orderflow.operators import metrics
from orderflow.schema import PROCESSED_SCHEMA, RAW_SCHEMA
from orderflow.sources.files import read_csv_records, read_transactions_files, recent_from_file
from orderflow.sources.kafka import kafka_options, read_transactions_kafka
from orderflow.sources.publish import publish_transactions, record_messages, to_messages
from orderflow.streaming.store import judged

HEADER = ",".join(RAW_SCHEMA.names)
LINE = "O1,2026-09-21 10:00:00,C1,P1,Pen,Books,1,10,0,Salem,UPI,Completed"


def csv(tmp_path, *lines, header=HEADER):
    path = tmp_path / "orders.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_SCHEMA)


def test_csv(spark, tmp_path):
    rows = read_transactions_files(spark, csv(tmp_path, LINE))
    assert rows.columns == [*RAW_SCHEMA.names, "message", "corrupt"]
    assert tuple(rows.first()) == (*order(), None, False)
    assert process_records(rows).select(*PROCESSED_SCHEMA.names).first().total_amount == 10.0


def test_csv_quotes(spark, tmp_path):
    quoted = LINE.replace("Pen", '"Pen, ""blue"""')
    assert read_transactions_files(spark, csv(tmp_path, quoted)).first().product_name == 'Pen, "blue"'


def test_csv_goes_by_header_names(spark, tmp_path):
    path = csv(tmp_path, "5,2.5,O9,note", header="quantity,unit_price,order_id,remark")
    row = read_transactions_files(spark, path).first()
    assert (row.quantity, row.unit_price, row.order_id, row.city) == (5, 2.5, "O9", None)


def test_csv_bad_and_empty_numbers(spark, tmp_path):
    bad, empty = LINE.replace(",1,10,", ",x,10,"), LINE.replace(",1,10,", ",,10,")
    rows = read_transactions_files(spark, csv(tmp_path, LINE, bad, empty)).collect()
    assert [(r.quantity, r.message) for r in rows] == [(1, None), (None, bad), (None, None)]
    valid, refused = split_valid(process_records(read_transactions_files(spark, csv(tmp_path, LINE, bad, empty))))
    assert valid.count() == 1
    assert [r.reasons for r in refused.collect()] == [["bad_quantity"]] * 2


def test_csv_rows_of_the_wrong_length_are_refused_with_their_text(spark, tmp_path):
    short, long = LINE.rpartition(",")[0], LINE + ",more"
    path = csv(tmp_path, LINE, short, long)
    rows = process_records(read_transactions_files(spark, path))
    valid, refused = split_valid(rows)
    assert valid.count() == 1
    assert {(r.message, tuple(r.reasons)) for r in refused.collect()} == {
        (short, ("corrupt_record",)),
        (long, ("corrupt_record",)),
    }
    kept = judged(rows).where("not accepted").select("message")
    assert {r.message for r in kept.collect()} == {short, long}


def test_csv_text_of_bad_rows_does_not_depend_on_the_columns_read(spark, tmp_path):
    bad = LINE.replace(",1,10,", ",x,10,")
    rows = read_transactions_files(spark, csv(tmp_path, LINE, bad))
    for columns in (["order_id", "message"], ["message"], ["message", "quantity"]):
        assert sorted(str(r.message) for r in rows.select(*columns).collect()) == sorted(["None", bad])
    assert rows.where("message is not null").count() == 1


def test_csv_quoted_line_breaks_and_empty_files(spark, tmp_path):
    path = csv(tmp_path, LINE.replace("Pen", '"Pen\nblue"'), LINE)
    whole = read_transactions_files(spark, path, quoted_lines=True)
    assert sorted(r.product_name for r in whole.collect()) == ["Pen", "Pen\nblue"]
    _, refused = split_valid(process_records(read_transactions_files(spark, path)))
    assert refused.count() == 2
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    nothing = read_transactions_files(spark, str(empty))
    assert nothing.columns == whole.columns and nothing.count() == 0
    assert nothing.select("message").count() == 0


def test_csv_stream_checks_its_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    csv(folder, LINE, LINE)
    stream = read_transactions_files(spark, str(folder), streaming=True)
    query = stream.writeStream.format("memory").queryName("csv_in").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("csv_in").count() == 2


def rows_streamed(spark, tmp_path, **reading):
    stream = read_transactions_files(spark, str(tmp_path / "in"), streaming=True, **reading)
    query = (
        stream.writeStream.format("parquet").trigger(availableNow=True)
        .options(path=str(tmp_path / "out"), checkpointLocation=str(tmp_path / "cp")).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).collect()


def test_csv_stream_with_another_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    header = ["quantity", "order_id", "remark"]
    csv(folder, "3,O7,x", header=",".join(header))
    rows = rows_streamed(spark, tmp_path, header=header)
    assert [(r.order_id, r.quantity, r.city) for r in rows] == [("O7", 3, None)]


def test_csv_stream_fails_on_an_unexpected_header(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    csv(folder, LINE, header=",".join(reversed(RAW_SCHEMA.names)))
    with pytest.raises(StreamingQueryException):
        rows_streamed(spark, tmp_path)


def test_json_lines_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    item = json.dumps(dict(zip(RAW_SCHEMA.names, order())))
    (folder / "a.json").write_text(f"{item}\nbroken\n")
    rows = rows_streamed(spark, tmp_path, fmt="ndjson")
    assert sorted((r.order_id or "", r.message) for r in rows) == [("", "broken"), ("O1", None)]


@pytest.mark.parametrize("wrap", [
    lambda items: items,
    lambda items: {"transactions": items},
    lambda items: {"recent_transactions": items},
    lambda items: {"transactions": [], "recent_transactions": items},
])
def test_json_layouts(spark, tmp_path, wrap):
    items = [dict(zip(RAW_SCHEMA.names, order(f"O{n}"))) for n in range(3)]
    path = tmp_path / "orders.json"
    path.write_text(json.dumps(wrap(items), indent=2))
    rows = read_transactions_files(spark, str(path), "json").drop("message", "corrupt").collect()
    assert [tuple(r) for r in rows] == [order(f"O{n}") for n in range(3)]


def test_json_single_object_and_lines(spark, tmp_path):
    item = json.dumps(dict(zip(RAW_SCHEMA.names, order())))
    single = tmp_path / "one.json"
    single.write_text(item)
    assert tuple(read_transactions_files(spark, str(single), "json").first()) == (*order(), None, False)
    lines = tmp_path / "lines.json"
    lines.write_text(f"{item}\nbroken\n{item}\n")
    rows = read_transactions_files(spark, str(lines), "ndjson").collect()
    assert [r.message for r in rows] == [None, "broken", None]
    with pytest.raises(ValueError):
        read_transactions_files(spark, str(lines), "xml")


def test_messages_have_all_fields_and_typed_numbers(spark):
    row = raw(spark, order(city=None, price=2199.0, quantity=2))
    sent = json.loads(to_messages(row).first().value)
    assert sent == {**dict(zip(RAW_SCHEMA.names, order(city=None, price=2199.0, quantity=2)))}
    assert type(sent["quantity"]) is int and list(sent) == RAW_SCHEMA.names


def test_published_messages_come_back(spark, six, tmp_path):
    publish_transactions(raw_records(six), "text", path=str(tmp_path / "out"))
    back = process(spark.read.text(str(tmp_path / "out")))
    assert metrics.kpis(back).first() == metrics.kpis(six).first()
    assert back.count() == len(SIX_ORDERS)


def test_publishing_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    csv(folder, LINE, LINE)
    stream = read_transactions_files(spark, str(folder), streaming=True)
    query = publish_transactions(stream, "text", checkpoint=str(tmp_path / "cp"), path=str(tmp_path / "out"))
    query.awaitTermination()
    assert process(spark.read.text(str(tmp_path / "out"))).count() == 2


def test_kafka_options(monkeypatch):
    assert kafka_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "shopping-transactions",
        "startingOffsets": "latest",
    }
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "b:1")
    monkeypatch.setenv("KAFKA_TOPIC", "t")
    options = kafka_options(starting="earliest", max_offsets_per_trigger=5, min_partitions=8)
    assert options == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5", "minPartitions": "8",
    }
    assert kafka_options("x:2", "u")["subscribe"] == "u"


def test_kafka_needs_its_connector(spark, six):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_transactions_kafka(spark)
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        publish_transactions(raw_records(six))


RECENT = [
    {"order_id": "A-03", "product_name": "Bread knife", "category": "Kitchen", "total_amount": 49.0,
     "city": "Ghent", "order_status": "Returned"},
    {"orderId": "A-05", "product": "Garden hose", "category": "Garden", "amount": "33.25",
     "city": "Porto", "status": "Completed"},
]
SHOWN = [
    ("A-05", "Garden hose", "Garden", 33.25, "Porto", "Completed"),
    ("A-03", "Bread knife", "Kitchen", 49.0, "Ghent", "Returned"),
]


@pytest.mark.parametrize("fmt, text", [
    ("json", json.dumps(RECENT)),
    ("json", json.dumps({"transactions": RECENT})),
    ("json", json.dumps({"transactions": [], "recent_transactions": RECENT})),
    ("ndjson", "\n".join(map(json.dumps, RECENT))),
])
def test_recent_list(spark, tmp_path, fmt, text):
    path = tmp_path / "recent.json"
    path.write_text(text)
    assert [tuple(r) for r in recent_from_file(spark, str(path), fmt).collect()] == SHOWN
    assert [tuple(r) for r in recent_from_file(spark, str(path), fmt, 1).collect()] == SHOWN[:1]


def test_recent_csv_single_and_missing(spark, tmp_path):
    rows = recent_from_file(spark, csv(tmp_path, LINE, LINE.replace("O1,", "O2,")), "csv").collect()
    assert [tuple(r)[:2] for r in rows] == [("O2", "Pen"), ("O1", "Pen")]
    assert rows[0].Amount == 10.0
    path = tmp_path / "one.json"
    path.write_text(json.dumps(RECENT[0]))
    assert [tuple(r) for r in recent_from_file(spark, str(path)).collect()] == SHOWN[1:]
    assert recent_from_file(spark, str(tmp_path / "none.json")).count() == 0


@pytest.mark.parametrize(
    "text, found",
    [
        ('{"order_id": "a"}\n{"order_id": "b"}\n', ["b", "a"]),
        ('{"order_id": "a"}\nbroken {\n\r\n{"order_id": "b"}', ["b", "a"]),
        ('[{"order_id": "a"}, {"order_id": "b"}]', ["b", "a"]),
        ('{"order_id": "a"}] {"order_id": "b"}', []),
        ('{"order_id": "a"}} {"order_id": "b"}', []),
        ("no json at all", []),
        ("", []),
    ],
)
def test_recent_rows_of_json_files_of_any_layout(spark, tmp_path, text, found):
    path = tmp_path / "recent.json"
    path.write_text(text)
    rows = recent_from_file(spark, str(path)).collect()
    assert [r["Order ID"] for r in rows] == found


def values_of(df):
    return [json.loads(r.value) if r.value.startswith("{") else r.value for r in df.collect()]


def test_records_keep_every_field_and_bad_numbers_as_text(spark, tmp_path):
    path = tmp_path / "with space.csv"
    path.write_text(
        "order_id,quantity,unit_price,discount_percent,coupon,due.to\n"
        "A, 2 ,1e2,x,SAVE,\"a,\"\"b\"\"\"\nB,two,NaN,5,,q\nC,1\nD,2.0,7,-1,K,3000000000\nE,3000000000,Infinity,0,1,2\n",
        encoding="utf-8",
    )
    records = read_csv_records(spark, str(path))
    sent = values_of(record_messages(records))
    names = ["order_id", "quantity", "unit_price", "discount_percent", "coupon", "due.to"]
    assert sent == [
        dict(zip(names, ["A", 2, 100.0, "x", "SAVE", 'a,"b"'])),
        dict(zip(names, ["B", "two", "NaN", 5.0, None, "q"])),
        "C,1",
        dict(zip(names, ["D", "2.0", 7.0, -1.0, "K", "3000000000"])),
        dict(zip(names, ["E", 3_000_000_000, "Infinity", 0.0, "1", "2"])),
    ]
    publish_transactions(records, "text", path=str(tmp_path / "out"))
    back = split_valid(process(spark.read.text(str(tmp_path / "out"))))[1]
    assert "C,1" in {r.message for r in back.collect()}


def test_files_of_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,quantity\nA,1\n")
    (tmp_path / "b.csv").write_text("\ufeffquantity,extra,order_id\n2,x,B\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text("order_id,quantity\n")
    (tmp_path / "d.csv").write_text("")
    rows = read_transactions_files(spark, str(tmp_path)).collect()
    assert sorted((r.order_id, r.quantity, r.corrupt) for r in rows) == [("A", 1, False), ("B", 2, False)]
    sent = values_of(record_messages(read_csv_records(spark, str(tmp_path))))
    assert sorted((r["order_id"], r["quantity"], r["extra"]) for r in sent) == [("A", 1, None), ("B", 2, "x")]
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "d.csv").write_text("")
    assert read_csv_records(spark, str(empty)).count() == 0 == read_transactions_files(spark, str(empty)).count()


def test_corrupt_rows_are_published_as_their_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("order_id,quantity\nA,1\nB\n")
    sent = values_of(to_messages(read_transactions_files(spark, str(tmp_path))))
    assert sent[1] == "B" and sent[0]["quantity"] == 1
