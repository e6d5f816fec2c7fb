from __future__ import annotations

import json
import os

import pytest
from conftest import as_dict, as_set, frame, order
from pyspark.sql import functions as F

from orderflow.functions.parse import process
from orderflow.functions.quality import split_valid
from orderflow.operators import metrics
from orderflow.operators.windows import orders_in_last_minute, windowed_orders
from orderflow.plans.rollup import SNAPSHOT_COLUMNS, metrics_snapshot
from orderflow.schema import PROCESSED_SCHEMA, RAW_SCHEMA
from orderflow.session import child_names, stored_bytes
from orderflow.streaming import aggregates as aggregates_module
from orderflow.streaming import store as store_module
from orderflow.streaming.aggregates import (
    MERGED_BATCHES,
    dedup_orders,
    read_results,
    streaming_metrics,
    streaming_windowed_orders,
    write_results,
)
from orderflow.streaming.jobs import process_batch, start_stream
from orderflow.streaming.store import TransactionStore, append_history

BATCHES = [
    [order("O1", "2026-09-21 10:00:09"), order("O2", "2026-09-21 10:00:50", status="Returned", category="Toys")],
    [order("O3", "2026-09-21 10:03:00", city=None, price=2.5), order("O3", "2026-09-21 10:03:00", price=2.5)],
    # Late, without a category, and of an unlisted status.
    [order("O4", "2026-09-20 09:00:00", category=None, status="Pending"), order("O5", "2026-09-21 10:02:30")],
]


def text_of(row):
    return json.dumps(dict(zip(RAW_SCHEMA.names, row)))


def put(folder, number, *texts):
    folder.mkdir(exist_ok=True)
    path = folder / f"{number:03d}.txt"
    path.write_text("\n".join(texts) + "\n")
    # Files arrive in the order of their times, which a fast disk leaves equal.
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def message_stream(spark, folder, per_batch=1):
    return process(spark.readStream.option("maxFilesPerTrigger", per_batch).text(str(folder)))


def put_batches(folder):
    """Three batches of messages, the second one with two that are refused."""
    for number, batch in enumerate(BATCHES):
        spoiled = ["not json", text_of(order("O9", quantity=-1))] if number == 1 else []
        put(folder, number, *map(text_of, batch), *spoiled)
    return folder


@pytest.fixture
def source(tmp_path):
    return put_batches(tmp_path / "in")


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    """The tables after the three batches, for tests that only read them."""
    folder = tmp_path_factory.mktemp("finished")
    return run(spark, put_batches(folder / "in"), folder / "root")


def run(spark, source, root, **options):
    start_stream(
        message_stream(spark, source), str(root), trigger={"availableNow": True}, **options
    ).awaitTermination()
    return TransactionStore(spark, str(root))


def rows_of(store):
    return as_set(store.snapshot_rows().select(*SNAPSHOT_COLUMNS))


def everything(spark):
    return frame(spark, [row for batch in BATCHES for row in batch])


def test_stream_equals_batch(spark, finished):
    store = finished
    assert rows_of(store) == as_set(metrics_snapshot(everything(spark)))
    assert as_set(store.history().drop("batch_id")) == as_set(
        everything(spark).select(*PROCESSED_SCHEMA.names))
    assert store.newest()["accepted_rows"] == 6


def test_refused_rows_are_kept_with_their_reasons(finished):
    refused = finished.quarantine().collect()
    assert {(r.batch_id, r.message, tuple(r.reasons)) for r in refused} == {
        (1, "not json", ("malformed_message",)),
        (1, text_of(order("O9", quantity=-1)), ("negative_quantity",)),
    }


def test_without_row_rules_every_row_counts(spark, source, tmp_path):
    store = run(spark, source, tmp_path / "root", validate=False)
    assert store.newest()["accepted_rows"] == 8 and store.quarantine().count() == 0


def test_recent_goes_by_arrival(finished):
    store = finished
    assert [r.order_id for r in store.recent().collect()] == ["O5", "O4", "O3", "O3", "O2", "O1"]
    assert [r.order_id for r in store.recent(1).collect()] == ["O5"]


def test_recent_beyond_what_is_kept_comes_from_history(spark, source, tmp_path):
    store = run(spark, source, tmp_path / "root", recent=3)
    assert len(store.newest()["recent"]) == 3
    assert [r.order_id for r in store.recent(3).collect()] == ["O5", "O4", "O3"]
    assert [r.order_id for r in store.recent(50).collect()] == ["O5", "O4", "O3", "O3", "O2", "O1"]
    assert store.recent(50).schema == store.recent(3).schema


def test_stream_goes_on_from_its_checkpoint(spark, source, tmp_path):
    run(spark, source, tmp_path / "root")
    put(source, 9, text_of(order("O6", "2026-09-21 10:03:30")))
    store = run(spark, source, tmp_path / "root")
    total = store.snapshot_rows().where("metric = 'total_orders'").first().order_count
    last = store.snapshot_rows().where("metric = 'orders_in_last_minute'").first().order_count
    assert (total, last, store.newest()["batch_id"]) == (7, 4, 3)


def test_the_same_batch_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "root")
    batches = [frame(spark, rows) for rows in BATCHES]
    assert process_batch(batches[0], 0, root) and process_batch(batches[1], 1, root)
    store = TransactionStore(spark, root)
    before = rows_of(store)
    assert not process_batch(batches[1], 1, root)
    assert rows_of(store) == before and store.history().count() == 4


@pytest.mark.parametrize("step", ["write_batch", "_write_state", "_write"])
def test_a_batch_that_broke_off_is_counted_once(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path / "root")
    batches = [frame(spark, rows) for rows in BATCHES]
    process_batch(batches[0], 0, root)
    store = TransactionStore(spark, root)
    before = rows_of(store)

    import orderflow.streaming.store as module

    place = module if step == "write_batch" else TransactionStore
    original = getattr(place, step)

    def broken(*args, **kwargs):
        if step != "_write":
            original(*args, **kwargs)
        raise OSError("lost")

    monkeypatch.setattr(place, step, broken)
    with pytest.raises(OSError):
        process_batch(batches[1], 1, root)
    # Nothing of the unfinished batch shows.
    assert rows_of(store) == before and store.history().count() == 2
    monkeypatch.undo()
    process_batch(batches[1], 1, root)
    process_batch(batches[2], 2, root)
    assert rows_of(store) == as_set(metrics_snapshot(everything(spark)))
    assert store.history().count() == 6


def test_empty_batches_leave_no_trace(spark, nothing, tmp_path):
    root = str(tmp_path / "root")
    assert not process_batch(nothing, 0, root)
    store = TransactionStore(spark, root)
    assert store.newest() is None and store.history().count() == 0
    assert store.recent().count() == 0 and store.snapshot_rows().count() == 0
    process_batch(frame(spark, BATCHES[0]), 1, root)
    assert not process_batch(nothing, 2, root)
    assert store.newest()["batch_id"] == 1


def test_a_batch_of_refused_rows_only(spark, tmp_path):
    root = str(tmp_path / "root")
    process_batch(frame(spark, BATCHES[0]), 0, root)
    process_batch(frame(spark, [order(quantity=-1)]), 1, root)
    store = TransactionStore(spark, root)
    assert store.newest()["accepted_rows"] == 2 and store.quarantine().count() == 1
    assert rows_of(store) == as_set(metrics_snapshot(frame(spark, BATCHES[0])))


def test_another_stream_may_not_add_to_the_tables(spark, finished):
    with pytest.raises(ValueError, match="another stream"):
        process_batch(frame(spark, BATCHES[0]), 99, finished.root)


def test_old_versions_go_and_transactions_stay(spark, tmp_path):
    root = str(tmp_path / "root")
    for number in range(6):
        process_batch(frame(spark, BATCHES[0]), number, root, keep=2, keep_seconds=0)
    assert set(child_names(spark, f"{root}/versions")) == {"batch_id=4", "batch_id=5"}
    store = TransactionStore(spark, root)
    assert store.history().count() == 12
    left = [n for n in range(6) if child_names(spark, f"{root}/state/batch_id={n}/day=all")]
    assert left == [4, 5]
    assert store.snapshot_rows(4).count() > 0
    for gone in (0, 99):
        with pytest.raises(ValueError, match="not stored"):
            store.snapshot_rows(gone)


def test_young_versions_stay_for_their_readers(spark, tmp_path):
    root = str(tmp_path / "root")
    process_batch(frame(spark, BATCHES[0]), 0, root, keep=1)
    held = TransactionStore(spark, root).snapshot_rows()
    before = as_set(held.select(*SNAPSHOT_COLUMNS))
    for number in range(1, 5):
        process_batch(frame(spark, BATCHES[0]), number, root, keep=1)
    assert as_set(held.select(*SNAPSHOT_COLUMNS)) == before


def files_below(folder):
    return {str(f): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_a_batch_leaves_the_files_of_other_days_alone(spark, tmp_path):
    root = tmp_path / "root"
    days = [frame(spark, [order(f"O{d}", f"2026-09-{d:02d} 10:00:00")]) for d in range(1, 5)]
    for number, rows in enumerate(days):
        process_batch(rows, number, str(root), keep=1, keep_seconds=0)
    before = files_below(root / "state")
    # A late row of the second day, and one that has no day's company yet.
    late = frame(spark, [order("L", "2026-09-02 10:00:30"), order("N", "2026-08-01 00:00:00")])
    process_batch(late, 4, str(root), keep=1, keep_seconds=0)
    after = files_below(root / "state")
    same = {f.split("day=")[1][:10] for f in after if before.get(f) == after[f]}
    assert same == {"2026-09-01", "2026-09-03", "2026-09-04"}
    store = TransactionStore(spark, str(root))
    assert store.newest()["days"] == {
        "2026-09-01": 0, "2026-09-02": 4, "2026-09-03": 2, "2026-09-04": 3, "2026-08-01": 4}
    assert len({f.split("day=")[1][:10] for f in after}) == len([f for f in after]) == 6
    everything_sent = days[0].union(days[1]).union(days[2]).union(days[3]).union(late)
    assert rows_of(store) == as_set(metrics_snapshot(everything_sent))


def test_append_history_replaces_a_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = frame(spark, [order(f"O{n}") for n in range(5)])
    append_history(rows, 0, path)
    append_history(rows, 0, path)
    append_history(rows, 1, path)
    assert spark.read.parquet(path).count() == 10
    assert append_history(rows.limit(0), 1, path).count() == 0
    assert spark.read.parquet(path).count() == 5


def test_archive_keeps_every_row(spark, tmp_path):
    root = str(tmp_path / "root")
    store = TransactionStore(spark, root)
    for number, rows in enumerate(BATCHES * 2):
        process_batch(frame(spark, [*rows, order(f"bad{number}", quantity=-1)]), number, root)
    history, refused = as_set(store.history()), {r.order_id for r in store.quarantine().collect()}
    assert len(refused) == 6

    assert not store.compact(leave=10)
    assert store.compact(leave=4) and store.archived_upto() == 1
    assert as_set(store.history()) == history
    assert store.compact(leave=1) and not store.compact(leave=1)
    assert store.drop_archived() == 5
    assert child_names(spark, f"{root}/transactions") == ["batch_id=5"]
    assert as_set(store.history()) == history
    assert {r.order_id for r in store.quarantine().collect()} == refused
    process_batch(frame(spark, BATCHES[0]), 6, root)
    assert store.history().count() == len(BATCHES) * 4 + 2


def test_an_archive_run_that_broke_off_leaves_no_second_copy(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    store = TransactionStore(spark, root)
    for number in range(4):
        process_batch(frame(spark, BATCHES[0]), number, root)
    write = TransactionStore._write

    def lost(self, df, table, batch_id):
        if table == "archives":
            raise OSError("lost")
        write(self, df, table, batch_id)

    monkeypatch.setattr(TransactionStore, "_write", lost)
    with pytest.raises(OSError):
        store.compact(leave=2)
    assert store.history().count() == 8
    monkeypatch.undo()
    # The bound moves on, so the next run writes another folder over the same batches.
    process_batch(frame(spark, BATCHES[1]), 4, root)
    assert store.compact(leave=2)
    assert store.history().count() == 10 and store.quarantine().count() == 0
    assert child_names(spark, f"{root}/archive") == ["upto=2"]
    assert store.drop_archived(wait_seconds=3600) == 0
    assert store.drop_archived() == 3 and store.history().count() == 10


def test_the_service_archives_as_it_goes(spark, tmp_path):
    source = tmp_path / "in"
    for number in range(7):
        put(source, number, text_of(order(f"O{number}", f"2026-09-21 10:0{number}:00")))
    store = run(spark, source, tmp_path / "root", archive_every=3, archive_leave=1, archive_wait_seconds=0)
    # After batches 2 and 5, all but the newest batch went to the archive.
    assert store.archived_upto() == 4
    assert set(child_names(spark, f"{store.root}/transactions")) == {"batch_id=5", "batch_id=6"}
    assert store.history().count() == 7


def test_archive_has_as_many_files_as_the_data_fills(spark, tmp_path, monkeypatch):
    import orderflow.streaming.store as module

    root = str(tmp_path / "root")
    store = TransactionStore(spark, root)
    # One moment holds all rows: the order id still spreads them.
    process_batch(frame(spark, [order(f"O{n}") for n in range(500)]), 0, root)
    size = stored_bytes(spark, f"{root}/transactions")
    monkeypatch.setattr(module, "ARCHIVE_FILE_BYTES", size // 4 + 1)
    assert store.compact(leave=0)
    files = list((tmp_path / "root" / "archive" / "upto=0" / "accepted=true").glob("*.parquet"))
    assert len(files) == 4 and store.history().count() == 500


def logged_tasks(spark, folder, work):
    """Metrics of the tasks that ``work`` runs, from an event log of its own."""
    jvm, context = spark._jvm, spark._jsc.sc()
    conf = context.conf().clone().set("spark.eventLog.compress", "false")
    none = getattr(jvm.scala, "None$").__getattr__("MODULE$")
    log = jvm.org.apache.spark.scheduler.EventLoggingListener(
        "log", none, jvm.java.net.URI(folder.as_uri()), conf, spark._jsc.hadoopConfiguration()
    )
    log.start()
    context.addSparkListener(log)
    try:
        work()
        context.listenerBus().waitUntilEmpty()
    finally:
        context.removeSparkListener(log)
        log.stop()
    events = [json.loads(line) for path in folder.rglob("*") if path.is_file() and not path.name.endswith(".crc")
              for line in path.read_text().splitlines()]
    return [e["Task Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd"]


def test_archiving_holds_no_rows_in_memory(spark, tmp_path, monkeypatch):
    """Neither moving batches nor merging archives sorts what a file takes."""
    monkeypatch.setattr(store_module, "MERGED", 2)
    (tmp_path / "log").mkdir()
    root = str(tmp_path / "root")
    store = TransactionStore(spark, root)
    rows = [*(order(f"O{n}", f"2026-09-21 10:00:{n % 60:02d}") for n in range(300)), order("bad", quantity=-1)]
    for number in range(2):
        process_batch(frame(spark, rows), number, root)
    tasks = logged_tasks(spark, tmp_path / "log", lambda: (store.compact(leave=1), store.compact(leave=0)))
    writing = [t for t in tasks if t["Output Metrics"]["Records Written"]]
    # The rows of each batch, then those of both once more, and three records.
    assert sum(t["Output Metrics"]["Records Written"] for t in writing) == 4 * len(rows) + 3
    assert max(t["Peak Execution Memory"] for t in writing) == 0
    assert store.history().count() == 600 and store.quarantine().count() == 2
    names = child_names(spark, f"{root}/archive_l1/upto=1")
    assert {name for name in names if "=" in name} == {"accepted=true", "accepted=false"}


def test_an_archive_of_refused_rows_alone_or_of_none(spark, tmp_path):
    root = str(tmp_path / "root")
    store = TransactionStore(spark, root)
    process_batch(frame(spark, [order("bad", quantity=-1)]), 0, root)
    # Batches without a row leave no folder, but the archive goes past them.
    for number in (1, 2):
        process_batch(frame(spark, BATCHES[0]).limit(0), number, root)
    process_batch(frame(spark, BATCHES[0]), 3, root)
    assert store.compact(leave=3) and store.compact(leave=1) and store.archived_upto() == 2
    store.drop_archived()
    assert [r.order_id for r in store.quarantine().collect()] == ["bad"]
    assert store.history().count() == len(BATCHES[0])


def test_last_minute_of_a_stream_is_refused(spark, source):
    with pytest.raises(ValueError, match="stream"):
        orders_in_last_minute(message_stream(spark, source))


# --- Spark's own streaming state --------------------------------------------------


def results(spark, stream, folder, mode, keys=None):
    write_results(stream, str(folder), mode).awaitTermination()
    return read_results(spark, str(folder), stream.schema, mode, keys)


def valid_stream(spark, source, per_batch=1):
    return split_valid(message_stream(spark, source, per_batch))[0].drop("message")


@pytest.mark.parametrize("name", list(metrics.METRICS))
def test_streaming_metrics_are_cumulative(spark, source, tmp_path, name):
    found = results(spark, streaming_metrics(valid_stream(spark, source), name), tmp_path / "out", "complete")
    assert as_set(found) == as_set(metrics.METRICS[name](everything(spark)))


def test_update_mode_gives_the_last_count_per_window(spark, source, tmp_path):
    stream = streaming_windowed_orders(valid_stream(spark, source), "2 days")
    found = results(spark, stream, tmp_path / "out", "update", ["window_start", "window_end"])
    assert as_set(found) == as_set(windowed_orders(everything(spark)))


def test_rows_beyond_the_lateness_are_dropped(spark, source, tmp_path):
    stream = streaming_windowed_orders(valid_stream(spark, source), "1 minute")
    found = results(spark, stream, tmp_path / "out", "update", ["window_start", "window_end"])
    assert sum(r.order_count for r in found.collect()) == 5
    closed = results(spark, stream, tmp_path / "closed", "append")
    assert as_dict(closed.selectExpr("date_format(window_start, 'HH:mm')", "order_count")) == {"10:00": 2}


def test_sliding_windows_on_a_stream(spark, source, tmp_path):
    stream = streaming_windowed_orders(valid_stream(spark, source), "2 days", "10 minutes", "5 minutes")
    found = results(spark, stream, tmp_path / "out", "update", ["window_start", "window_end"])
    assert as_set(found) == as_set(windowed_orders(everything(spark), "10 minutes", "5 minutes"))


def test_dedup_counts_a_repeated_id_once(spark, source, tmp_path):
    stream = dedup_orders(valid_stream(spark, source), "2 days")
    found = results(spark, stream, tmp_path / "out", "append")
    assert sorted(r.order_id for r in found.collect()) == ["O1", "O2", "O3", "O4", "O5"]


def write_batch_of(spark, monkeypatch, folder, mode, keys=None, keep_seconds=0):
    """The function that a result stream calls for each batch, without a stream."""
    calls = []

    class Writer:
        def __getattr__(self, name):
            def option(*args, **kwargs):
                if name == "foreachBatch":
                    calls.append(args[0])
                return self

            return option

    class Frame:
        writeStream = Writer()

    write_results(Frame(), str(folder), mode, keys=keys, keep_seconds=keep_seconds)
    return calls[0]


@pytest.mark.parametrize("mode", ["update", "append", "complete"])
def test_results_stay_as_large_as_one_state(spark, tmp_path, monkeypatch, mode):
    keys = ["key"] if mode == "update" else None
    write = write_batch_of(spark, monkeypatch, tmp_path, mode, keys)
    schema = "key long, n long"
    sizes = []
    for number in range(200 if mode == "update" else 24):
        rows = [(k, number) for k in (number % 10, 10 + number % 3)]
        write(spark.createDataFrame(rows, schema).coalesce(1), number)
        if number in (9, 23):
            # The same batch again, and one that is long merged, change nothing.
            before = as_set(read_results(spark, str(tmp_path), spark.createDataFrame([], schema).schema, mode, keys))
            write(spark.createDataFrame(rows, schema).coalesce(1), number)
            write(spark.createDataFrame([(99, 99)], schema), 2)
            after = read_results(spark, str(tmp_path), spark.createDataFrame([], schema).schema, mode, keys)
            assert as_set(after) == before
        sizes.append(sum(len(child_names(spark, f"{tmp_path}/{t}")) for t in ("results", "merged", "done")))
    assert max(sizes) <= 3 * MERGED_BATCHES
    found = read_results(spark, str(tmp_path), spark.createDataFrame([], schema).schema, mode, keys)
    last = number
    wanted = {
        "update": {(k, max(n for n in range(last + 1) if n % 10 == k)) for k in range(10)}
        | {(10 + k, max(n for n in range(last + 1) if n % 3 == k)) for k in range(3)},
        "append": {(k, n) for n in range(last + 1) for k in (n % 10, 10 + n % 3)},
        "complete": {(k, last) for k in (last % 10, 10 + last % 3)},
    }
    assert as_set(found) == wanted[mode] and found.count() == len(wanted[mode])


def test_results_of_another_stream_are_refused(spark, tmp_path, monkeypatch):
    write = write_batch_of(spark, monkeypatch, tmp_path, "append")
    write(spark.createDataFrame([(1,)], "n long"), 0)
    monkeypatch.setattr(type(spark.sparkContext), "getLocalProperty", lambda *_: "another")
    with pytest.raises(ValueError, match="another stream"):
        write(spark.createDataFrame([(2,)], "n long"), 0)


def test_a_merge_of_results_that_broke_off_changes_nothing(spark, tmp_path, monkeypatch):
    write = write_batch_of(spark, monkeypatch, tmp_path, "update", ["key"])
    batch = lambda n: spark.createDataFrame([(n % 2, n)], "key long, n long")
    for number in range(MERGED_BATCHES - 1):
        write(batch(number), number)
    with monkeypatch.context() as broken:
        create = aggregates_module.create_new
        broken.setattr(aggregates_module, "create_new", lambda s, path: 1 / ("/done/" not in path) and create(s, path))
        with pytest.raises(ZeroDivisionError):
            write(batch(MERGED_BATCHES - 1), MERGED_BATCHES - 1)
    schema = batch(0).schema
    wanted = {(0, MERGED_BATCHES - 2), (1, MERGED_BATCHES - 1)}
    assert as_set(read_results(spark, str(tmp_path), schema, "update", ["key"])) == wanted
    write(batch(MERGED_BATCHES - 1), MERGED_BATCHES - 1)
    assert as_set(read_results(spark, str(tmp_path), schema, "update", ["key"])) == wanted
    assert child_names(spark, f"{tmp_path}/results") == []


def folders_of(spark, root):
    names = [n for n in child_names(spark, root) if n.startswith("archive") and not n.startswith("archives") and n != "archivers"]
    return {n: child_names(spark, f"{root}/{n}") for n in names}


def test_archives_merge_into_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_module, "MERGED", 2)
    root = str(tmp_path / "root")
    store = TransactionStore(spark, root)
    expected = set()
    for number in range(7):
        process_batch(frame(spark, [order(f"O{number}"), order(f"bad{number}", quantity=-1)]), number, root)
        expected.add(f"O{number}")
        assert store.compact(leave=0)
        store.drop_archived()
        assert {r.order_id for r in store.history().collect()} == expected
        assert store.history().count() == number + 1 == store.quarantine().count()
    # 7 = 4 + 2 + 1: a folder each, and nothing left of what they were merged from.
    assert {k: v for k, v in folders_of(spark, root).items() if v} == {
        "archive": ["upto=6"], "archive_l1": ["upto=5"], "archive_l2": ["upto=3"]}
    assert store.archived_upto() == 6 and [(a.level, a.rows_from) for a in store._archives()] == [(2, 0), (1, 4), (0, 6)]


@pytest.mark.parametrize("table", ["archives", "archives_l1"])
def test_merging_may_break_off_anywhere(spark, tmp_path, monkeypatch, table):
    monkeypatch.setattr(store_module, "MERGED", 2)
    root = str(tmp_path / "root")
    for number in range(2):
        process_batch(frame(spark, BATCHES[number]), number, root)
        if not number:
            TransactionStore(spark, root).compact(leave=0)
    write = TransactionStore._write

    def lost(self, df, name, batch_id):
        if name == table:
            raise OSError("lost")
        write(self, df, name, batch_id)

    history = as_set(TransactionStore(spark, root).history())
    monkeypatch.setattr(TransactionStore, "_write", lost)
    with pytest.raises(OSError):
        TransactionStore(spark, root).compact(leave=0)
    monkeypatch.setattr(TransactionStore, "_write", write)
    store = TransactionStore(spark, root)
    assert as_set(store.history()) == history and store.history().count() == len(history)
    process_batch(frame(spark, BATCHES[2]), 2, root)
    assert store.compact(leave=0)
    store.drop_archived()
    assert store.history().count() == sum(len(b) for b in BATCHES[:3])
    assert len(store._archives()) <= 2


def test_a_late_writer_raises_and_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "root")
    first, second = TransactionStore(spark, root), TransactionStore(spark, root)
    rows = frame(spark, BATCHES[0])
    assert first.add_batch(rows, 0) and second.add_batch(frame(spark, BATCHES[1]), 1)
    before, found = files_below(tmp_path / "root"), rows_of(second)
    with pytest.raises(RuntimeError, match="taken over"):
        first.add_batch(rows, 2)
    assert files_below(tmp_path / "root") == before and rows_of(second) == found
    assert second.add_batch(rows, 2)
    # Reading and archiving are not writing of batches.
    assert first.compact(leave=1) and second.add_batch(rows, 3) and first.history().count() == 4 * len(BATCHES[0])


def test_a_writer_overtaken_in_its_batch_publishes_no_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "root")
    first, second = TransactionStore(spark, root), TransactionStore(spark, root)
    rows = frame(spark, BATCHES[0])
    first.add_batch(rows, 0)
    write_state = TransactionStore._write_state

    def overtaken(self, state, batch_id):
        write_state(self, state, batch_id)
        if self is first:
            second.add_batch(rows, 1)

    monkeypatch.setattr(TransactionStore, "_write_state", overtaken)
    with pytest.raises(RuntimeError, match="taken over"):
        first.add_batch(rows, 1)
    assert second.newest()["batch_id"] == 1 and second.history().count() == 2 * len(BATCHES[0])
    assert not second.add_batch(rows, 1) and second.add_batch(rows, 2)
