"""Idle, stopped and failed streams told apart."""

from __future__ import annotations

import json
import time

import pytest
from conftest import order
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orderflow.functions.parse import process
from orderflow.plans.snapshot import pipeline_status
from orderflow.schema import RAW_SCHEMA
from orderflow.session import child_names
from orderflow.streaming import jobs as jobs_module
from orderflow.streaming.heartbeat import FAILED, RUNNING, STOPPED, last_beat, leave_beat
from orderflow.streaming.jobs import start_stream
from orderflow.streaming.store import TransactionStore


def status_of(store, now=None):
    return pipeline_status(store.freshness(), F.current_timestamp() if now is None else now).first()


def put(folder, name, row):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(dict(zip(RAW_SCHEMA.names, row))) + "\n")


def waited_for(condition, seconds=60):
    until = time.time() + seconds
    while not condition() and time.time() < until:
        time.sleep(0.2)
    return condition()


def test_an_idle_stream_stays_live_and_a_stopped_one_is_paused(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.noDataProgressEventInterval", "500")
    source, root = tmp_path / "in", str(tmp_path / "root")
    put(source, "a.txt", order("O1"))
    # The data are older than any limit when the stream has been idle.
    old = F.current_timestamp() - F.expr("interval 1 hour")
    query = start_stream(
        process(spark.readStream.text(str(source))), root, trigger={"processingTime": "200 milliseconds"}, computed_at=old
    )
    store = TransactionStore(spark, root)
    try:
        assert waited_for(lambda: store.newest() is not None)
        first = last_beat(spark, root)
        assert waited_for(lambda: last_beat(spark, root).at > first.at)
        row = status_of(store)
        assert (row.status, row.is_live, row.has_data) == ("LIVE", True, True)
        assert row.age_seconds > 3000
        # Not a sign of life for long.
        assert status_of(store, F.current_timestamp() + F.expr("interval 1 hour")).status == "PAUSED"
    finally:
        query.stop()
        spark.conf.unset("spark.sql.streaming.noDataProgressEventInterval")
    assert waited_for(lambda: last_beat(spark, root).state == STOPPED)
    assert status_of(store).status == "PAUSED"
    assert len(child_names(spark, f"{root}/heartbeat")) <= 2


def test_a_failed_stream_is_an_error_with_its_text(spark, tmp_path, monkeypatch):
    def broken(*_, **__):
        raise RuntimeError("no space left on the shelf")

    put(tmp_path / "in", "a.txt", order("O1"))
    monkeypatch.setattr(jobs_module, "process_batch", broken)
    root = str(tmp_path / "root")
    query = start_stream(process(spark.readStream.text(str(tmp_path / "in"))), root, trigger={"availableNow": True})
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
    assert waited_for(lambda: last_beat(spark, root).state == FAILED)
    row = status_of(TransactionStore(spark, root))
    assert (row.status, row.has_data) == ("ERROR", False)
    assert row.error == "RuntimeError: no space left on the shelf"


def test_tables_without_a_stream_go_by_the_age_of_their_data(spark, tmp_path):
    store = TransactionStore(spark, str(tmp_path))
    assert last_beat(spark, str(tmp_path)) is None
    assert status_of(store).status == "WAITING"
    leave_beat(spark, str(tmp_path), RUNNING)
    leave_beat(spark, str(tmp_path), RUNNING)
    assert status_of(store).status == "WAITING"
    assert len(child_names(spark, f"{tmp_path}/heartbeat")) == 1
