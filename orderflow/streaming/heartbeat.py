"""Whether a stored pipeline's stream is up, also while no messages come.

A listener on the running query leaves a beat below the tables' root at each
progress or idle event, and a last one with the error, if any, when it ends. A
beat is a small file named by its time and state, in place at once; readers take
the newest. Spark tells of an idle stream every
``spark.sql.streaming.noDataProgressEventInterval``, by default ten seconds.
"""

from __future__ import annotations

import time
from datetime import datetime, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from orderflow.session import child_names, delete_path, put_text, stored_text

RUNNING, STOPPED, FAILED = "running", "stopped", "failed"
_TABLE, _BEAT = "heartbeat", "beat="


class Beat(NamedTuple):
    at: datetime
    state: str
    error: str | None = None


def _beats(spark: SparkSession, root: str) -> list[str]:
    """Names of the beats, oldest first; their times all have the same length."""
    return sorted(n for n in child_names(spark, f"{root}/{_TABLE}") if n.startswith(_BEAT))


def leave_beat(spark: SparkSession, root: str, state: str, error: str | None = None) -> None:
    older = _beats(spark, root)
    name = f"{_BEAT}{time.time_ns() // 1000:017d}-{state}"
    put_text(spark, f"{root}/{_TABLE}", name, error or "")
    for old in older:
        if old < name:
            delete_path(spark, f"{root}/{_TABLE}/{old}")


def last_beat(spark: SparkSession, root: str) -> Beat | None:
    """The newest beat of the stream that writes below ``root``, None if it never had one."""
    for name in reversed(_beats(spark, root)):
        micros, _, state = name.removeprefix(_BEAT).partition("-")
        at = datetime.fromtimestamp(int(micros) / 1e6, timezone.utc)
        error = stored_text(spark, f"{root}/{_TABLE}/{name}") if state == FAILED else None
        return Beat(at, state, error)
    return None


class _Heart(StreamingQueryListener):
    def __init__(self, spark: SparkSession, root: str, run_id: str):
        self.spark, self.root, self.run_id = spark, root, run_id
        self.ended = False

    def end(self, error: str | None) -> None:
        if not self.ended:
            self.ended = True
            leave_beat(self.spark, self.root, FAILED if error else STOPPED, error)

    def _alive(self, run_id: object) -> None:
        if str(run_id) == self.run_id and not self.ended:
            leave_beat(self.spark, self.root, RUNNING)

    def onQueryStarted(self, event) -> None:
        self._alive(event.runId)

    def onQueryProgress(self, event) -> None:
        self._alive(event.progress.runId)

    def onQueryIdle(self, event) -> None:
        self._alive(event.runId)

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self.end(event.exception)


def attach_heart(query: StreamingQuery, spark: SparkSession, root: str) -> StreamingQueryListener:
    """Leave beats below ``root`` for as long as the query runs, and one for how it ended."""
    heart = _Heart(spark, root.rstrip("/"), str(query.runId))
    spark.streams.addListener(heart)
    if query.isActive:
        heart._alive(query.runId)
    else:
        # It ended before the listener was there.
        problem = query.exception()
        heart.end(str(problem) if problem else None)
    return heart


def reason(error: str) -> str:
    """The line of an error that says what happened: a Python traceback's last, else the first."""
    _, trace, inner = error.rpartition("Traceback (most recent call last):")
    lines = [line for line in (inner if trace else error).splitlines() if line.strip()]
    told = [line for line in lines if not line[0].isspace()]
    return (told or lines or [error])[0].strip()


def with_beat(freshness: DataFrame, beat: Beat | None) -> DataFrame:
    """A freshness row with what the stream's last beat says, for ``pipeline_status``.

    Adds ``alive_at`` and ``stopped``; the error a stream ended with comes after
    one that the tables themselves show.
    """

    def value(found: object, kind: str) -> Column:
        return F.lit(found).cast(kind)

    error = beat and beat.error and reason(beat.error)
    return freshness.withColumns(
        {
            "error": F.coalesce("error", value(error, "string")),
            "alive_at": value(beat and beat.at, "timestamp"),
            "stopped": F.lit(beat is not None and beat.state != RUNNING),
        }
    )
