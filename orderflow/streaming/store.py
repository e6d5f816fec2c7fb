"""The tables of a streaming pipeline.

Below one root folder, each with one folder per micro-batch:

``transactions``  every row of the batch, marked accepted or refused
``state``         margins (see ``plans.rollup``): ``day=all`` those of the text
                  dimensions over all batches, and a folder for each day that
                  the batch had rows of, with the minutes of that day
``versions``      one row per finished batch, written last: where the state of
                  each day lies, the latest transactions, and totals
``archive``       transactions of many old batches in fewer, larger files;
                  ``archive_l1`` and so on those of several archive folders merged
``archives``      one row per finished archive folder, written after it, and
                  ``archives_l1`` and so on; a merged folder's row replaces those
                  of the folders that it covers
``heartbeat``     the last sign of life of the stream (see ``streaming.heartbeat``)
``writers``       the epoch of the one writer, and ``archivers`` of who archives

A version record makes a batch visible. All else is written before it and
overwritten when a batch is run again, so a crash at any point leaves the last
finished version readable and counts the repeated batch once. What has no
record is never read: a folder that a broken-off archive run left is passed
over and removed by the next one.

State is carried from version to version. A micro-batch costs its own rows,
one row per value of each text dimension, and the minutes of the days it has
rows of; other days stay where they are, and the transactions of earlier
batches are not read again. The metrics follow from the state when they are read.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from orderflow.functions.quality import is_valid, reasons
from orderflow.operators.explore import latest
from orderflow.operators.metrics import UNITS_TYPE
from orderflow.operators.windows import as_interval
from orderflow.plans.rollup import MARGIN_COLUMNS, MINUTE, snapshot_rows, state_of
from orderflow.plans.snapshot import SNAPSHOT_SCHEMA, empty_snapshot, snapshot_freshness
from orderflow.schema import PROCESSED_SCHEMA
from orderflow.session import child_names, create_new, delete_path, modified_at, path_exists, stored_bytes
from orderflow.streaming.heartbeat import last_beat, with_beat

# What an archive file should hold.
ARCHIVE_FILE_BYTES = 256 * 1024 * 1024

_BATCH = StructField("batch_id", LongType())
TRANSACTION_SCHEMA = StructType(
    [
        *PROCESSED_SCHEMA,
        StructField("message", StringType()),
        StructField("reasons", ArrayType(StringType())),
        _BATCH,
        StructField("accepted", BooleanType()),
    ]
)
ARCHIVE_SCHEMA = StructType(
    [
        StructField("arrived_in", LongType()),
        *[field for field in TRANSACTION_SCHEMA if field.name != "batch_id"],
        StructField("upto", LongType()),
    ]
)
ARCHIVES_SCHEMA = StructType(
    [StructField("rows_from", LongType()), StructField("written_at", TimestampType()), _BATCH]
)
# Who may change the tables: one writer of batches and one archiver at a time.
WRITERS, ARCHIVERS = "writers", "archivers"
#: Archive folders of one level that are merged into one of the next.
MERGED = 8
RECENT_SCHEMA = StructType([StructField("arrived_in", LongType()), *PROCESSED_SCHEMA])
# The state folder of what belongs to no day.
ALL_DAYS = "all"
STATE_SCHEMA = (
    StructType()
    .add("dimension", "string")
    .add("key", "string")
    .add("time", "timestamp")
    .add("order_count", "long")
    .add("amount", UNITS_TYPE)
    .add("outsize", "double")
    .add("day", "string")
    .add(_BATCH)
)
VERSION_SCHEMA = (
    StructType()
    .add("stream_id", "string")
    .add("accepted_rows", "long")
    .add("latest_micros", "long")
    .add("computed_at", "timestamp")
    .add("written_at", "timestamp")
    .add("days", MapType(StringType(), LongType()))
    .add("recent_kept", "integer")
    .add("recent", ArrayType(RECENT_SCHEMA))
    .add(_BATCH)
)


def judged(df: DataFrame, validate: bool = True) -> DataFrame:
    """Processed rows and whether they are ``accepted``; refused ones with their why.

    Without validation every row is accepted, as in a pipeline that has no
    row rules.
    """
    rows = df if "message" in df.columns else df.withColumn("message", F.lit(None).cast("string"))
    accepted = is_valid(rows.columns) if validate else F.lit(True)
    return rows.select(
        *[F.col(field.name).cast(field.dataType) for field in PROCESSED_SCHEMA],
        F.when(~accepted, F.col("message")).alias("message"),
        F.when(~accepted, reasons(rows.columns)).alias("reasons"),
        accepted.alias("accepted"),
    )


def write_batch(
    batch_df: DataFrame, batch_id: int, path: str, validate: bool = True
) -> dict[str, object]:
    """Write a micro-batch as folder ``batch_id`` of the transaction table.

    Accepted and refused rows go out in one pass over the source, which also
    observes the number of ``rows``, of ``accepted`` ones, their ``latest`` event
    time, in microseconds, and their ``days``, which are few in any batch. Running a batch again replaces its folder, also where it now
    has no rows.
    """
    seen = Observation()
    accepted_time = F.when(F.col("accepted"), F.unix_micros("timestamp"))
    accepted_day = F.when(F.col("accepted"), F.date_format("timestamp", "yyyy-MM-dd"))
    (
        judged(batch_df, validate)
        .observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.count_if("accepted").alias("accepted"),
            F.max(accepted_time).alias("latest"),
            F.array_sort(F.collect_set(accepted_day)).alias("days"),
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("accepted")
        .parquet(f"{path}/batch_id={batch_id}")
    )
    return seen.get


def read_batch(spark: SparkSession, batch_id: int, path: str) -> DataFrame:
    """One micro-batch of the transaction table, without listing the others."""
    reader = spark.read.schema(TRANSACTION_SCHEMA).option("basePath", path)
    return reader.parquet(f"{path}/batch_id={batch_id}")


def append_history(
    batch_df: DataFrame, batch_id: int, path: str, validate: bool = True
) -> DataFrame:
    """Write a micro-batch into the transaction table and give its rows back."""
    write_batch(batch_df, batch_id, path, validate)
    return read_batch(batch_df.sparkSession, batch_id, path)


class Archive(NamedTuple):
    """A folder of archived batches, from the first to the last; merged ones are of a higher level."""

    level: int
    rows_from: int
    upto: int
    written_at: datetime | None = None

    def covers(self, other: Archive) -> bool:
        return self.rows_from <= other.rows_from and other.upto <= self.upto


def _rows_table(level: int) -> str:
    return f"archive_l{level}" if level else "archive"


def _records_table(level: int) -> str:
    return f"archives_l{level}" if level else "archives"


class TransactionStore:
    """The tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, epochs: dict[str, int] | None = None):
        """``epochs`` is what a writer holds, for stores that are to be one writer together."""
        self.spark = spark
        self.root = root.rstrip("/")
        self._epochs = {} if epochs is None else epochs

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _folder(self, table: str, batch_id: int) -> str:
        return f"{self.path(table)}/batch_id={batch_id}"

    def _read(self, table: str, schema: StructType) -> DataFrame:
        """A whole table, or an empty frame where nothing was written yet."""
        if not path_exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def _read_version(self, table: str, schema: StructType, batch_id: int) -> DataFrame:
        """One version of a table, without listing the others."""
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        return reader.parquet(self._folder(table, batch_id))

    def _read_folders(self, table: str, schema: StructType, folders: list[str]) -> DataFrame:
        """Some folders of a table, without listing the others."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        return reader.parquet(*folders)

    def _batch_folders(self, table: str) -> list[int]:
        """Numbers of the batches a table has a folder for, finished or not."""
        names = [name.partition("=") for name in child_names(self.spark, self.path(table))]
        return [int(number) for kind, _, number in names if kind == "batch_id"]

    def newest(self) -> Row | None:
        """The version record of the newest finished batch."""
        for number in sorted(self._batch_folders("versions"), reverse=True):
            record = self.version(number)
            if record is not None:
                return record
        return None

    def version(self, batch_id: int) -> Row | None:
        """The record of a finished batch, None if there is none (any more)."""
        if not path_exists(self.spark, self._folder("versions", batch_id)):
            return None
        return self._read_version("versions", VERSION_SCHEMA, batch_id).first()

    # --- reading -----------------------------------------------------------

    def _archive_records(self) -> list[Archive]:
        """All finished archive folders, merged ones and those they were merged from."""
        levels = [n.partition("_l") for n in child_names(self.spark, self.root) if n.startswith("archives")]
        return [
            Archive(int(level or 0), row["rows_from"], row["batch_id"], row["written_at"])
            for _, _, level in levels
            for row in self._read(_records_table(int(level or 0)), ARCHIVES_SCHEMA).collect()
        ]

    def _archives(self) -> list[Archive]:
        """The archive folders that hold the archived rows, each row once, oldest first."""
        live: list[Archive] = []
        for record in sorted(self._archive_records(), key=lambda a: -a.level):
            if not any(a.covers(record) for a in live):
                live.append(record)
        return sorted(live, key=lambda a: a.upto)

    def _read_archives(self, archives: list[Archive]) -> DataFrame:
        """The rows of archive folders as they were in the batches; one read per level."""
        levels: dict[int, list[str]] = {}
        for a in archives:
            levels.setdefault(a.level, []).append(self._archive_folder(a))
        frames = [self._read_folders(_rows_table(n), ARCHIVE_SCHEMA, folders) for n, folders in levels.items()]
        return reduce(DataFrame.unionByName, frames)

    def _archive_folder(self, archive: Archive) -> str:
        return f"{self.path(_rows_table(archive.level))}/upto={archive.upto}"

    def _finished_transactions(self) -> DataFrame:
        newest = self.newest()
        bound = -1 if newest is None else newest["batch_id"]
        archives = self._archives()
        archived = max((a.upto for a in archives), default=-1)
        fresh = [n for n in self._batch_folders("transactions") if archived < n <= bound]
        rows = self._read_folders(
            "transactions", TRANSACTION_SCHEMA, [self._folder("transactions", n) for n in fresh]
        )
        if not archives:
            return rows
        old = self._read_archives(archives)
        return rows.unionByName(
            old.withColumnRenamed("arrived_in", "batch_id").select(*TRANSACTION_SCHEMA.names)
        )

    def archived_upto(self) -> int:
        """The last batch whose transactions are in the archive, -1 if there is none."""
        return max((a.upto for a in self._archives()), default=-1)

    def history(self) -> DataFrame:
        """All accepted transactions of finished batches, with their ``batch_id``."""
        rows = self._finished_transactions().where(F.col("accepted"))
        return rows.select("batch_id", *PROCESSED_SCHEMA.fieldNames())

    def quarantine(self) -> DataFrame:
        """All refused transactions of finished batches, with message and reasons."""
        return self._finished_transactions().where(~F.col("accepted")).drop("accepted")

    def _state(self, record: Row, days: list[str] | None = None) -> DataFrame:
        """The margins of a version, of all days or of some and what belongs to none."""
        batches = {ALL_DAYS: record["batch_id"], **record["days"]}
        chosen = batches if days is None else [ALL_DAYS, *(d for d in days if d in batches)]
        folders = [f"{self._folder('state', batches[day])}/day={day}" for day in chosen]
        # A version without an accepted row has written no folder at all.
        if not record["accepted_rows"]:
            folders = []
        return self._read_folders("state", STATE_SCHEMA, folders).select(*MARGIN_COLUMNS)

    def snapshot_rows(self, version: int | None = None) -> DataFrame:
        """The metrics of a version, by default the newest, as one long frame.

        Empty while there is no version. One that was asked for and is not
        there, because it was never finished or is past its time, is an error.
        The frame reads the version's files when it is used: see ``add_batch``
        for how long these are kept.
        """
        record = self.newest() if version is None else self.version(version)
        if record is None and version is not None:
            raise ValueError(f"version {version} is not stored below {self.root}")
        if record is None:
            return empty_snapshot(self.spark)
        rows = snapshot_rows(self._state(record))
        return rows.select(
            "*",
            F.lit(record["computed_at"]).cast("timestamp").alias("computed_at"),
            F.lit(record["batch_id"]).cast("bigint").alias("batch_id"),
        ).select(*SNAPSHOT_SCHEMA.names)

    def freshness(self) -> DataFrame:
        """The newest version's freshness row with the stream's last beat, for ``pipeline_status``."""
        return with_beat(snapshot_freshness(self.snapshot_rows()), last_beat(self.spark, self.root))

    def recent(self, n: int = 20) -> DataFrame:
        """The latest ``n`` accepted transactions, newest first.

        The version record has the last few; for more, history is read.
        """
        newest = self.newest()
        if newest is None:
            return self.spark.createDataFrame([], RECENT_SCHEMA)
        if n <= max(newest["recent_kept"], len(newest["recent"])) or newest["accepted_rows"] <= len(newest["recent"]):
            kept = self.spark.createDataFrame(newest["recent"], RECENT_SCHEMA)
            return _latest_arrivals(kept, n)
        rows = latest(self.history(), n).withColumnRenamed("batch_id", "arrived_in")
        return rows.select(*RECENT_SCHEMA.names)

    # --- writing -----------------------------------------------------------

    def _hold(self, role: str) -> None:
        """Be the one writer (or archiver) of these tables, or raise if another has come since.

        A writer takes the next epoch by creating its file, which only one can.
        Whoever comes later takes a higher one, and the earlier writer stops
        before its next step that readers could see.
        """
        folder = self.path(role)
        taken = [int(n.partition("=")[2]) for n in child_names(self.spark, folder) if n.startswith("epoch=")]
        newest, own = max(taken, default=0), self._epochs.get(role)
        if own is not None:
            if newest > own:
                raise RuntimeError(f"another of the {role} has taken over the tables below {self.root}")
            return
        while not create_new(self.spark, f"{folder}/epoch={newest + 1}"):
            newest += 1
        self._epochs[role] = newest + 1
        for number in taken:
            delete_path(self.spark, f"{folder}/epoch={number}")

    def _write(self, df: DataFrame, table: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(table, batch_id))

    def add_batch(
        self,
        batch_df: DataFrame,
        batch_id: int,
        stream_id: str = "",
        validate: bool = True,
        recent: int = 20,
        keep: int = 3,
        keep_seconds: int = 3600,
        computed_at: Column | None = None,
    ) -> bool:
        """Add a micro-batch to all tables; False if it was empty or added before.

        A version stays for ``keep_seconds`` at least, and the newest ``keep``
        stay whatever their age: so long may a reader be on a frame it made.
        Raises if another writer has taken over the tables.
        """
        self._hold(WRITERS)
        previous = self.newest()
        if previous is not None:
            if previous["stream_id"] != stream_id:
                raise ValueError(
                    f"the tables below {self.root} belong to another stream checkpoint; "
                    "use that checkpoint or another root folder"
                )
            if previous["batch_id"] >= batch_id:
                return False
        seen = write_batch(batch_df, batch_id, self.path("transactions"), validate)
        if not seen["rows"]:
            delete_path(self.spark, self._folder("transactions", batch_id))
            return False
        accepted = read_batch(self.spark, batch_id, self.path("transactions")).where(
            F.col("accepted")
        )
        touched = list(seen["days"])
        times = [seen["latest"], previous and previous["latest_micros"]]
        latest_micros = max((time for time in times if time is not None), default=None)
        bound = F.timestamp_micros(F.lit(latest_micros).cast("bigint")) - as_interval("1 minute")
        before = None if previous is None else self._state(previous, touched)
        self._write_state(state_of(accepted, before, bound), batch_id)

        now = F.current_timestamp() if computed_at is None else computed_at
        arrivals = accepted.select(
            F.lit(batch_id).cast("bigint").alias("arrived_in"), *PROCESSED_SCHEMA.fieldNames()
        )
        days = dict.fromkeys(touched, batch_id)
        rows = seen["accepted"]
        if previous is not None:
            arrivals = arrivals.unionByName(
                self.spark.createDataFrame(previous["recent"], RECENT_SCHEMA)
            )
            days = {**previous["days"], **days}
            rows += previous["accepted_rows"]
        listed = F.collect_list(F.struct(*RECENT_SCHEMA.names)).alias("recent")
        version = _latest_arrivals(arrivals, recent).agg(listed).select(
            F.lit(stream_id).alias("stream_id"),
            F.lit(rows).cast("bigint").alias("accepted_rows"),
            F.lit(latest_micros).cast("bigint").alias("latest_micros"),
            now.cast("timestamp").alias("computed_at"),
            F.current_timestamp().alias("written_at"),
            F.from_json(F.lit(json.dumps(days)), MapType(StringType(), LongType())).alias("days"),
            F.lit(recent).alias("recent_kept"),
            "recent",
        )
        self._hold(WRITERS)
        self._write(version, "versions", batch_id)
        self._forget_before(batch_id, keep, keep_seconds)
        return True

    def _write_state(self, state: DataFrame, batch_id: int) -> None:
        """Margins of the touched days and of all text values, a file for each folder."""
        day = F.when(F.col("dimension") == MINUTE, F.date_format("time", "yyyy-MM-dd"))
        rows = state.select(*MARGIN_COLUMNS, F.coalesce(day, F.lit(ALL_DAYS)).alias("day"))
        (
            rows.repartition("day")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("day")
            .parquet(self._folder("state", batch_id))
        )

    def compact(self, leave: int = 100) -> bool:
        """Move all but the newest ``leave`` batches into one archive folder.

        Many small files of many batches become few that are clustered by time,
        so that time filters skip most of them. Each transaction moves once. As
        many files are written as the data fills, and the order id in the
        clustering splits a moment that holds most of the rows. Readers take
        the archive as soon as its record is there; ``drop_archived`` then
        removes the old folders.
        """
        self._hold(ARCHIVERS)
        newest, archived = self.newest(), self.archived_upto()
        upto = -1 if newest is None else newest["batch_id"] - leave
        self._drop_orphans()
        if upto <= archived:
            return False
        moving = [n for n in self._batch_folders("transactions") if archived < n <= upto]
        folders = [self._folder("transactions", n) for n in moving]
        rows = self._read_folders("transactions", TRANSACTION_SCHEMA, folders)
        self._write_archive(
            rows.withColumnRenamed("batch_id", "arrived_in"), folders, Archive(0, archived + 1, upto)
        )
        self._merge_archives()
        return True

    def _write_archive(self, rows: DataFrame, folders: list[str], archive: Archive) -> None:
        """Write the rows of some folders as an archive folder; its record, written last, makes it count.

        Accepted and refused rows lie apart already and are written one after
        the other, each read once. To part them in one write, Spark would sort
        every task's rows, and what compresses to one file may be far more in memory.
        """
        target = self._archive_folder(archive)
        delete_path(self.spark, target)
        sizes = {
            value: sum(stored_bytes(self.spark, f"{folder}/accepted={value}") for folder in folders)
            for value in ("true", "false")
        }
        # Without any row the folder is there all the same.
        for value in [v for v in sizes if sizes[v]] or ["true"]:
            files = 1 + sizes[value] // ARCHIVE_FILE_BYTES
            part = rows.where(F.col("accepted") == (value == "true")).drop("accepted")
            self._hold(ARCHIVERS)
            (
                part.repartitionByRange(files, "timestamp", "order_id")
                .write.mode("overwrite")
                .parquet(f"{target}/accepted={value}")
            )
        record = self.spark.range(1).select(
            F.lit(archive.rows_from).cast("bigint").alias("rows_from"),
            F.current_timestamp().alias("written_at"),
        )
        self._hold(ARCHIVERS)
        self._write(record, _records_table(archive.level), archive.upto)

    def _merge_archives(self) -> None:
        """Merge every ``MERGED`` neighbouring folders of a level into one of the next.

        So a thousand archives leave some thirty folders, and a row is written
        again once per level. The merged folder's record replaces those it covers
        in one step; ``drop_archived`` removes them after its wait.
        """
        level = 0
        while (live := self._archives()) and level <= max(a.level for a in live):
            own = [a for a in live if a.level == level][:MERGED]
            if len(own) < MERGED:
                level += 1
                continue
            rows = self._read_archives(own).drop("upto")
            merged = Archive(level + 1, own[0].rows_from, own[-1].upto)
            self._write_archive(rows, [self._archive_folder(a) for a in own], merged)

    def _drop_orphans(self) -> None:
        """Remove what a broken-off run left in the archive: folders without a record."""
        finished = {self._archive_folder(a) for a in self._archive_records()}
        for table in child_names(self.spark, self.root):
            if table != "archive" and not table.startswith("archive_l"):
                continue
            for name in child_names(self.spark, self.path(table)):
                folder = f"{self.path(table)}/{name}"
                if name.startswith("upto=") and folder not in finished:
                    delete_path(self.spark, folder)

    def drop_archived(self, wait_seconds: int = 0) -> int:
        """Delete the batch folders that have been in the archive for a while; returns how many.

        Archive folders that have been merged into another for as long go, too.
        Wait as long as a reader may be on a plan from before.
        """
        self._hold(ARCHIVERS)
        since = _seconds_ago(wait_seconds)
        records = self._archive_records()
        old = [a for a in records if _utc(a.written_at) <= since]
        for a in records:
            if any(b.level > a.level and b.covers(a) for b in old):
                delete_path(self.spark, self._folder(_records_table(a.level), a.upto))
                delete_path(self.spark, self._archive_folder(a))
        archived = max((a.upto for a in old), default=-1)
        outdated = [n for n in self._batch_folders("transactions") if n <= archived]
        for number in outdated:
            delete_path(self.spark, self._folder("transactions", number))
        return len(outdated)

    def _forget_before(self, batch_id: int, keep: int, keep_seconds: int) -> None:
        """Drop versions that are neither new nor young, and the state only they refer to.

        Transactions are never dropped.
        """
        numbers = sorted(n for n in self._batch_folders("versions") if n <= batch_id)
        since = _seconds_ago(keep_seconds)
        # Oldest first, up to the first that stays: young ones are not looked at.
        for number, after in zip(numbers, numbers[1 : len(numbers) - keep + 1]):
            if modified_at(self.spark, self._folder("versions", number)) > since:
                break
            gone, left = self.version(number), self.version(after)
            # The record goes first, so that no reader takes a version that is going.
            delete_path(self.spark, self._folder("versions", number))
            if gone is None:
                continue
            delete_path(self.spark, f"{self._folder('state', number)}/day={ALL_DAYS}")
            # What the next version has elsewhere, no later one refers to.
            for day, batch in gone["days"].items():
                if left is not None and left["days"].get(day) != batch:
                    delete_path(self.spark, f"{self._folder('state', batch)}/day={day}")


def _utc(time: datetime) -> datetime:
    """A collected time, which is local and bare, with its zone."""
    return time.astimezone(timezone.utc)


def _seconds_ago(seconds: int) -> datetime:
    return datetime.now(timezone.utc) - timedelta(seconds=seconds)


def _latest_arrivals(rows: DataFrame, n: int) -> DataFrame:
    """The last ``n`` rows by arrival, then event time and order id; a top list per task."""
    order = ("arrived_in", "timestamp", "order_id")
    return rows.orderBy(*[F.col(name).desc_nulls_last() for name in order]).limit(n)
