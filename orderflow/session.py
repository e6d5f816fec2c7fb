"""Session settings and the shared folder for checkpoints and tables."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

# SQL settings results depend on: event times carry no zone, so one is pinned.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings for sessions we build ourselves. The cluster's own shuffle
# partition count is left alone: AQE coalesces from whatever it is.
SERVICE_SETTINGS = {
    **REQUIRED_SETTINGS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Pin the SQL settings our results depend on in a session someone else built."""
    for key, value in REQUIRED_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Build a session for a job of ours. ``settings`` are added last."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SERVICE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderflow-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_folder(spark)}/orderflow/{name}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whichever file system it names."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    return file_system.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below ``path``, nothing where it does not exist."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    if not file_system.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in file_system.listStatus(hadoop_path)]


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes stored below ``path``, none where it does not exist."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    if not file_system.exists(hadoop_path):
        return 0
    return file_system.getContentSummary(hadoop_path).getLength()


def modified_at(spark: SparkSession, path: str) -> datetime:
    """When ``path`` was last written, by its file system's clock."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    millis = file_system.getFileStatus(hadoop_path).getModificationTime()
    return datetime.fromtimestamp(millis / 1000, timezone.utc)


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where there is one already. Of several callers one succeeds."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    file_system.mkdirs(hadoop_path.getParent())
    return file_system.createNewFile(hadoop_path)


def put_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write a small file that is not seen before it is whole."""
    hidden, file_system = _hadoop_path(spark, f"{folder}/_{name}")
    out = file_system.create(hidden, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    file_system.rename(hidden, _hadoop_path(spark, f"{folder}/{name}")[0])


def stored_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    opened = file_system.open(hadoop_path)
    try:
        return bytes(opened.readAllBytes()).decode("utf-8")
    finally:
        opened.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove ``path`` and what is below it; a missing path is fine."""
    hadoop_path, file_system = _hadoop_path(spark, path)
    file_system.delete(hadoop_path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a derived frame that is read several times: its joins run once, later
    readers get a prunable columnar scan, and lost executors cost no rerun.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
