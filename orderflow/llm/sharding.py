"""Shards by jump consistent hashing.

A stable key is hashed to 64 bits and jumps through ever larger shard counts
until it passes the wanted one; the last count it landed in is its shard. There
is no ring table, and a further shard takes 1/(n+1) of the keys, all into itself.

Results are defined as follows. A null key is a key like any other: all its rows
share a shard. Equal keys share a shard however often they occur. A null text
has no bytes, so size 1 and checksum 0. An empty table gives an empty result.
Further columns are ignored by ``shard_rows`` and kept by ``with_shard``, which
refuses a result name that the table already has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from orderflow.llm.common import pick, ship, type_of
from orderflow.session import staged

#: Fixed values of the jump hash: the multiplier of its generator and the bits it keeps.
JUMP_MULTIPLIER = np.uint64(2862933555777941757)
JUMP_SHIFT = np.uint64(33)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard (0 to ``shards`` - 1) of each unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("there must be a shard")
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), dtype=np.int64)
    target = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = target[moving]
        state[moving] = state[moving] * JUMP_MULTIPLIER + np.uint64(1)
        draw = ((state[moving] >> JUMP_SHIFT) + np.uint64(1)).astype(np.float64)
        target[moving] = ((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = moving[target[moving] < shards]
    return shard


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def with_shard(df: DataFrame, key_col: str, shards: int, name: str = "shard") -> DataFrame:
    """The rows with the shard of their key as a last column, for ``write_shards``."""
    if name.lower() in [c.lower() for c in df.columns]:
        raise ValueError(f"the table has a column {name} already")
    ship(df.sparkSession)
    names = [f"_{i}" for i in range(len(df.columns))]

    @F.pandas_udf(IntegerType())
    def shard_of(hashes):
        import pandas as pd

        return pd.Series(jump_hash(hashes.to_numpy().view(np.uint64), shards).astype(np.int32))

    key = F.col(names[df.columns.index(key_col)])
    return df.toDF(*names).select("*", shard_of(F.xxhash64(key)).alias(name)).toDF(*df.columns, name)


def write_shards(df: DataFrame, path: str, key_col: str, shards: int, name: str = "shard") -> None:
    """Whole rows as Parquet, one folder per shard.

    Every task writes to all shards; a hot key makes its shard large but no task.
    """
    with_shard(df, key_col, shards, name).write.partitionBy(name).parquet(path)


def shard_rows(df: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    """Where each row goes: its size and checksum, shard, place in it, and shard after growth.

    The rows, without their texts, are written once with their partition and
    their number among its rows of the shard. Places then need only the counts
    per partition and shard, so no shuffle moves rows and a hot key is spread
    over as many tasks as it was read by.
    """
    ship(df.sparkSession)
    rows = pick(df, id=id_col, text=text_col)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = rows.select(
        "id",
        F.xxhash64("id").alias("hash"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    schema = StructType(
        [
            StructField("id", type_of(df, id_col)),
            StructField("size", LongType()),
            StructField("text_crc32", LongType()),
            StructField("shard", IntegerType()),
            StructField("grown_shard", IntegerType()),
            StructField("part", IntegerType()),
            StructField("place", LongType()),
        ]
    )

    def run(batches):
        part = TaskContext.get().partitionId()
        seen = np.zeros(shards, dtype=np.int64)
        for batch in batches:
            keys = _unsigned(batch.column(1))
            shard, grown = jump_hash(keys, shards), jump_hash(keys, shards + 1)
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            before = np.cumsum(counts) - counts
            place = np.empty(len(keys), dtype=np.int64)
            place[order] = np.arange(len(keys)) - before[shard[order]] + seen[shard[order]]
            seen += counts
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    batch.column(3),
                    pa.array(shard, pa.int32()),
                    pa.array(grown, pa.int32()),
                    pa.array(np.full(len(keys), part), pa.int32()),
                    pa.array(place, pa.int64()),
                ],
                names=schema.names,
            )

    placed = staged(rows.mapInArrow(run, schema), "shards")
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    starts = counts.select(
        "shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    return placed.join(starts, ["shard", "part"]).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("before") + F.col("place")).alias("slot"),
        "grown_shard",
    )
