"""Exact centroid clustering of integer vectors with heap-ordered bounds.

Vectors lie in blocks, each a row of a table: ids, components, and per cluster a
heap of its vectors. A vector enters the heap of its cluster by its gap: how
much nearer its own centroid is than any other. When centroids move, the gaps of
a cluster shrink by its centroid's drift and the largest drift of the others at
most. That is not taken off each gap but added to the cluster's offset, and a
gap enters with the offset of its time on top. So only vectors whose entry the
offset has reached are popped and measured against all centroids again, and a
cluster whose top has not expired is not looked at.

A round is one pass over the blocks that writes them with their new heaps and
with their sums per cluster. What comes to the driver are the sums of all
blocks: clusters times components, whatever the number of vectors. Centroids,
distances and sums are integers; bounds are floating point with a margin that
exceeds their rounding, so ties and results are exact.

Results are defined as follows. Vectors of another length, or with a null or
non-finite component, are not kept and not returned. A null id is hashed as no
digits; rows of one id are vectors of their own, and equal ones end up together.
With fewer vectors than clusters there are as many clusters as vectors. An empty
table, or one without a kept vector, gives an empty result. Further columns are
ignored. A component beyond 2^27 after scaling is an error: distances no longer
fit into 64 bits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import pick, ship, type_of
from orderflow.session import delete_path, new_folder, staged

#: Vectors of a block.
BLOCK = 2048
#: Largest component, so that squared distances and their sums per block fit into 64 bits.
LARGEST = 1 << 27
#: Gaps this close to used up count as expired. Distances are below 2^32, where
#: a double is exact to 2^-21; this covers the rounding of any number of rounds
#: up to thousands.
MARGIN = 0.01


@dataclass
class Centroids:
    """Where the centroids are, and per cluster what its gaps have lost so far."""

    places: np.ndarray
    offsets: np.ndarray = field(default=None)

    def __post_init__(self):
        if self.offsets is None:
            self.offsets = np.zeros(len(self.places))

    def moved(self, sums: list[list[int]], counts: list[int]) -> Centroids:
        """Every non-empty cluster's centroid at the floor of its mean."""
        places = self.places.copy()
        for c, count in enumerate(counts):
            if count:
                places[c] = [total // count for total in sums[c]]
        drift = np.sqrt(((places - self.places) ** 2).sum(axis=1).astype(np.float64))
        others = np.array([max(np.delete(drift, c), default=0.0) for c in range(len(drift))])
        return Centroids(places, self.offsets + drift + others)

    def measured(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest cluster (the first of several), its squared distance, and the gap to the next."""
        distances = np.empty((len(vectors), len(self.places)), dtype=np.int64)
        for c, place in enumerate(self.places):
            distances[:, c] = ((vectors - place) ** 2).sum(axis=1)
        nearest = distances.argmin(axis=1)
        rows = np.arange(len(vectors))
        least = distances[rows, nearest]
        distances[rows, nearest] = np.iinfo(np.int64).max
        second = distances.min(axis=1) if len(self.places) > 1 else np.full(len(vectors), np.inf)
        return nearest, least, np.sqrt(second) - np.sqrt(least)


class Block:
    """Vectors with a heap of (gap and offset, row) per cluster, and sums per cluster."""

    def __init__(self, vectors: np.ndarray, heaps: list, sums: np.ndarray):
        self.vectors, self.heaps, self.sums = vectors, heaps, sums

    @staticmethod
    def new(vectors: np.ndarray, centroids: Centroids) -> Block:
        k = len(centroids.places)
        block = Block(vectors, [([], []) for _ in range(k)], np.zeros((k, vectors.shape[1]), dtype=np.int64))
        block.enter(np.arange(len(vectors)), centroids)
        return block

    def enter(self, rows: np.ndarray, centroids: Centroids) -> None:
        """Measure these rows and put each on the heap of its cluster."""
        nearest, _, gaps = centroids.measured(self.vectors[rows])
        keys = gaps + centroids.offsets[nearest]
        for c in np.unique(nearest):
            mine = nearest == c
            heap = self.heap(c)
            entries = list(zip(keys[mine].tolist(), rows[mine].tolist()))
            if len(entries) > len(heap):
                heap += entries
                heapq.heapify(heap)
            else:
                for entry in entries:
                    heapq.heappush(heap, entry)
            self.put(c, heap)
            self.sums[c] += self.vectors[rows[mine]].sum(axis=0)

    def heap(self, c: int) -> list[tuple[float, int]]:
        keys, rows = self.heaps[c]
        return list(zip(keys, rows)) if isinstance(keys, list) else list(zip(keys.tolist(), rows.tolist()))

    def put(self, c: int, heap: list[tuple[float, int]]) -> None:
        self.heaps[c] = ([e[0] for e in heap], [e[1] for e in heap])

    def step(self, centroids: Centroids) -> int:
        """Pop what has expired, measure it again; how many vectors that were."""
        popped = []
        for c, offset in enumerate(centroids.offsets.tolist()):
            keys, _ = self.heaps[c]
            if not len(keys) or keys[0] > offset + MARGIN:
                continue
            heap, out = self.heap(c), []
            while heap and heap[0][0] <= offset + MARGIN:
                out.append(heapq.heappop(heap)[1])
            self.put(c, heap)
            self.sums[c] -= self.vectors[out].sum(axis=0)
            popped += out
        if popped:
            self.enter(np.array(popped), centroids)
        return len(popped)

    def assigned(self) -> np.ndarray:
        cluster = np.empty(len(self.vectors), dtype=np.int64)
        for c, (_, rows) in enumerate(self.heaps):
            cluster[np.asarray(rows, dtype=np.int64)] = c
        return cluster


def _stored(block: Block) -> list:
    """A block as values of a row: components in as few bytes as hold them."""
    small = not len(block.vectors) or np.abs(block.vectors).max() < 1 << 15
    kind = "<i2" if small else "<i4"
    counts = [len(keys) for keys, _ in block.heaps]
    keys = np.concatenate([np.asarray(k, dtype="<f8") for k, _ in block.heaps])
    rows = np.concatenate([np.asarray(r, dtype="<i4") for _, r in block.heaps])
    return [
        block.vectors.astype(kind).tobytes(), 2 if small else 4, keys.tobytes(), rows.tobytes(), counts,
        block.sums.ravel().tolist(),
    ]


def _loaded(vectors: bytes, width: int, keys: bytes, rows: bytes, counts: list[int], sums: list[int]) -> Block:
    totals = np.array(sums, dtype=np.int64).reshape(len(counts), -1)
    held = np.frombuffer(vectors, dtype=f"<i{width}").reshape(-1, totals.shape[1]).astype(np.int64)
    ends = np.cumsum(counts)[:-1]
    heaps = list(zip(np.split(np.frombuffer(keys, "<f8"), ends), np.split(np.frombuffer(rows, "<i4"), ends)))
    return Block(held, heaps, totals)


BLOCK_FIELDS = [
    T.StructField("vectors", T.BinaryType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("keys", T.BinaryType()),
    T.StructField("rows", T.BinaryType()),
    T.StructField("counts", T.ArrayType(T.LongType())),
    T.StructField("sums", T.ArrayType(T.LongType())),
    T.StructField("measured", T.LongType()),
]
_KINDS = [pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64()]


def kept_vectors(df: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """Ids and integer components of the vectors that have all of them, as ``id`` and ``vec``."""
    rows = pick(df, id=id_col, vec=vec_col).withColumn("vec", F.col("vec").cast("array<double>"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return rows.where((F.size("vec") == dims) & F.forall("vec", sound)).select(
        "id", F.transform("vec", lambda x: F.floor(x * scale)).alias("vec")
    )


def _first(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    number = F.coalesce(F.col("id").cast("string"), F.lit(""))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), number), 256)
    return np.array([r.vec for r in vectors.orderBy(order, "vec").limit(clusters).collect()], dtype=np.int64)


def _blocks(vectors: DataFrame, centroids: Centroids, schema: T.StructType) -> DataFrame:
    dims = centroids.places.shape[1]

    def run(batches):
        for batch in batches:
            held = pc.list_flatten(batch.column(1)).to_numpy(zero_copy_only=False).reshape(-1, dims)
            if len(held) and np.abs(held).max() > LARGEST:
                raise ArithmeticError(f"a component exceeds {LARGEST} after scaling")
            for low in range(0, len(held), BLOCK):
                part = held[low : low + BLOCK]
                ids = batch.column(0).slice(low, len(part))
                block = Block.new(part, centroids)
                yield _row([pa.array([ids.to_pylist()], pa.list_(ids.type))], [_stored(block) + [len(part)]], schema)

    return vectors.mapInArrow(run, schema)


def _row(ids: list[pa.Array], values: list[list], schema: T.StructType) -> pa.RecordBatch:
    columns = [pa.array(list(c), k) for c, k in zip(zip(*values), _KINDS)]
    return pa.RecordBatch.from_arrays([*ids, *columns], names=schema.names)


def _each(batches) -> Iterator[tuple[pa.Array, Block]]:
    """The stored blocks one by one, with their ids."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0).slice(i, 1), _loaded(*[batch.column(j)[i].as_py() for j in range(1, 7)])


def _stepped(blocks: DataFrame, centroids: Centroids) -> DataFrame:
    schema = blocks.schema

    def run(batches):
        for ids, block in _each(batches):
            measured = block.step(centroids)
            yield _row([ids], [_stored(block) + [measured]], schema)

    return blocks.mapInArrow(run, schema)


def _placed(blocks: DataFrame, centroids: Centroids, id_type: T.DataType) -> DataFrame:
    """One row per vector, after a last step."""
    schema = T.StructType(
        [T.StructField("id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]
    )

    def run(batches):
        for ids, block in _each(batches):
            block.step(centroids)
            cluster = block.assigned()
            far = ((block.vectors - centroids.places[cluster]) ** 2).sum(axis=1)
            columns = [ids.flatten(), pa.array(cluster, pa.int32()), pa.array(far, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return blocks.mapInArrow(run, schema)


def _totals(blocks: DataFrame, clusters: int) -> tuple[list[list[int]], list[int]]:
    """Sums and counts per cluster over all blocks, added up before they meet."""
    both = lambda c: blocks.select(F.posexplode(c).alias("at", "n")).groupBy("at").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    sums, counts = ({r["at"]: int(r["n"]) for r in both(c).collect()} for c in ("sums", "counts"))
    dims = len(sums) // clusters
    return [[sums[c * dims + i] for i in range(dims)] for c in range(clusters)], [counts[c] for c in range(clusters)]


def cluster_vectors(
    df: DataFrame,
    id_col: str,
    vec_col: str,
    clusters: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
) -> tuple[DataFrame, list[list[int]]]:
    """Id, cluster and squared distance of every kept vector, and the final centroids.

    The first centroids are the vectors whose hash of seed and id is smallest.
    The blocks of a round are removed once those of the next are written.
    """
    spark = ship(df.sparkSession)
    id_type = type_of(df, id_col)
    vectors = kept_vectors(df, id_col, vec_col, dims, scale)
    first = _first(vectors, clusters, seed)
    if not len(first):
        empty = T.StructType([T.StructField(id_col, id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
        return spark.createDataFrame([], empty), []
    centroids = Centroids(first)
    schema = T.StructType([T.StructField("ids", T.ArrayType(id_type)), *BLOCK_FIELDS])
    path, blocks = _written(spark, _blocks(vectors, centroids, schema))
    for turn in range(rounds):
        centroids = centroids.moved(*_totals(blocks, len(first)))
        if turn < rounds - 1:
            old = path
            path, blocks = _written(spark, _stepped(blocks, centroids))
            delete_path(spark, old)
    placed = staged(_placed(blocks, centroids, id_type), "clusters")
    delete_path(spark, path)
    return placed.withColumnRenamed("id", id_col), centroids.places.tolist()


def _written(spark: SparkSession, blocks: DataFrame) -> tuple[str, DataFrame]:
    path = new_folder(spark, "blocks")
    blocks.write.parquet(path)
    return path, spark.read.schema(blocks.schema).parquet(path)


def with_inertia(placed: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The rows with the summed distance of their cluster and of all, and their centroid's components.

    Beside the rows there is one row per cluster, which is all that is broadcast.
    """
    spark = placed.sparkSession
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()
    total = sum(int(r["n"]) for r in sums)
    rows = [(r["cluster"], int(r["n"]), total, centroids[r["cluster"]]) for r in sums]
    stats = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return placed.join(F.broadcast(stats), "cluster")
