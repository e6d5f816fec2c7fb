"""Helpers shared by the corpus operators.

Input columns are picked by exact name and position, so further columns, also
ones whose names clash with a result or differ only in case, do no harm: they
are never read and never returned, unless an operator says that it keeps rows.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Texts handled together inside a task, in characters; one longer text is a group of its own.
GROUP_CHARS = 2_000_000

#: Words are runs of anything but these six ASCII characters.
SPACES = b" \t\n\r\x0b\x0c"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under new names, whatever the others are called."""
    names = df.columns
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_{names.index(old)}").alias(new) for new, old in columns.items()])


def type_of(df: DataFrame, name: str) -> DataType:
    return df.schema.fields[df.columns.index(name)].dataType


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, once per application, as ``--py-files`` would.

    The archive is handed out by Spark; no executor reads the driver's folders.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


def bounded_groups(sizes: Iterable[int], limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes sum to at most ``limit``, one item at least."""
    start = total = i = 0
    for i, size in enumerate(sizes, 1):
        if total and total + size > limit:
            yield start, i - 1
            start, total = i - 1, 0
        total += size
    if i > start:
        yield start, i


def map_texts(
    df: DataFrame,
    id_col: str,
    text_col: str,
    results: list[StructField],
    start: Callable[[], Callable[[list[str | None]], list]],
) -> DataFrame:
    """One row per row of ``df``: its id and what a worker makes of its whole text.

    ``start`` is called once per task and gives the worker, which turns a list
    of texts into one list (or Arrow array) per result column.
    """
    if id_col in [field.name for field in results]:
        raise ValueError(f"the id column {id_col} has the name of a result")
    ship(df.sparkSession)
    schema = StructType([StructField(id_col, type_of(df, id_col)), *results])
    rows = pick(df, id=id_col, text=text_col).select("id", F.col("text").cast("string"))

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(field.dataType) for field in results]
        worker = start()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for low, high in bounded_groups(len(t) if t else 0 for t in texts):
                found = worker(texts[low:high])
                arrays = [
                    a if isinstance(a, pa.Array) else pa.array(a, type=k)
                    for a, k in zip(found, kinds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), *arrays], names=schema.names
                )

    return rows.mapInArrow(run, schema)
