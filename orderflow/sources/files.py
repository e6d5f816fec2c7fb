"""Transactions from CSV, JSON and newline-delimited JSON files."""

from __future__ import annotations

import csv
import io
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from orderflow.functions.display import DISPLAY_SOURCES, to_display
from orderflow.schema import RAW_SCHEMA
from orderflow.session import path_exists
from orderflow.sources.records import csv_lines_of_records

# Keys of a JSON object that wraps a list of transactions, in
# the order they are tried.
WRAPPER_KEYS = ("transactions", "recent_transactions")

#: Text of a row that could not be read, null for the others, as Spark's readers name it.
CORRUPT = "_corrupt_record"
_UNREAD = [StructField("message", StringType()), StructField("corrupt", BooleanType())]
# Without pruning a row's fate does not depend on the columns a query uses.
_CSV_OPTIONS = {"header": True, "escape": '"', "enforceSchema": False, "columnPruning": False}

# Reader options under which only Spark's reader of whole files finds the records.
_SPLIT_BY_READER = {"escape", "comment", "encoding", "charset", "linesep", "header", "delimiter"}

# Reader options that say which files there are.
_LISTING = ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter")


def _of_each_file(rows: DataFrame) -> list[Row]:
    """The one row of each file, with its name and header, in order."""
    return sorted(rows.collect())


def csv_headers(spark: SparkSession, path: str, **options: object) -> dict[tuple[str, ...], list[str]]:
    """The files of a CSV data set by the column names in their first lines.

    Reads the first block of each file; distinct headers and file names, which
    the driver lists anyway, are all that is gathered.
    """
    sep = str(options.get("sep", ","))
    listed = {name: value for name, value in options.items() if name in _LISTING}
    lines = spark.read.options(**listed).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    # Lines of a block come in order, so its first one is the file's.
    first = lines.where("start = 0").groupBy("file").agg(F.first("value").alias("line"))
    files: dict[tuple[str, ...], list[str]] = {}
    for row in _of_each_file(first):
        header = next(csv.reader([row.line.lstrip("\ufeff")], delimiter=sep), [])
        files.setdefault(tuple(header), []).append(unquote(row.file))
    return files


def field(name: str) -> Column:
    """The column of exactly that name, whatever characters it has."""
    return F.col(f"`{name.replace('`', '``')}`")


def _csv_schema(header: list[str], typed: bool) -> StructType:
    """Reading schema in header order; as text what is unknown, or all."""
    known = {field.name: field for field in RAW_SCHEMA} if typed else {}
    fields = [known.get(name, StructField(name, StringType())) for name in header]
    return StructType([*fields, StructField(CORRUPT, StringType())])


def _csv_parts(
    spark: SparkSession,
    path: str,
    streaming: bool,
    header: list[str] | None,
    quoted_lines: bool,
    options: dict,
    typed: bool,
) -> list[DataFrame]:
    """The rows of a CSV data set, one frame per header found."""
    reader = spark.readStream if streaming else spark.read
    if quoted_lines and not streaming and _SPLIT_BY_READER.isdisjoint(name.lower() for name in options):
        return _quoted_parts(spark, path, header, options, typed)
    if header or streaming:
        found = {tuple(header or RAW_SCHEMA.names): path}
    elif quoted_lines:
        whole = spark.read.options(**{**_CSV_OPTIONS, "multiLine": True, **options}).csv(path).columns
        found = {tuple(whole): path} if whole else {}
    else:
        found = csv_headers(spark, path, **options)
    chosen = {**_CSV_OPTIONS, "multiLine": quoted_lines, **options}
    return [
        reader.schema(_csv_schema(list(names), typed)).options(**chosen).csv(files)
        for names, files in found.items()
    ]


def _quoted_parts(
    spark: SparkSession, path: str, header: list[str] | None, options: dict, typed: bool
) -> list[DataFrame]:
    """The rows of CSV files with line breaks in quotes, one frame per header found."""
    listed = {name: value for name, value in options.items() if name in _LISTING}
    sep, quote = str(options.get("sep", ",")), str(options.get("quote", '"'))
    records = csv_lines_of_records(spark, path, sep, quote, **listed)

    def names_of(text: str) -> tuple[str, ...]:
        text = text.removeprefix("\ufeff").removesuffix("\r")
        return tuple(next(csv.reader(io.StringIO(text, newline=""), delimiter=sep, quotechar=quote), []))

    texts: dict[tuple[str, ...], list[str]] = {}
    for row in _of_each_file(records.headers):
        if row.header is None:
            raise ValueError(f"the first line of {unquote(row.file)} has quotes that its block does not close")
        texts.setdefault(names_of(row.header), []).append(row.header)
    if header and set(texts) - {tuple(header)}:
        raise ValueError(f"files below {path} have other headers than {header}")
    chosen = {"escape": quote, **{n: v for n, v in options.items() if n not in _LISTING}, "multiLine": True}
    chosen = {name: str(value).lower() if isinstance(value, bool) else str(value) for name, value in chosen.items()}
    parts = []
    for names, alike in texts.items():
        schema = _csv_schema(list(names), typed)
        own = records.rows if len(texts) == 1 else records.rows.where(F.col("header").isin(sorted(set(alike))))
        record = F.from_csv("value", schema.toDDL(), {**chosen, "columnNameOfCorruptRecord": CORRUPT})
        # As a generator of one row, the parser runs once per record.
        parts.append(own.select(F.inline(F.array(record))))
    return parts


def _raw_columns(df: DataFrame) -> list[Column]:
    """The raw fields by name; one the files lack becomes null."""
    present = set(df.columns)
    return [
        F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
        for f in RAW_SCHEMA
    ]


def _unread(rows: DataFrame) -> list[Column]:
    """Text of an unreadable row as ``message``, and whether the row is one as ``corrupt``."""
    # The reader converts, and so finds fault with, only the fields a query asks
    # for; the text therefore asks for all that have to be converted, and for one at least.
    kinds = {f.name: f.dataType for f in rows.schema if f.name != CORRUPT}
    typed = [name for name, kind in kinds.items() if kind != StringType()] or list(kinds)[:1]
    seen = F.coalesce(*[F.col(f"`{name}`").cast("string") for name in typed], F.col(CORRUPT))
    text = F.when(seen.isNotNull(), F.col(CORRUPT))
    return [text.alias("message"), text.isNotNull().alias("corrupt")]


def _read_csv(spark: SparkSession, *how) -> DataFrame:
    parts = [rows.select(*_raw_columns(rows), *_unread(rows)) for rows in _csv_parts(spark, *how, True)]
    if not parts:
        return spark.createDataFrame([], StructType([*RAW_SCHEMA, *_UNREAD]))
    return reduce(DataFrame.unionAll, parts)


def read_csv_records(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    header: list[str] | None = None,
    quoted_lines: bool = False,
    **options: object,
) -> DataFrame:
    """All fields of CSV files as text, known or not, and the text of unreadable rows in ``CORRUPT``.

    Files may have different headers; a field that a file lacks is null in its
    rows. An empty field is null, too.
    """
    parts = _csv_parts(spark, path, streaming, header, quoted_lines, options, False)
    if not parts:
        return spark.createDataFrame([], _csv_schema(RAW_SCHEMA.names, False))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.select(*[field(c) for c in rows.columns if c != CORRUPT], CORRUPT)


def _read_json(
    spark: SparkSession, path: str, streaming: bool, multiline: bool, options: dict
) -> DataFrame:
    record = StructType(list(RAW_SCHEMA))
    wrapped = StructType(
        [
            *record,
            *[StructField(key, ArrayType(record)) for key in WRAPPER_KEYS],
            StructField(CORRUPT, StringType()),
        ]
    )
    reader = spark.readStream if streaming else spark.read
    rows = reader.schema(wrapped).options(multiLine=multiline, **options).json(path)
    itself = F.array(F.struct(*RAW_SCHEMA.names))
    records = F.coalesce(
        *[F.when(F.size(key) > 0, F.col(key)) for key in WRAPPER_KEYS], itself
    )
    return rows.select(F.inline(records), *_unread(rows))


def read_transactions_files(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    streaming: bool = False,
    header: list[str] | None = None,
    quoted_lines: bool = False,
    **options: object,
) -> DataFrame:
    """Raw transactions from files; unreadable rows are ``corrupt``, with their text in ``message``.

    ``fmt`` is ``csv``, ``ndjson`` (one object per line) or ``json`` (whole
    files: a list, an object wrapping a list, or a single object). CSV columns
    go by the header names of each file, which may differ; a stream of CSV files
    takes them from ``header``, by default the raw field order, and fails on
    other headers, as do files read with a given ``header``.
    Line breaks within quotes make a row corrupt, unless ``quoted_lines`` is
    set: then record starts are found first (see ``sources.records``), by as many
    tasks as the files have blocks. A stream, or an ``escape``, ``comment``,
    ``encoding`` or ``lineSep`` of its own, keeps such a file in one task. Whole-file JSON
    cannot be split, so large data belongs into the others. An empty CSV file has no rows.
    """
    if fmt == "csv":
        return _read_csv(spark, path, streaming, header, quoted_lines, options)
    if fmt in ("json", "ndjson"):
        return _read_json(spark, path, streaming, fmt == "json", options)
    raise ValueError(f"unknown transaction file format: {fmt!r}")


def json_value(text: Column) -> Column:
    """The JSON value that a text consists of; null where it is none, or more than one.

    The parser takes the first value of a text and leaves the rest. Inside of
    brackets and braces alike, nothing can follow the value unseen.
    """
    alone = F.try_variant_get(
        F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>"
    )
    also = F.try_parse_json(F.concat(F.lit('{"value":'), text, F.lit("}")))
    return F.when((F.size(alone) == 1) & also.isNotNull(), F.get(alone, F.lit(0)))


def _recent_json(spark: SparkSession, path: str) -> DataFrame:
    """Items of a JSON file with their position, fields as text under any known name.

    A file that is no single JSON value is taken as one value per line, and
    lines that are none are passed over.
    """
    whole = spark.read.text(path, wholetext=True).select("value", json_value(F.col("value")).alias("whole"))

    def items(inner: str) -> Column:
        return F.try_variant_get("whole", inner, "array<variant>")

    lists = [F.when(F.size(items(f"$.{key}")) > 0, items(f"$.{key}")) for key in WRAPPER_KEYS]
    lines = F.filter(
        F.transform(F.split("value", "\\r?\\n"), json_value), lambda item: item.isNotNull()
    )
    found = F.when(F.col("whole").isNull(), lines).otherwise(
        F.coalesce(items("$"), *lists, F.array("whole"))
    )
    names = sorted({name for group in DISPLAY_SOURCES.values() for name in group})
    return whole.select(F.posexplode(found).alias("position", "item")).select(
        F.col("position").alias("place"),
        *[F.try_variant_get("item", f"$.{name}", "string").alias(name) for name in names],
    )


def recent_from_file(
    spark: SparkSession, path: str, fmt: str = "json", n: int = 20
) -> DataFrame:
    """The last ``n`` transactions of a file in display columns, last one first.

    Takes the formats of ``read_transactions_files`` and every field name the
    display knows. No rows where there is no file.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], to_display(spark.range(0)).schema)
    if fmt == "json":
        rows = _recent_json(spark, path)
    else:
        # Rows of one file block come in order, blocks go by their offset.
        place = F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        )
        if fmt == "csv":
            rows = spark.read.options(header=True, escape='"').csv(path)
        else:
            rows = spark.read.json(path, primitivesAsString=True)
        rows = rows.select("*", place.alias("place"))
    return to_display(rows.orderBy(F.col("place").desc()).limit(n))
