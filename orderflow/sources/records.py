"""Records of CSV files whose fields may hold line breaks, found by many tasks at once.

A file is read in blocks, and no block can tell by itself whether it starts
within quotes. So each block is read for both cases: where it would end up, and
how many records would begin in it. Those few figures per block, taken in the
order of the file, tell the case of each block; then its lines are records,
save those of records over several lines, which alone are brought together.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow.session import staged

_BLOCK = "file string, start long"


def line_ends(sep: str = ",", quote: str = '"') -> tuple[re.Pattern, re.Pattern]:
    """What a line matches as a whole if no quotes are open at its end.

    The first is for lines that start outside of quotes, the second for those
    that start within. A quote opens a field only as its first character, two in
    a row stand for one, and what follows a closing quote belongs to the field.
    """
    s, q = re.escape(sep), re.escape(quote)
    rest = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}(?:(?!{s}).)*+"
    value = f"(?:{q}{rest}|(?!{q})(?:(?!{s}).)*+)"
    return (
        re.compile(f"{value}(?:{s}{value})*+", re.DOTALL),
        re.compile(f"{rest}(?:{s}{value})*+", re.DOTALL),
    )


def _walker(sep: str, quote: str):
    """Makes of Arrow batches of lines, block by block, their states for both cases.

    Gives ``walk(batches)``: tuples of a batch, its first line's number in the
    block, whether quotes are open before and after each line, and the number of
    records begun up to it, each for a block that starts outside and within.
    """
    outside, within = line_ends(sep, quote)

    def walk(batches):
        import numpy as np
        import pyarrow.compute as pc

        block, lines, state, begun = None, 0, [False, True], [0, 0]
        for batch in batches:
            files = batch.column(0).dictionary_encode()
            place = files.indices.to_numpy(zero_copy_only=False)
            starts = batch.column(1).to_numpy(zero_copy_only=False)
            changes = np.flatnonzero((np.diff(place) != 0) | (np.diff(starts) != 0)) + 1
            for low, high in zip([0, *changes], [*changes, len(place)]):
                if high == low:
                    continue
                key = files.dictionary[int(place[low])].as_py(), int(starts[low])
                if key != block:
                    block, lines, state, begun = key, 0, [False, True], [0, 0]
                part = batch.slice(low, high - low)
                has_quote = pc.match_substring(part.column(2), quote)
                quoted = np.flatnonzero(has_quote.to_numpy(zero_copy_only=False))
                texts = part.column(2).filter(has_quote).to_pylist()
                before = np.empty((2, high - low), bool)
                after = np.empty((2, high - low), bool)
                for case in (0, 1):
                    now, done = state[case], 0
                    for i, text in zip(quoted, texts):
                        before[case, done : i + 1] = now
                        after[case, done:i] = now
                        now = (within if now else outside).fullmatch(text) is None
                        after[case, i] = now
                        done = i + 1
                    before[case, done:] = after[case, done:] = now
                    state[case] = now
                count = np.cumsum(~before, axis=1) + np.array(begun)[:, None]
                begun = [int(n) for n in count[:, -1]]
                yield block, part, lines, before, after, count
                lines += high - low

    return walk


def _summaries(lines: DataFrame, sep: str, quote: str) -> DataFrame:
    """One row per block: its end and number of records for both cases, and the file's header."""
    walk = _walker(sep, quote)
    schema = f"{_BLOCK}, end0 boolean, end1 boolean, n0 long, n1 long, header string"

    def run(batches):
        import pyarrow as pa

        def row(block, found, first, closed):
            # A header that its block does not end is refused by the reader.
            header = "\n".join(first) if closed else None
            return pa.RecordBatch.from_pylist([{
                "file": block[0], "start": block[1], "end0": bool(found[0][0]), "end1": bool(found[0][1]),
                "n0": int(found[1][0]), "n1": int(found[1][1]), "header": header,
            }], schema=kinds)

        kinds = pa.schema([
            ("file", pa.string()), ("start", pa.int64()), ("end0", pa.bool_()), ("end1", pa.bool_()),
            ("n0", pa.int64()), ("n1", pa.int64()), ("header", pa.string()),
        ])
        last = found = None
        first, closed = [], False
        for block, part, _, _, after, count in walk(batches):
            if block != last and last is not None:
                yield row(last, found, first, closed)
            if block != last:
                first, closed = [], block[1] != 0
            if not closed:
                ends = (~after[0]).nonzero()[0]
                upto = int(ends[0]) + 1 if len(ends) else part.num_rows
                first += part.column(2).slice(0, upto).to_pylist()
                closed = bool(len(ends))
            last, found = block, (after[:, -1], count[:, -1])
        if last is not None:
            yield row(last, found, first, closed)

    return lines.mapInArrow(run, schema)


def _cases(summaries: DataFrame) -> DataFrame:
    """For each block whether it starts within quotes, and which record its first lines go on with.

    A block maps the state at its start to that at its end. It either fixes it,
    keeps it or swaps it, so the state is what the last fixing block left, swapped
    as often as blocks since then swap. One row per block, ordered within a file.
    """
    order = Window.partitionBy("file").orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum((F.col("end0") & ~F.col("end1")).cast("int"))
    fixed = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").cast("int").alias("to"), "swapped"))
    counted = summaries.withColumn(
        "swapped", swaps.over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    known = counted.select(
        "*",
        F.last(fixed, ignorenulls=True).over(earlier).alias("base"),
        F.coalesce(F.max("swapped").over(earlier), F.lit(0)).alias("now"),
    )
    none = F.lit(0)
    state = (F.coalesce("base.to", none) + F.col("now") - F.coalesce("base.swapped", none)) % 2 == 1
    begun = known.withColumn("open", state).withColumn("n", F.when(F.col("open"), F.col("n1")).otherwise(F.col("n0")))
    owner = F.when(F.col("n") > 0, F.struct("start", "n"))
    return begun.select(
        "file", "start", "open",
        F.last(owner, ignorenulls=True).over(earlier).alias("owner"),
        F.first("header").over(order).alias("header"),
    )


class CsvRecords(NamedTuple):
    """``rows``: ``file``, ``start``, ``record``, ``header``, ``value``; ``headers``: one per ``file``."""

    rows: DataFrame
    headers: DataFrame


def csv_lines_of_records(
    spark: SparkSession, path: str, sep: str = ",", quote: str = '"', **listing: object
) -> CsvRecords:
    """The records of CSV files as text, as ``value``.

    ``start`` and ``record`` order the records of a file, ``header`` is its first
    record, which is not among the rows. Records end with a line feed, with or
    without a carriage return before it. Lines of blanks only are left out, quotes
    never closed take what is left of the file, and empty files have no rows.

    Two passes over the text, in as many tasks as it has blocks; between them a
    table with one row per block. Only lines of records over several lines are shuffled.
    """
    lines = spark.read.options(**listing).option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    blocks = staged(_cases(_summaries(lines, sep, quote)), "blocks")
    walk = _walker(sep, quote)
    schema = (
        f"{_BLOCK}, value string, line long, before0 boolean, before1 boolean, "
        "after0 boolean, after1 boolean, count0 long, count1 long"
    )

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["file", "start", "value", "line", "before0", "before1", "after0", "after1", "count0", "count1"]
        for _, part, first, before, after, count in walk(batches):
            number = np.arange(first, first + part.num_rows)
            found = [number, *before, *after, *count]
            yield pa.RecordBatch.from_arrays([*part.columns, *map(pa.array, found)], names=names)

    def of_case(name):
        return F.when(F.col("open"), F.col(f"{name}1")).otherwise(F.col(f"{name}0")).alias(name)

    # Blocks are cut alike in both passes unless the session's size changed between
    # them. One whose start the first pass did not see would be read wrongly.
    changed = F.raise_error(F.lit("blocks of a CSV file changed between two reads; read it again"))
    same = F.coalesce("open", changed.cast("boolean"))
    marked = lines.mapInArrow(run, schema).join(blocks, ["file", "start"], "left").withColumn("open", same)
    found = marked.select(
        "file", "start", "line", "header", "value", "owner", of_case("before"), of_case("after"), of_case("count")
    )
    # Lines before a block's first record belong to the last one of an earlier block.
    continued = F.col("count") == 0
    keyed = found.select(
        "file",
        F.when(continued, F.col("owner.start")).otherwise(F.col("start")).alias("start"),
        F.when(continued, F.col("owner.n")).otherwise(F.col("count")).alias("record"),
        "header",
        "value",
        F.struct(F.col("start").alias("block"), "line", "value").alias("piece"),
        (F.col("before") | F.col("after")).alias("several"),
    )
    single = keyed.where(~F.col("several")).select("file", "start", "record", "header", "value")
    pieces = F.array_sort(F.collect_list("piece"))
    joined = (
        keyed.where("several")
        .groupBy("file", "start", "record", "header")
        .agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "\n").alias("value"))
    )
    records = single.unionAll(joined).where("start > 0 or record > 1")
    text = F.regexp_replace("value", "\r$", "")
    rows = records.withColumn("value", text).where(F.trim(F.col("value")) != "")
    return CsvRecords(rows, blocks.where("start = 0").select("file", "header"))
