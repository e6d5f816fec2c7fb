"""Document fingerprints by winnowing, in DataFrame functions only.

Every run of ``GRAM`` code points of a text is hashed. Of each ``WINDOW``
neighbouring hashes the smallest is kept, the rightmost where several are equal,
with its position. So texts that share a passage of ``GRAM + WINDOW - 1`` code
points share a kept hash, wherever the passage stands, and nothing shorter than
``GRAM`` makes them alike.

Window minima are taken in steps: minima of 1, 4, 16, ... neighbours, each from
four of the step before. A hash and its position are one number during that,
the hash in its upper bits less the position, so the smallest number is the
rightmost smallest hash. Long texts are handled in blocks of
windows, whose arrays are all that is held at once beside text and result.

What a window keeps depends on its own code points alone. The fingerprint of a
text put together from two others is therefore made of theirs, with new windows
only where the parts meet (``joined``).

Results are defined as follows. A null text is an empty one and has no marks; a
text shorter than a gram has one, of the whole. Texts with fewer hashes than a
window keep the smallest of all. Equal texts have equal fingerprints. Rows are
ordered by id, null first, and by the hash of their text where ids are equal;
the row after the last is the first, and a single row follows itself. An empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import pick

#: Code points of a gram and hashes of a window; both together bound what is surely found.
GRAM = 20
WINDOW = 31
SURE = GRAM + WINDOW - 1
#: Windows handled together, and the bits that number the hashes of a block.
BLOCK = 1 << 16
POSITION_BITS = 17
HASH_MASK = (1 << 63) - (1 << POSITION_BITS)
#: Rows that are put in order together, the most such groups, and the keys drawn for each bound.
BUCKET_ROWS = 500
MAX_BUCKETS = 100_000
SAMPLES = 8

MARKS = T.ArrayType(
    T.StructType([T.StructField("pos", T.LongType()), T.StructField("hash", T.LongType())])
)


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body reads it.

    What a function of array elements reads beside them is computed again for
    each element, unless it is bound like this.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _widened(smallest: Column, steps: list[int]) -> Column:
    least = lambda x: F.transform(
        x, lambda v, i: F.least(v, *[F.get(x, i + j) for j in steps])
    )
    return _bound(smallest, least)


def _minima(hashes: Column) -> Column:
    """The smallest of the ``WINDOW`` numbers from each place on, fewer at the end."""
    span = 1
    while span < WINDOW:
        wider = min(4 * span, WINDOW)
        hashes = _widened(hashes, sorted({min(j * span, wider - span) for j in (1, 2, 3)}))
        span = wider
    return hashes


def _block(points: Column, grams: Column, windows: Column, block: Column) -> Column:
    """Marks of one block of windows, in order; ``points`` has four bytes per code point."""
    first = block * BLOCK
    last = F.least(first + (BLOCK + WINDOW - 1), grams)
    places = (1 << POSITION_BITS) - 1
    # A non-negative multiple of 2^POSITION_BITS less the number of the gram in its block.
    number = lambda at, i: F.xxhash64(F.substring(points, at, F.lit(4 * GRAM))).bitwiseAND(HASH_MASK) - i
    offsets = F.sequence(4 * first + 1, 4 * last - 3, F.lit(4))
    smallest = F.slice(
        _minima(F.transform(offsets, number)), F.lit(1), F.least(F.lit(BLOCK), windows - first)
    )
    return F.transform(
        F.array_distinct(smallest),
        lambda x: F.struct(
            ((-x).bitwiseAND(places) + first).alias("pos"), F.shiftright(x + places, POSITION_BITS).alias("hash")
        ),
    )


def _in_order(marks: Column) -> Column:
    """Marks by place, each once, from marks whose repeats are neighbours."""
    return _bound(
        marks, lambda m: F.filter(m, lambda x, i: (i == 0) | (F.get(m, i - 1)["pos"] != x["pos"]))
    )


def winnowed(text: Column) -> Column:
    """The marks of a whole text: kept hashes (46 bits) with their positions, ascending."""

    def of(text):
        n = F.length(text)
        grams = F.greatest(n - (GRAM - 1), F.lit(1))
        windows = F.greatest(grams - (WINDOW - 1), F.lit(1))
        last = F.floor((windows - 1) / BLOCK).cast("int")
        marks = lambda points, at: F.transform(
            F.sequence(F.lit(0), at["last"]), lambda b: _block(points, at["grams"], at["windows"], b)
        )
        sizes = F.struct(grams.alias("grams"), windows.alias("windows"), last.alias("last"))
        blocks = _bound(F.encode(text, "UTF-32"), lambda points: _bound(sizes, lambda at: marks(points, at)))
        # Neighbouring blocks may keep the same hash at their border.
        whole = _bound(
            blocks, lambda b: F.when(F.size(b) == 1, F.get(b, F.lit(0))).otherwise(_in_order(F.flatten(b)))
        )
        return F.when(n > 0, whole).otherwise(F.array().cast(MARKS))

    return _bound(F.coalesce(text, F.lit("")), of)


def _before(marks: Column, last: Column) -> Column:
    """Marks that windows starting at ``last`` or before keep.

    A mark is kept from the first window on that reaches it, if it is no larger
    than the mark before it, else from the window on that has left that one. So
    marks up to ``last`` are kept, and only those of the next window are in doubt.
    """

    def started(m, x, i, last):
        past = F.get(m, i - 1)
        start = F.when(
            (i == 0) | (x["hash"] <= past["hash"]), x["pos"] - (WINDOW - 1)
        ).otherwise(past["pos"] + 1)
        return (last >= 0) & (x["pos"] < last + WINDOW) & (start <= last)

    keep = lambda m, last: F.filter(
        m, lambda x, i: (x["pos"] <= last) | started(m, x, i, last)
    )
    return _bound(last, lambda last: _bound(marks, lambda m: keep(m, last)))


def _moved(marks: Column, by: Column) -> Column:
    move = lambda x, by: F.struct((x["pos"] + by).alias("pos"), x["hash"].alias("hash"))
    return _bound(by.cast("long"), lambda by: F.transform(marks, lambda x: move(x, by)))


def _appended(marks: Column, more: Column) -> Column:
    """Marks of earlier and of later windows: at most the last and the first are the same."""
    same = lambda a, b: F.get(a, F.size(a) - 1)["pos"] == F.get(b, F.lit(0))["pos"]
    return _bound(
        F.struct(marks.alias("a"), more.alias("b")),
        lambda s: F.concat(
            s["a"], F.when(same(s["a"], s["b"]), F.slice(s["b"], F.lit(2), F.size(s["b"]))).otherwise(s["b"])
        ),
    )


def joined(text: Column, marks: Column, kept: Column, other: Column, other_marks: Column, taken: Column) -> Column:
    """Marks of the first ``kept`` code points of a text and the first ``taken`` of another.

    ``marks`` and ``other_marks`` are those of the whole texts, which have so many.
    """
    start = F.greatest(kept - (SURE - 1), F.lit(0))
    around = F.concat(
        F.substring(text, start + 1, kept - start),
        F.substring(other, F.lit(1), F.least(taken, F.lit(SURE - 1))),
    )
    none = F.array().cast(MARKS)
    # Too short for a window of its own, unless it is all there is.
    across = _bound(
        around,
        lambda t: F.when((F.length(t) >= SURE) | (kept + taken < SURE), _moved(winnowed(t), start)).otherwise(none),
    )
    first = _appended(_before(marks, kept - SURE), across)
    return _appended(first, _moved(_before(other_marks, taken - SURE), kept))


def hashes_of(marks: Column) -> Column:
    return marks.getField("hash")


def likeness(some: Column, others: Column) -> Column:
    """Shared among all distinct hashes of two lists (0 to 1); 1 where both have none."""
    counts = F.struct(
        F.size(F.array_intersect(some, others)).alias("shared"), F.size(F.array_union(some, others)).alias("every")
    )
    return _bound(counts, lambda c: F.when(c["every"] == 0, 1.0).otherwise(c["shared"] / c["every"]))


def mark_digest(marks: Column) -> Column:
    """Hash and position of all marks, as one checksum."""
    lists = [F.array_join(marks.getField(c).cast("array<string>"), ",") for c in ("hash", "pos")]
    return F.sha2(F.concat_ws("@", *lists), 256)


def fingerprints(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row's id and the ``marks`` of its text. No shuffle."""
    rows = pick(df, id=id_col, text=text_col)
    return rows.select(F.col("id").alias(id_col), winnowed(F.col("text").cast("string")).alias("marks"))


def _bucketed(rows: DataFrame) -> DataFrame:
    """The rows with a bucket of neighbours, and the first row of each also as a guest of the one before.

    Bounds of the buckets are the smallest key and every ``SAMPLES``-th of the
    keys whose hash falls to a fraction that gives ``SAMPLES`` per bucket. They
    are gathered in a scalar subquery, by the one pass that looks at all keys.
    """
    key = F.struct("id", F.xxhash64("text").alias("hash"))
    count = rows.count()
    buckets = min(MAX_BUCKETS, max(1, math.ceil(count / BUCKET_ROWS)))
    drawn = F.pmod(F.xxhash64("key"), F.lit(max(1, count // (SAMPLES * buckets)))) == 0
    some = rows.select(key.alias("key")).agg(
        F.min("key").alias("least"), F.sort_array(F.collect_set(F.when(drawn, F.col("key")))).alias("keys")
    )
    further = F.filter("keys", lambda x, i: (i % SAMPLES == SAMPLES - 1) & (x > F.col("least")))
    bounds = some.select(F.concat(F.array("least"), further).alias("bounds")).scalar()
    # How many bounds are at most the key: a binary search, one column per step.
    found = rows.select("*", key.alias("key"), F.lit(-1).alias("bucket"))
    for step in [1 << i for i in reversed(range((2 * MAX_BUCKETS).bit_length()))]:
        further = F.get(bounds, F.col("bucket") + step) <= F.col("key")
        found = found.withColumn("bucket", F.when(further, F.col("bucket") + step).otherwise(F.col("bucket")))
    entry = lambda bucket, guest: F.struct(bucket.alias("bucket"), F.lit(guest).alias("guest"))
    before = F.pmod(F.col("bucket") - 1, F.size(bounds))
    places = F.when(
        F.col("key") == F.get(bounds, F.col("bucket")), F.array(entry(F.col("bucket"), 0), entry(before, 1))
    ).otherwise(F.array(entry(F.col("bucket"), 0)))
    return found.select(
        "id", "text", F.col("key.hash").alias("hash"), F.explode(places).alias("place")
    ).select("id", "text", "hash", "place.*")


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row's id, ``text`` and ``marks``, and ``next_text`` and ``next_marks`` of the row after it.

    Texts are shuffled once, into buckets of neighbours.
    """
    rows = pick(df, id=id_col, text=text_col).select(
        "id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    dealt = _bucketed(rows).repartition("bucket")
    marked = dealt.select("*", winnowed(F.col("text")).alias("marks"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("id").asc_nulls_first(), "hash")
    after = lambda c: F.lead(c).over(order).alias(f"next_{c}")
    return (
        marked.select("id", "text", "marks", "guest", after("text"), after("marks"))
        .where("guest = 0")
        .select(F.col("id").alias(id_col), "text", "marks", "next_text", "next_marks")
    )


def compare_edited(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how alike they and those of the next are.

    The edited text has the last half of the code points replaced by as many
    from the start of the next row's text, or by all of that if it has fewer.
    """
    pairs = with_next(df, id_col, text_col)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    taken = F.least(half, F.length("next_text"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    edited_marks = joined(F.col("text"), F.col("marks"), n - half, F.col("next_text"), F.col("next_marks"), taken)
    return pairs.select(
        id_col,
        n.cast("long").alias("n_chars"),
        edited.alias("edited"),
        "marks",
        edited_marks.alias("edited_marks"),
        "next_marks",
    ).select(
        id_col,
        "n_chars",
        "edited",
        "marks",
        "edited_marks",
        likeness(hashes_of(F.col("marks")), hashes_of(F.col("edited_marks"))).alias("near_edited"),
        likeness(hashes_of(F.col("marks")), hashes_of(F.col("next_marks"))).alias("near_next"),
    )
