"""Fill-in-middle transformation over a compressed set of unit boundaries.

A text falls into units, lines by default, and is cut at two of their
boundaries into prefix, middle and suffix, which come out in another order with
a mark before each. Where the boundaries lie is kept as a set of offsets in
containers of 65,536 places each: a sorted array where they are few, a bitmap
where they are many, runs where they follow each other. The cumulative
cardinalities of the containers lead from the number of a boundary to its
container, and a select within that gives its offset. One set serves a group of
texts laid end to end, so all cuts of the group are looked up together.

All draws come from a hash of seed and id, so a row that runs again is cut alike.

Results are defined as follows. A null text is an empty one; empty texts and
texts that hold a mark stay as they are (form ``plain``). A null id is hashed
as no digits. Rows of one id draw the same numbers, and equal rows give equal
rows. Offsets are in code points of whole texts of any length. An empty table
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderflow.llm.common import bounded_groups, pick, ship, type_of

#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: Places of a container, and the bytes of its bitmap.
PLACES = 1 << 16
BITMAP_BYTES = PLACES // 8


class ArrayContainer:
    """Few places: a sorted list of them."""

    def __init__(self, places: np.ndarray):
        self.places = places.astype(np.uint16)

    @staticmethod
    def size(places: np.ndarray, runs: int) -> int:
        return 2 * len(places)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        return self.places[ranks].astype(np.int64)


class BitmapContainer:
    """Many places: a bit for each, and the bits before each word."""

    def __init__(self, places: np.ndarray):
        bits = np.zeros(PLACES, dtype=np.uint8)
        bits[places] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    @staticmethod
    def size(places: np.ndarray, runs: int) -> int:
        return BITMAP_BYTES

    def select(self, ranks: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, ranks, "right") - 1
        bits = np.unpackbits(self.words[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        passed = np.cumsum(bits, axis=1) > (ranks - self.before[word])[:, None]
        return word * 64 + np.argmax(passed, axis=1)


class RunContainer:
    """Places that follow each other: the first of each run, and the places before it."""

    def __init__(self, places: np.ndarray):
        first = np.flatnonzero(np.diff(places, prepend=-2) != 1)
        self.starts, self.before = places[first], first

    @staticmethod
    def size(places: np.ndarray, runs: int) -> int:
        return 2 + 4 * runs

    def select(self, ranks: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, ranks, "right") - 1
        return self.starts[run] + ranks - self.before[run]


CONTAINERS = (ArrayContainer, BitmapContainer, RunContainer)


class BoundarySet:
    """Ascending distinct offsets, each container in the form that takes least room."""

    def __init__(self, offsets: np.ndarray):
        self.keys, first = np.unique(offsets >> 16, return_index=True)
        ends = np.append(first[1:], len(offsets))
        self.containers = []
        for low, high in zip(first, ends):
            places = offsets[low:high] & (PLACES - 1)
            runs = int(np.count_nonzero(np.diff(places) != 1)) + 1
            kind = min(CONTAINERS, key=lambda c: c.size(places, runs))
            self.containers.append(kind(places))
        #: Offsets before each container, and after the last.
        self.before = np.append(first, len(offsets))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The offsets of the given ranks, 0 for the smallest offset."""
        ranks = np.asarray(ranks, dtype=np.int64)
        found = np.empty(len(ranks), dtype=np.int64)
        holder = np.searchsorted(self.before, ranks, "right") - 1
        for k in np.unique(holder):
            here = np.flatnonzero(holder == k)
            local = self.containers[k].select(ranks[here] - self.before[k])
            found[here] = (int(self.keys[k]) << 16) + local
        return found


def line_ends(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the lines of texts laid end to end, and the lines of each text.

    A line ends behind its line break; what stands behind the last one is a line, too.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    breaks = np.flatnonzero(points == 10) + 1
    offsets = np.union1d(breaks, ends[ends > 0])
    upto = np.searchsorted(offsets, ends, "right")
    return offsets, np.diff(upto, prepend=0)


@dataclass(frozen=True)
class Settings:
    """Seed of the draws, and in percent the rate of rows cut and of those in ``spm`` form."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    marks: tuple[str, str, str] = MARKS


def cut_texts(texts: list[str], draws: np.ndarray, settings: Settings) -> list[list]:
    """Units, form, prefix and middle lengths and output of each text.

    ``draws`` has four numbers per text: for either cut, for whether to cut, and for the form.
    """
    offsets, units = line_ends(texts)
    marked = np.array([any(m in t for m in settings.marks) for t in texts], dtype=bool)
    plain = (units == 0) | marked | (draws[:, 2] % 100 >= settings.rate)
    cuts = np.sort(draws[:, :2] % (units[:, None] + 1), axis=1)
    before = np.cumsum(units) - units
    starts = np.cumsum([len(t) for t in texts], dtype=np.int64) - [len(t) for t in texts]
    # The boundary before the first unit is the text's start, which is no member of the set.
    places = np.zeros_like(cuts)
    inner = (cuts > 0) & ~plain[:, None]
    ranks = (before[:, None] + cuts - 1)[inner]
    places[inner] = BoundarySet(offsets).select(ranks) - np.broadcast_to(starts[:, None], cuts.shape)[inner]
    spm = draws[:, 3] % 100 < settings.spm
    p, s, m = settings.marks
    forms, heads, middles, outputs = [], [], [], []
    for text, whole, (one, two), suffix_first in zip(texts, plain.tolist(), places.tolist(), spm.tolist()):
        if whole:
            forms.append("plain"), heads.append(None), middles.append(None), outputs.append(text)
            continue
        head, middle, rest = text[:one], text[one:two], text[two:]
        forms.append("spm" if suffix_first else "psm")
        heads.append(one), middles.append(two - one)
        outputs.append(f"{s}{rest}{p}{head}{m}{middle}" if suffix_first else f"{p}{head}{s}{rest}{m}{middle}")
    return [units.tolist(), forms, heads, middles, outputs]


def fill_in_middle(
    df: DataFrame, id_col: str, text_col: str, settings: Settings = Settings()
) -> DataFrame:
    """Each row's id, units, form, prefix and middle lengths, and the text as it is to be trained on.

    No shuffle; texts are handled in groups of bounded size inside the tasks that read them.
    """
    ship(df.sparkSession)
    rows = pick(df, id=id_col, text=text_col)
    number = F.coalesce(F.col("id").cast("string"), F.lit(""))
    rows = rows.select(
        "id",
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.unhex(F.substring(F.sha2(F.concat(F.lit(f"{settings.seed}:"), number), 256), 1, 32)).alias("draws"),
    )
    schema = StructType(
        [
            StructField(id_col, type_of(df, id_col)),
            StructField("n", LongType()),
            StructField("form", StringType()),
            StructField("prefix_chars", LongType()),
            StructField("middle_chars", LongType()),
            StructField("output", StringType()),
        ]
    )
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            drawn = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=">u4")
            draws = drawn.reshape(-1, 4).astype(np.int64)
            for low, high in bounded_groups(len(t) for t in texts):
                found = cut_texts(texts[low:high], draws[low:high], settings)
                arrays = [pa.array(a, type=k) for a, k in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), *arrays], names=schema.names
                )

    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The exact text, from output and form alone: nothing but the form's marks stands between its parts."""
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in marks), -1)
    part = lambda i: F.get(parts, F.lit(i))
    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )
