"""Benchmark passages in documents, by q-gram lemma filtering and banded alignment.

Documents and benchmark items are compared as lower-case letters and digits,
with a single space for whatever stands between. A document holds an item if a
region of it is within the item's edit budget, a tenth of its length.

By the q-gram lemma, such a region shares at least m - q + 1 - qe of the m - q + 1
character q-grams of the item, and e edits move them by at most e diagonals. So
shared q-grams are counted per item in overlapping bands of diagonals, two
budgets wide; bands that reach the bound are verified by alignment within the
band, and no region within the budget is missed. Items have q-grams of the
longest of ``GRAMS`` that leaves a bound above zero, so short ones keep the
whole budget.

The index of an item block is bounded (``BLOCK_CHARS``) and sent to the tasks;
a larger benchmark takes several passes over the documents, one per block.

Results are defined as follows. Null and empty texts hold nothing. Items whose
text is null or has fewer than two characters after normalisation are left out.
Items of fewer than ``GRAM`` characters are found between the borders of words
only, and ``drop_contaminated`` drops no row for them unless it is told to: an
answer such as "no" does not tell where a text comes from.
Items with equal texts are each reported. Regions of an item in a document
don't overlap; of overlapping ones the one with the fewest edits counts, then
the first. Equal rows give equal rows. Empty tables give none.
"""

from __future__ import annotations

import math
from bisect import bisect
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from orderflow.llm.common import bounded_groups, pick, ship, type_of

#: Characters per q-gram; a power of two, as hashes are doubled up.
GRAM = 8
#: The same for items too short for these, in the order of trial.
GRAMS = (GRAM, 4, 2)
#: Edits per character of an item.
BUDGET = 0.1
#: Characters of benchmark items indexed at a time.
BLOCK_CHARS = 1_000_000
#: Pairs of equal q-grams that are expanded at a time.
PAIRS_AT_ONCE = 500_000

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 22
_COUNT_BITS = 21
_SEPARATOR = 0
#: Added to diagonals, which may be negative.
_SHIFT = 1 << 40


def _simple_lower(char: str) -> str:
    low = char.lower()
    return low if len(low) == 1 else char


def _letter(point: int) -> int:
    """Code point a character is compared as; 32 for what is neither letter nor digit."""
    char = chr(point)
    return ord(_simple_lower(char)) if char.isalnum() else 32


_NEAR = np.array([_letter(i) for i in range(0x250)], dtype=np.uint32)


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The characters that are compared, and their places in the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    near = points < len(_NEAR)
    codes = _NEAR[np.where(near, points, 0)]
    far = np.flatnonzero(~near)
    if len(far):
        kinds, back = np.unique(points[far], return_inverse=True)
        codes[far] = np.array([_letter(int(k)) for k in kinds], dtype=np.uint32)[back]
    keep = np.ones(len(codes), dtype=bool)
    blank = codes == 32
    keep[1:] = ~(blank[1:] & blank[:-1])
    # Blanks at the ends compare with nothing.
    if len(keep):
        keep[0] &= not blank[0]
        last = len(keep) - 1
        while last >= 0 and (blank[last] or not keep[last]):
            keep[last] = False
            last -= 1
    places = np.flatnonzero(keep)
    return codes[places], places


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit hash of each q-gram, by joining the hashes of its halves."""
    hashes, width = codes.astype(np.uint64), 1
    factor = _FACTOR
    while width < gram:
        if len(hashes) <= width:
            return hashes[:0]
        hashes = hashes[:-width] * factor + hashes[width:]
        factor = np.uint64(int(factor) ** 2 % 2**64)
        width *= 2
    return hashes


def _filter_place(hashes: np.ndarray) -> np.ndarray:
    return (hashes * _FACTOR) >> np.uint64(64 - _FILTER_BITS)


def _band_place(key: np.ndarray, band: np.ndarray) -> np.ndarray:
    mixed = (key.astype(np.uint64) << np.uint64(20)) + band.astype(np.uint64)
    return ((mixed * _FACTOR) >> np.uint64(64 - _COUNT_BITS)).astype(np.int64)


def _apart(codes: np.ndarray, start: int, end: int) -> bool:
    """Whether a region begins and ends where words do."""
    return (not start or codes[start - 1] == 32) and (end == len(codes) or codes[end] == 32)


@dataclass
class Hit:
    item: int
    start: int
    end: int
    edits: int


class ItemIndex:
    """Inverted index of the q-grams of a block of items."""

    def __init__(self, items: list[tuple], budget: float = BUDGET, gram: int = GRAM):
        self.gram = gram
        self.ids, self.codes = [], []
        for key, text in items:
            codes = normalised(text)[0] if text else np.empty(0, dtype=np.uint32)
            if len(codes) >= self.gram:
                self.ids.append(key)
                self.codes.append(codes)
        lengths = np.array([len(c) for c in self.codes], dtype=np.int64)
        # Beyond that many edits the bound would be no bound.
        self.edits = np.minimum((lengths * budget).astype(np.int64), (lengths - self.gram) // self.gram)
        self.bound = lengths - self.gram + 1 - self.gram * self.edits
        hashes = [gram_hashes(c, gram) for c in self.codes] or [np.empty(0, dtype=np.uint64)]
        every = np.concatenate(hashes)
        item = np.repeat(np.arange(len(self.codes)), [len(h) for h in hashes] if self.codes else [])
        place = np.concatenate([np.arange(len(h)) for h in hashes])
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first = np.unique(every[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(every)))
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[_filter_place(self.grams)] = True

    def search(self, texts: list[str | None]) -> list[list[Hit]]:
        """Regions of items in each text."""
        found: list[list[Hit]] = [[] for _ in texts]
        if not self.codes:
            return found
        parts = [normalised(t) if t else (np.empty(0, np.uint32), np.empty(0, np.int64)) for t in texts]
        gap = np.full(1, _SEPARATOR, dtype=np.uint32)
        joined = np.concatenate([x for codes, _ in parts for x in (codes, gap)])
        begins = np.cumsum([0, *[len(codes) + 1 for codes, _ in parts]])[:-1]
        for text, item, low, high, straight in self._bands(joined, begins):
            codes, places = parts[text]
            region = self._verify(codes, item, low, high, straight)
            if region and (len(self.codes[item]) >= GRAM or _apart(codes, region[0], region[1])):
                start, end, edits = region
                found[text].append(Hit(item, int(places[start]), int(places[end - 1]) + 1, edits))
        return [self._settled(hits) for hits in found]

    @staticmethod
    def _settled(hits: list[Hit]) -> list[Hit]:
        """Regions of an item that don't overlap, the best first."""
        kept: dict[int, list[tuple[int, int, int]]] = {}
        for hit in sorted(hits, key=lambda h: (h.item, h.edits, h.start, h.end)):
            own = kept.setdefault(hit.item, [])
            at = bisect(own, (hit.start, hit.end, hit.edits))
            if (not at or own[at - 1][1] <= hit.start) and (at == len(own) or hit.end <= own[at][0]):
                own.insert(at, (hit.start, hit.end, hit.edits))
        found = [Hit(item, *region) for item, own in kept.items() for region in own]
        return sorted(found, key=lambda h: (h.start, h.item))

    def _bands(self, joined: np.ndarray, begins: np.ndarray):
        """Bands that reach their item's bound: text, item, first and last diagonal, exact or not.

        A diagonal is where in its text an item would start.
        """
        hashes = gram_hashes(joined, self.gram)
        at = np.flatnonzero(self.filter[_filter_place(hashes)])
        gram = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        hit = self.grams[gram] == hashes[at]
        at, gram = at[hit], gram[hit]
        # Bands are first counted by a hash of theirs, all their shared q-grams together:
        # few come to a bound that way, and the exact count is left to these.
        sums = np.zeros(1 << _COUNT_BITS, dtype=np.int64)
        chunks = 0
        for chunk in self._pairs(at, gram, begins):
            chunks += 1
            for both in (chunk[1], chunk[1] - 1):
                sums += np.bincount(_band_place(chunk[0], both), minlength=len(sums))
        waiting = np.empty((4, 0), dtype=np.int64)
        for number, chunk in enumerate([chunk] if chunks == 1 else self._pairs(at, gram, begins) if chunks else [], 1):
            key, band, place, diagonal = chunk
            bound = self.bound[key % len(self.codes)]
            parts = [waiting]
            for both in (band, band - 1):
                some = sums[_band_place(key, both)] >= bound
                parts.append(np.stack([key[some], both[some], place[some], diagonal[some]]))
            rows = np.concatenate(parts, axis=1)
            # Pairs come by place in the texts: a band is complete where its last diagonal is past.
            text, item = rows[0] // len(self.codes), rows[0] % len(self.codes)
            ends = begins[text] + (rows[1] + 2) * (self.edits[item] + 1) - _SHIFT + self.bound[item] + self.gram * self.edits[item]
            done = ends <= begins[key[-1] // len(self.codes)] + place[-1] + diagonal[-1] if number < chunks else np.ones(len(ends), dtype=bool)
            waiting = rows[:, ~done]
            yield from self._full(rows[:, done])

    def _full(self, rows: np.ndarray):
        """Of complete bands (text and item, band, place, diagonal), those that reach the bound."""
        rows = rows[:, np.lexsort(rows[2::-1])]
        if not rows.shape[1]:
            return
        fresh_band = np.append(True, np.any(rows[:2, 1:] != rows[:2, :-1], axis=0))
        fresh_gram = fresh_band | np.append(True, rows[2, 1:] != rows[2, :-1])
        counts = np.bincount(np.cumsum(fresh_band) - 1, weights=fresh_gram)
        starts = np.append(np.flatnonzero(fresh_band), rows.shape[1])
        for i in np.flatnonzero(counts >= self.bound[rows[0, fresh_band] % len(self.codes)]):
            first = starts[i]
            text, item = divmod(int(rows[0, first]), len(self.codes))
            width = int(self.edits[item]) + 1
            low = int(rows[1, first]) * width - _SHIFT
            diagonals, shared = np.unique(rows[3, first : starts[i + 1]], return_counts=True)
            whole = np.flatnonzero(shared == len(self.codes[item]) - self.gram + 1)
            yield text, item, low, low + 2 * width - 1, int(diagonals[whole[0]]) if len(whole) else None

    def _pairs(self, at: np.ndarray, gram: np.ndarray, begins: np.ndarray):
        """Equal q-grams of texts and items, so many at a time: text and item, band, place, diagonal."""
        total = np.cumsum(self.count[gram])
        low = 0
        while low < len(gram):
            before = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, before + PAIRS_AT_ONCE, side="right")))
            some, times = gram[low:high], self.count[gram[low:high]]
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            entry = np.repeat(self.first[some], times) + step
            item, place = self.item[entry], self.place[entry]
            position = np.repeat(at[low:high], times)
            text = np.searchsorted(begins, position, side="right") - 1
            diagonal = position - begins[text] - place
            # Bands start every budget + 1 diagonals and are twice as wide.
            band = (diagonal + _SHIFT) // (self.edits[item] + 1)
            yield text * len(self.codes) + item, band, place, diagonal
            low = high

    def _verify(self, codes: np.ndarray, item: int, low: int, high: int, straight: int | None):
        """Region of the fewest edits within the band, if within the budget."""
        pattern, budget = self.codes[item], int(self.edits[item])
        if straight is not None:
            # Every q-gram on one diagonal: the item itself, if hashes don't mislead.
            if np.array_equal(codes[straight : straight + len(pattern)], pattern):
                return straight, straight + len(pattern), 0
        forward = _align(pattern, codes, low - budget, high + budget)
        edits, end = forward
        if edits > budget or end <= 0:
            return None
        # From the end backwards, the best alignment shows where the region starts.
        back = len(codes) - end
        edits, length = _align(pattern[::-1], codes[::-1], back, back, budget)
        return end - (length - back), end, edits


def item_indexes(items: list[tuple], budget: float = BUDGET) -> list[ItemIndex]:
    """Indexes of the items by the q-grams that their lengths allow."""
    kinds: dict[int, list[tuple]] = {}
    for key, text in items:
        length = len(normalised(text)[0]) if text else 0
        edits = int(length * budget)
        fitting = (gram for gram in GRAMS if length - gram + 1 - gram * edits > 0)
        kinds.setdefault(next(fitting, GRAMS[-1]), []).append((key, text))
    return [ItemIndex(kinds[gram], budget, gram) for gram in sorted(kinds, reverse=True)]


def _align(pattern: np.ndarray, text: np.ndarray, low: int, high: int, spread: int = 0) -> tuple[int, int]:
    """Fewest edits that turn the pattern into a region of the text, and the region's end.

    The region starts on a diagonal from ``low`` to ``high``; the alignment may
    leave these by ``spread``. The nearest end wins among equals.
    """
    first, last = low - spread, high + spread
    width = last - first + 1
    cells = np.arange(width)
    far = len(pattern) + width + 1
    row = np.where((cells >= spread) & (cells < width - spread), 0, far)
    row = np.minimum.accumulate(row - cells) + cells
    # Codes under the band, with what no text has around them.
    begin, end = first, last + len(pattern)
    padded = np.full(end - begin + 1, 0xFFFFFFFF, dtype=np.uint32)
    inside = slice(max(begin, 0), max(min(end + 1, len(text)), 0))
    if inside.stop > inside.start:
        padded[inside.start - begin : inside.stop - begin] = text[inside]
    for i, code in enumerate(pattern):
        same = padded[i : i + width] == code
        best = row + ~same
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        row = np.minimum.accumulate(best - cells) + cells
    ends = first + cells + len(pattern)
    row = np.where(ends <= len(text), row, far)
    best = int(np.argmin(row))
    return int(row[best]), int(ends[best])


def _indexes(items: DataFrame, id_col: str, text_col: str, budget: float, least: int = 0) -> list:
    """The indexes of each block of items of ``least`` characters, ready to be sent to tasks."""
    rows = pick(items, id=id_col, text=text_col).where("text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_CHARS))
    context = items.sparkSession.sparkContext
    found = []
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        known = [(r["id"], r["text"]) for r in part if not least or len(normalised(r["text"])[0]) >= least]
        indexes = item_indexes(sorted(known, key=repr), budget)
        found.append(context.broadcast(indexes))
    return found


def find_items(
    df: DataFrame,
    id_col: str,
    text_col: str,
    items: DataFrame,
    item_id_col: str,
    item_text_col: str,
    budget: float = BUDGET,
) -> DataFrame:
    """Where documents hold benchmark items: document, item, region in code points, edits."""
    ship(df.sparkSession)
    schema = StructType(
        [
            StructField(id_col, type_of(df, id_col)),
            StructField(item_id_col, type_of(items, item_id_col)),
            StructField("start", LongType()),
            StructField("end", LongType()),
            StructField("edits", LongType()),
        ]
    )
    rows = pick(df, id=id_col, text=text_col).selectExpr("id", "cast(text as string) text")

    def of_block(sent):
        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            for batch in batches:
                texts = batch.column(1).to_pylist()
                groups = bounded_groups(len(t) if t else 0 for t in texts)
                for (low, high), index in product(groups, sent.value):
                    hits = [(low + i, h) for i, own in enumerate(index.search(texts[low:high])) for h in own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([i for i, _ in hits], pa.int64())),
                            pa.array([index.ids[h.item] for _, h in hits], arrow.types[1]),
                            pa.array([h.start for _, h in hits], pa.int64()),
                            pa.array([h.end for _, h in hits], pa.int64()),
                            pa.array([h.edits for _, h in hits], pa.int64()),
                        ],
                        schema=arrow,
                    )

        return run

    found = [rows.mapInArrow(of_block(s), schema) for s in _indexes(items, item_id_col, item_text_col, budget)]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def drop_contaminated(
    df: DataFrame,
    text_col: str,
    items: DataFrame,
    item_id_col: str,
    item_text_col: str,
    budget: float = BUDGET,
    least: int = GRAM,
) -> DataFrame:
    """The rows whose text holds no benchmark item; nothing else about them changes.

    Items of fewer than ``least`` characters after normalisation are too short
    to tell and drop nothing; ``find_items`` reports them.
    """
    ship(df.sparkSession)
    names = [f"_{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    text = F.col(names[df.columns.index(text_col)]).cast("string")

    def of_block(sent):
        @F.pandas_udf(BooleanType())
        def clean(texts):
            import pandas as pd

            texts = [t if isinstance(t, str) else None for t in texts]
            found = []
            for low, high in bounded_groups(len(t) if t else 0 for t in texts):
                hit = [False] * (high - low)
                for index in sent.value:
                    hit = [h or bool(own) for h, own in zip(hit, index.search(texts[low:high]), strict=True)]
                found += [not h for h in hit]
            return pd.Series(found, dtype=bool)

        return clean

    for sent in _indexes(items, item_id_col, item_text_col, budget, least):
        rows = rows.where(of_block(sent)(text))
    return rows.toDF(*df.columns)
