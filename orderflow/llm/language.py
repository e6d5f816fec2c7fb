"""Language identification by cross-parsing entropy.

A suffix automaton of a sample of labelled text stands for each language. A text
is parsed against each of them into the longest phrases that occur in the
sample; the fewer phrases, the less the sample's language says is new. Samples
may be of any size: a phrase costs the bits that name its place in the sample
and a letter of the alphabet, so that longer samples pay for their longer
phrases (Ziv and Merhav's estimate of cross entropy). A letter that the sample
does not have costs what a phrase of the largest sample does, in each language.
The language in which the text costs least wins.

Texts are lower-cased, and whatever is no letter counts as one space. They are
parsed whole, in stretches of ``STRETCH`` letters that each begin a phrase.

Results are defined as follows. A text that is null or has no letter is ``und``
with score 0, as is every text if nothing was learned. Ties go to the language
first in alphabetical order. A text in letters that no sample has gets the tie
and score 0. Equal texts get equal results. An empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from orderflow.llm.common import bounded_groups, map_texts, pick, ship

#: Letters of a sample per language. The sample is the one thing that doesn't grow with the data.
SAMPLE_LETTERS = 40_000
#: Texts that a sample has at least, where a language has as many, and the letters a text may give.
VOICES = 20
PIECES = (125, 250, 500, 1000, 2000, 4000, 8000, 20_000, SAMPLE_LETTERS)
#: Letters that are drawn, in expectation, per letter of the sample.
OVERDRAW = 4
#: Letters of a sample over all languages together, shared out where they are many.
SAMPLE_TOTAL = 400_000
#: Letters that are parsed in one go.
STRETCH = 1024
#: Letters that have a column in the table of transitions.
DENSE = 48
UNKNOWN = "und"


def letters_only(text: str) -> str:
    """Lower-case letters of the text, anything else as single spaces."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class SuffixAutomaton:
    """All substrings of a text, as transitions from state 0 (Blumer's construction)."""

    def __init__(self, letters: Iterable[int]):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for letter in letters:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and letter not in self.next[at]:
                self.next[at][letter] = state
                at = link[at]
            if at >= 0:
                after = self.next[at][letter]
                if length[at] + 1 == length[after]:
                    link[state] = after
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[after]))
                    length.append(length[at] + 1)
                    link.append(link[after])
                    while at >= 0 and self.next[at].get(letter) == after:
                        self.next[at][letter] = clone
                        at = link[at]
                    link[after] = link[state] = clone
            last = state


class CrossParser:
    """Automata of several languages as one table, for parsing many stretches side by side.

    The letters that lead on from most states have a column each in a table of
    all states, ``DENSE`` of them at most; transitions by other letters, of
    which large alphabets have thousands, lie in one list sorted by state and
    letter. So the table has ``DENSE`` times four bytes per state, of which
    there are two per letter of the samples at most: 154 MB for the largest.
    """

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        samples = {k: letters_only(samples[k]) for k in self.languages}
        letters = sorted(set("".join(samples.values())) | {" "})
        numbers = {c: i for i, c in enumerate(letters)}
        # One automaton at a time is in memory as such.
        states, edges = [], []
        for k in self.languages:
            automaton = SuffixAutomaton(map(numbers.get, samples[k]))
            own = [(s, c, t) for s, after in enumerate(automaton.next) for c, t in after.items()]
            root = sum(states)
            edges.append(np.array(own, dtype=np.int32).reshape(-1, 3) + np.int32([root, 0, root]))
            states.append(len(automaton.next))
        source, letter, target = np.concatenate([*edges, np.empty((0, 3), np.int32)]).T
        # Class 0 is any letter that no sample has; the commonest letters come first.
        order = np.argsort(-np.bincount(letter, minlength=len(letters)), kind="stable")
        rank = np.empty(len(letters), dtype=np.int64)
        rank[order] = np.arange(1, len(letters) + 1)
        self.classes = {c: int(rank[i]) for c, i in numbers.items()}
        letter = rank[letter]
        self.width = len(letters) + 1
        # Whole millionths of a bit, so that sums are exact and ties are ties.
        bits = [math.log2(len(samples[k]) + 1) + math.log2(self.width) for k in self.languages]
        self.phrase_cost = np.array([round(1e6 * b) for b in bits], dtype=np.int64)
        self.roots = np.cumsum([0, *states])[:-1].astype(np.int32)
        # The last state has no way on: there a letter leads that no sample has.
        self.dead = sum(states)
        self.columns = min(self.width, DENSE + 1)
        table = np.full((self.dead + 1, self.columns), -1, dtype=np.int32)
        near = letter < self.columns
        table[source[near], letter[near]] = target[near]
        self.flat = table.ravel()
        keys = source[~near].astype(np.int64) * self.width + letter[~near]
        order = np.argsort(keys)
        # A last key that nothing equals keeps every place found within the list.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.targets = np.append(target[~near][order], np.int32(-1))
        #: Classes that a language's sample does not have, by class and language.
        classes = np.arange(self.width)[:, None]
        self.foreign = (self._after(self.roots.astype(np.int64)[None, :], classes) < 0).astype(np.int64)
        # Letters by code point: class, 0 for other letters, -1 for what is none.
        self.code = np.array(
            [self._class_of(chr(i)) for i in range(0x250)], dtype=np.int32
        )

    @property
    def nbytes(self) -> int:
        return self.flat.nbytes + self.keys.nbytes + self.targets.nbytes

    def _after(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Where a letter (one per row) leads from states, -1 for nowhere."""
        if self.columns == self.width:
            return self.flat[state * self.width + letter]
        far = letter[:, 0] >= self.columns
        after = self.flat[state * self.columns + np.where(far[:, None], 0, letter)]
        if far.any():
            wanted = (state * self.width + letter)[far]
            at = np.searchsorted(self.keys, wanted)
            after[far] = np.where(self.keys[at] == wanted, self.targets[at], -1)
        return after

    def _class_of(self, char: str) -> int:
        low = char.lower()
        return self.classes.get(low[0], 0) if char.isalpha() else -1

    def encode(self, text: str) -> np.ndarray:
        """Classes of the letters of a text, runs of anything else as one space."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        near = points < len(self.code)
        codes = self.code[np.where(near, points, 0)]
        far = np.flatnonzero(~near)
        if len(far):
            kinds, back = np.unique(points[far], return_inverse=True)
            codes[far] = np.array([self._class_of(chr(k)) for k in kinds], dtype=np.int32)[back]
        space = self.classes[" "]
        blank = codes < 0
        codes = np.where(blank, space, codes)
        again = np.zeros(len(codes), dtype=bool)
        again[1:] = blank[1:] & blank[:-1]
        return codes[~again] if not blank.all() else codes[:0]

    def phrases(self, stretches: list[np.ndarray]) -> np.ndarray:
        """Phrases each stretch parses into, per language."""
        count, kinds = len(stretches), len(self.languages)
        found = np.zeros((count, kinds), dtype=np.int64)
        lengths = np.array([len(s) for s in stretches], dtype=np.int64)
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        letters = np.zeros((int(lengths[0]) if count else 0, count), dtype=np.int32)
        for column, i in enumerate(order):
            letters[: len(stretches[i]), column] = stretches[i]
        roots = self.roots.astype(np.int64)[None, :]
        state = np.full((count, kinds), self.dead, dtype=np.int64)
        for step in range(len(letters)):
            n = int(np.searchsorted(-lengths, -step, side="left"))
            letter = letters[step, :n, None].astype(np.int64)
            after = self._after(state[:n], letter)
            ended = after < 0
            # A letter that can't extend the phrase before it begins the next one.
            found[:n] += ended
            first = self._after(roots, letter)
            after = np.where(ended, np.where(first < 0, self.dead, first), after)
            state[:n] = after
        result = np.empty_like(found)
        result[order] = found
        return result

    def _costs(self, phrases: np.ndarray, coded: list[np.ndarray]) -> np.ndarray:
        """What the phrases of each text cost, per language; a foreign letter is a phrase by itself."""
        foreign = np.array([np.bincount(codes, minlength=self.width) @ self.foreign for codes in coded])
        return (phrases - foreign) * self.phrase_cost + foreign * self.phrase_cost.max()

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        coded = [self.encode(t) if t else np.empty(0, dtype=np.int32) for t in texts]
        owners, stretches = [], []
        for i, codes in enumerate(coded):
            for at in range(0, len(codes), STRETCH):
                owners.append(i)
                stretches.append(codes[at : at + STRETCH])
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages or not stretches:
            return labels, scores
        totals = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        np.add.at(totals, np.array(owners), self.phrases(stretches))
        totals = self._costs(totals, coded)
        best = np.argmin(totals, axis=1)
        for i, codes in enumerate(coded):
            if len(codes):
                labels[i] = self.languages[best[i]]
                if len(self.languages) == 1:
                    scores[i] = 1.0
                else:
                    least, second = np.partition(totals[i], 1)[:2]
                    scores[i] = float(1 - least / second)
        return labels, scores


def held_out(id_col: Column) -> Column:
    """Whether a row is kept for testing: the checksum of its id, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def sample_texts(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, str]:
    """A sample of labelled text per language, of a bounded number of letters.

    Texts of any length are drawn from, so every label that has a letter is
    learned. Each text gives up to one of ``PIECES`` letters: a twentieth of the
    sample, so that it has many voices, or more where the language's texts
    would not fill it otherwise. They stand at a hashed place of the text, as
    its start may be a header that many share. Rows are drawn by a hash of id
    and text, at the rate that gives ``OVERDRAW`` samples in expectation; what
    falls short, as copies count once, is drawn again at a higher one, up to all
    rows. Pieces are used in the order of the hash, until the language has its
    letters; the piece that passes the bound is cut there, and none after it
    comes to the driver.
    """
    rows = pick(df, id=id_col, text=text_col, lang=lang_col)
    rows = rows.where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("id"))
    ).where(F.col("text").rlike(r"\p{L}"))
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.select("lang", draw.alias("draw"), "text")
    found = F.trim(F.regexp_replace("text", r"[^\p{L}]+", " "))
    sums = [F.sum(F.least("size", F.lit(piece))).alias(f"n{piece}") for piece in PIECES]
    sizes = rows.select("lang", F.length(found).alias("size")).groupBy("lang").agg(*sums)
    available = {r.lang: [r[f"n{piece}"] for piece in PIECES] for r in sizes.collect()}
    if not available:
        return {}
    letters = _shared_letters([a[-1] for a in available.values()])
    pieces, rates = {}, {}
    for lang, there in available.items():
        enough = [(p, n) for p, n in zip(PIECES, there, strict=True) if p * VOICES >= letters]
        pieces[lang], n = next((pn for pn in enough if pn[1] >= letters), enough[-1])
        rates[lang] = min(1.0, OVERDRAW * letters / n)
    samples: dict[str, str] = {}
    while rates:
        of = lambda values: F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("lang")]
        room = F.greatest(F.length("found") - of(pieces), F.lit(0)) + 1
        place = F.pmod(F.xxhash64("draw"), room).cast("int") + 1
        earlier = Window.partitionBy("lang").orderBy("draw", "piece").rowsBetween(Window.unboundedPreceding, -1)
        drawn = (
            rows.where(F.col("draw") < of(rates))
            .select("lang", "draw", found.alias("found"))
            .select("lang", "draw", F.trim(F.substring("found", place, of(pieces))).alias("piece"))
            .distinct()
            # Few rows by now, however many a language has.
            .withColumn("before", F.coalesce(F.sum(F.length("piece") + 1).over(earlier), F.lit(0)))
            .where(F.col("before") <= letters)
        )
        parts: dict[str, list[str]] = {}
        filled: dict[str, int] = {}
        for row in sorted(drawn.collect(), key=lambda r: (r.lang, r.draw, r.piece)):
            filled[row.lang] = filled.get(row.lang, -1) + len(row.piece) + 1
            if part := letters_only(row.piece):
                parts.setdefault(row.lang, []).append(part)
        samples |= {k: " ".join(v)[:letters] for k, v in parts.items()}
        rates = {
            k: min(1.0, 8 * rate)
            for k, rate in rates.items()
            if rate < 1 and filled.get(k, -1) < letters
        }
    # Sizes differ where a language has fewer letters; phrases are priced by them.
    return samples


def _shared_letters(available: list[int]) -> int:
    """Letters that a sample may have, so that all together keep to ``SAMPLE_TOTAL``.

    Languages that have fewer leave the rest of their share to the others.
    """
    left = SAMPLE_TOTAL
    for i, n in enumerate(sorted(available)):
        share = left // (len(available) - i)
        if n >= share:
            return max(1, min(SAMPLE_LETTERS, share))
        left -= n
    return SAMPLE_LETTERS


def identify_languages(
    df: DataFrame, id_col: str, text_col: str, samples: dict[str, str]
) -> DataFrame:
    """Every row's id, ``lang_pred`` and ``score``, from its text alone.

    Samples are bounded and travel with the tasks; each Python worker builds
    the automata once.
    """
    sent = df.sparkSession.sparkContext.broadcast(samples)
    results = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]

    def start():
        parser = _parser_of(sent.value)
        return lambda texts: list(parser.predict(texts))

    return map_texts(df, id_col, text_col, results, start)


def keep_identified(df: DataFrame, text_col: str, samples: dict[str, str]) -> DataFrame:
    """The rows whose text has a language; nothing else about them changes."""
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(samples)
    names = [f"_{i}" for i in range(len(df.columns))]

    @F.pandas_udf(BooleanType())
    def identified(texts):
        import pandas as pd

        texts = [t if isinstance(t, str) else None for t in texts]
        parser, found = _parser_of(sent.value), []
        for low, high in bounded_groups(len(t) if t else 0 for t in texts):
            found += [label != UNKNOWN for label in parser.predict(texts[low:high])[0]]
        return pd.Series(found, dtype=bool)

    text = F.col(names[df.columns.index(text_col)]).cast("string")
    return df.toDF(*names).where(identified(text)).toDF(*df.columns)


_PARSERS: dict[int, CrossParser] = {}


def _parser_of(samples: dict[str, str]) -> CrossParser:
    """The parser of these samples, built once per worker."""
    key = hash(tuple(sorted(samples.items())))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = CrossParser(samples)
    return _PARSERS[key]
