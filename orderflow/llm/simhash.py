"""Near duplicates by SimHash, found with anchor points of a covering code.

A fingerprint sums up the word shingles of a whole text in 64 bits. Two that
differ in few bits agree, in one of their halves, up to one bit. The anchors of
a half are the code words of the perfect Hamming code of 31 bits, with the last
bit free: every 32-bit word lies within one bit of exactly one of them, its
home. A word one bit away from another then lies within two bits, covering
radius plus threshold, of the other's home. So every fingerprint is sent to its
home and to all anchors within two bits, 17 per half at most, and homes are
compared with what came to the same anchor. No pair is missed, and how often a
fingerprint is copied does not depend on the data.

Copies of a fingerprint count as one until the end, so groups of equal texts
cost one row. Links between different fingerprints are at most 2,080 each.

Results are defined as follows. Letters A-Z are lower-cased; words are runs of
anything but the six ASCII spaces; a text of fewer words than a shingle has is
one shingle; a text without words, also null, has fingerprint zero and is
linked like any other. Rows of a null id belong to their component like others;
it is named by the smallest id that is not null. Equal rows give equal rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from orderflow.llm.common import map_texts, pick, ship
from orderflow.llm.components import connected_components
from orderflow.session import staged

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42

#: Shingles whose bits are counted at once.
BLOCK = 1 << 17


def shingle_hashes(text: str | None, words_each: int) -> np.ndarray:
    """XXH64 of each shingle of a text."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    count = max(1, len(words) - words_each + 1)
    shingles = map(b" ".join, zip(*[words[i:] for i in range(words_each)])) if count > 1 or len(words) == words_each else [b" ".join(words)]
    return np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=count)


def simhash(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes, as a signed 64-bit number."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(
    df: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """Every row's id and the fingerprint ``fp`` of its whole text."""

    def start():
        return lambda texts: [[simhash(shingle_hashes(t, shingle_words)) for t in texts]]

    return map_texts(df, id_col, text_col, [StructField("fp", LongType())], start)


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Exclusive or of the positions (1 to 31) of the set bits among the low 31."""
    found = np.zeros(len(words), dtype=np.int64)
    for place in range(1, 32):
        found ^= np.where(words >> (place - 1) & 1, place, 0)
    return found


def anchors_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors within two bits of each 32-bit word: whose, which, and whether it is the home."""
    words = words.astype(np.int64)
    syndrome = _syndromes(words)
    bit = np.array([0, *[1 << p for p in range(31)]], dtype=np.int64)
    home = words ^ bit[syndrome]
    rows = np.arange(len(words))
    whose, which = [rows, rows], [home, home ^ (1 << 31)]
    off = np.flatnonzero(syndrome)
    for place in range(1, 32):
        # Two flips lead to a code word where their places add up to the syndrome.
        other = syndrome[off] ^ place
        some = off[other > place]
        whose.append(some)
        which.append(words[some] ^ bit[place] ^ bit[syndrome[some] ^ place])
    whose, which = np.concatenate(whose), np.concatenate(which)
    first = np.zeros(len(whose), dtype=bool)
    first[: len(words)] = True
    return whose, which, first


def _to_anchors(nodes: DataFrame) -> DataFrame:
    """Each fingerprint once per anchor it is sent to, in either half."""
    schema = StructType(
        [
            StructField("anchor", LongType()),
            StructField("fp", LongType()),
            StructField("home", BooleanType()),
        ]
    )

    def run(batches):
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(every), 20_000):
                fps = every[at : at + 20_000]
                for half in (0, 1):
                    words = fps.view(np.uint64) >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF)
                    whose, which, home = anchors_of(words)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(which | half << 32),
                            pa.array(fps[whose]),
                            pa.array(home),
                        ],
                        names=schema.names,
                    )

    return nodes.select("fp").mapInArrow(run, schema)


def links(nodes: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs ``a`` > ``b`` of different fingerprints that differ in few bits.

    A pair is found at the home of its smaller member, once per half that agrees.
    """
    if not 0 <= distance <= 3:
        raise ValueError("halves agree up to one bit only within a distance of 3")
    sent = _to_anchors(nodes)
    homes = sent.where("home").select("anchor", F.col("fp").alias("b"))
    others = sent.select("anchor", F.col("fp").alias("a"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return homes.join(others, (homes["anchor"] == others["anchor"]) & (F.col("a") > F.col("b")) & near).select("a", "b")


def _components(df: DataFrame, id_col: str, text_col: str, shingle_words: int, distance: int) -> DataFrame:
    """Every row's ``id``, the ``hash`` of its text, its ``fp`` and ``component_id``."""
    ship(df.sparkSession)
    rows = pick(df, id=id_col, text=text_col)
    rows = rows.select(F.struct("id", F.xxhash64("text").alias("hash")).alias("key"), "text")
    rows = staged(fingerprints(rows, "key", "text", shingle_words).select("key.*", "fp"), "fingerprints")
    nodes = staged(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = connected_components(links(nodes, distance))
    named = staged(
        nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "roots",
    )
    names = staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    named = staged(named.join(names, "root").select("fp", "root", "component_id"), "components")
    return rows.join(named, "fp")


def near_duplicates(
    df: DataFrame,
    id_col: str,
    text_col: str,
    shingle_words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """Every row's id, its fingerprint ``fp`` and its ``component_id``, the smallest id reachable."""
    found = _components(df, id_col, text_col, shingle_words, distance)
    return found.select(F.col("id").alias(id_col), "fp", "component_id")


def keep_representatives(
    df: DataFrame,
    id_col: str,
    text_col: str,
    shingle_words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row of each component: that of the smallest id, of the smallest text hash among equals.

    Rows are told apart by id and text hash; only where both are repeated are
    whole rows compared, so the texts are shuffled once, for the join.
    """
    found = _components(df, id_col, text_col, shingle_words, distance)
    # Nulls come first in order, so a row without an id is behind any other.
    place = F.struct(F.col("id").isNull().alias("without"), "id", "hash")
    counted = found.groupBy("root", "id", "hash").agg(F.count("*").alias("copies"))
    kept = staged(
        counted.groupBy("root").agg(F.min(F.struct(place.alias("place"), "copies")).alias("first")).select("first.*"),
        "representatives",
    ).select(F.col("place.id").alias("kept_id"), F.col("place.hash").alias("kept_hash"), "copies")
    names = [f"_{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    own_id, text = (F.col(names[df.columns.index(c)]) for c in (id_col, text_col))
    same = own_id.eqNullSafe(F.col("kept_id")) & (F.xxhash64(text.cast("string")) == F.col("kept_hash"))
    single = rows.join(kept.where("copies = 1"), same, "left_semi")
    copied = rows.join(kept.where("copies > 1"), same, "left_semi")
    copied = copied.dropDuplicates([names[df.columns.index(c)] for c in (id_col, text_col)])
    return single.unionByName(copied).toDF(*df.columns)
