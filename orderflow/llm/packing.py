"""Packing of tokenised documents into windows by Karmarkar-Karp differencing.

Every document is tokenised whole and ends in an end token. Full windows of a
document are sequences of their own; what is left is cut into pieces of at most
a quarter window. Pieces are partitioned, block by block, into a number of
windows by multiway differencing: partial partitions are merged, those of the
largest spread first, the fullest windows of one with the emptiest of the
other, until one near-equal partition is left. If its fullest window exceeds
the capacity, the block is partitioned anew into one window more.

A task packs the documents it reads, in blocks of bounded size, so nothing is
shuffled, no task holds more than a block, and a repeated task gives the same
sequences. The last block of a task may leave less than a window empty.

Results are defined as follows. A null text is an empty one; it has the end
token alone. Texts of any length are cut into as many pieces as they need.
Repeated rows are packed each for itself. An empty table gives no piece.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from orderflow.llm.common import bounded_groups, pick, ship, type_of
from orderflow.llm.token_counts import byte_alphabet

WINDOW = 2048
END_ID = 1
#: Windows' worth of tokens that is partitioned together. Differencing misses the
#: capacity by a few tokens in most blocks, so about one window in so many is padding.
BLOCK_WINDOWS = 256
#: Bytes of ids that are handed on at once.
BATCH_BYTES = 4_000_000

#: Fixed value: how byte-level vocabularies split a text before merging.
BYTE_LEVEL_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer runs are left to the library whose merging is not quadratic in them.
LONG_RUN = re.compile(r"\S{1000}|\s{1000}")


class Encoder:
    """Ids of texts by a vocabulary file of the tokenizers library.

    Plain byte-level vocabularies are also read by tiktoken, which gives the
    same ids at a quarter of the cost; it does the texts without very long runs.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.fast = self._fast(json.loads(vocabulary))

    @staticmethod
    def _fast(file: dict):
        model, split = file["model"], file.get("pre_tokenizer") or {}
        plain = {
            "model": model.get("type") == "BPE",
            "split": split.get("type") == "ByteLevel" and split.get("use_regex", True),
            "prefix": not split.get("add_prefix_space"),
            "normalizer": file.get("normalizer") is None,
            "options": not any(
                model.get(k)
                for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
            ),
            "added": all(
                t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])
                for t in file["added_tokens"]
            ),
        }
        added = {t["content"]: t["id"] for t in file["added_tokens"]}
        pieces = {k: v for k, v in model["vocab"].items() if k not in added}
        merged = [m if isinstance(m, str) else "".join(m) for m in model["merges"]]
        merged = [m.replace(" ", "") for m in merged]
        in_order = [pieces.get(m) for m in merged]
        # Ranks are ids there, so merges must come in the order of their ids.
        if not all(plain.values()) or None in in_order or in_order != sorted(set(in_order)):
            return None
        import tiktoken

        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in piece): i for piece, i in pieces.items()}
        return tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_SPLIT, mergeable_ranks=ranks, special_tokens=added)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None and not LONG_RUN.search(text):
            return self.fast.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4", copy=False)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Items per window of a near-equal partition, by Karmarkar-Karp differencing."""
    count = len(sizes)
    if not count:
        return [[] for _ in range(windows)]
    heap, merged = [], []
    for number, size in enumerate(sizes):
        sums = np.zeros(windows, dtype=np.int64)
        held = np.full(windows, -1, dtype=np.int64)
        sums[0], held[0] = size, number
        heap.append((-size if windows > 1 else 0, number, sums, held))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, sums, held = heapq.heappop(heap)
        _, _, others, more = heapq.heappop(heap)
        # Sums are kept in falling order: the fullest of one meets the emptiest of the other.
        sums, more = sums + others[::-1], more[::-1]
        # What two windows hold becomes a node of its own, numbered by merge and place.
        nodes = count + len(merged) * windows + np.arange(windows)
        merged.append((held, more))
        held = np.where(held < 0, more, np.where(more < 0, held, nodes))
        order = np.argsort(-sums, kind="stable")
        sums = sums[order] - sums[order[-1]]
        heapq.heappush(heap, (int(-sums[0]), count + len(merged), sums, held[order]))
    found = []
    for node in heap[0][3].tolist():
        items, rest = [], [node] if node >= 0 else []
        while rest:
            node = rest.pop()
            if node < count:
                items.append(node)
            else:
                merge, place = divmod(node - count, windows)
                rest += [int(side[place]) for side in merged[merge]]
        found.append(items)
    return found


def partition(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items per window, in as few near-equal windows as differencing fits into the capacity."""
    if any(size > capacity for size in sizes):
        raise ValueError("an item is larger than a window")
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, windows)
        if max((sum(sizes[i] for i in slot) for slot in found), default=0) <= capacity:
            return [slot for slot in found if slot]
        windows += 1


class Packer:
    """Pieces of the documents of one task, as they become sequences."""

    def __init__(self, window: int, first_sequence: int):
        self.window = window
        self.largest = max(1, window // 4)
        self.sequence = first_sequence
        self.pool: list[tuple] = []
        self.waiting = 0

    def add(self, key, ids: np.ndarray) -> Iterator[tuple]:
        """Takes a document; gives the pieces whose sequence is settled."""
        total, at = len(ids), 0
        while total - at >= self.window:
            yield self._row(key, at, ids[at : at + self.window], total, 0)
            self.sequence += 1
            at += self.window
        target = BLOCK_WINDOWS * self.window
        while at < total:
            size = min(self.largest, total - at, target - self.waiting)
            self.pool.append((key, at, ids[at : at + size], total))
            self.waiting += size
            at += size
            if self.waiting == target:
                yield from self.settle()

    def settle(self) -> Iterator[tuple]:
        """Gives the pieces that wait, packed."""
        pool, self.pool, self.waiting = self.pool, [], 0
        for slot in partition([len(p[2]) for p in pool], self.window) if pool else []:
            offset = 0
            for number in sorted(slot):
                key, at, ids, total = pool[number]
                yield self._row(key, at, ids, total, offset)
                offset += len(ids)
            self.sequence += 1

    def _row(self, key, at: int, ids: np.ndarray, total: int, offset: int) -> tuple:
        return key, at, len(ids), ids.tobytes(), total, self.sequence, offset


def _in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3]) + 64
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def pack_documents(
    df: DataFrame,
    id_col: str,
    text_col: str,
    vocabulary: str,
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents with their ids and their place in a sequence.

    ``vocabulary`` is the path of a tokenizers file; it is read here and sent
    to the tasks. ``ids`` are unsigned 32-bit numbers, little-endian.
    """
    ship(df.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:
        sent = df.sparkSession.sparkContext.broadcast(file.read())
    results = [
        StructField("start", LongType()),
        StructField("length", LongType()),
        StructField("ids", BinaryType()),
        StructField("doc_tokens", LongType()),
        StructField("sequence_id", LongType()),
        StructField("offset", LongType()),
    ]
    if id_col in [field.name for field in results]:
        raise ValueError(f"the id column {id_col} has the name of a result")
    schema = StructType([StructField(id_col, type_of(df, id_col)), *results])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        encoder = _encoder_of(sent.value)
        end = np.array([end_id], dtype="<u4")
        # Partitions count their sequences from different starts.
        packer = Packer(window, TaskContext.get().partitionId() << 40)

        def pieces():
            for batch in batches:
                keys, texts = batch.column(0), batch.column(1)
                for low, high in bounded_groups(n or 0 for n in _lengths(texts)):
                    for key, text in zip(keys.slice(low, high - low).to_pylist(), texts.slice(low, high - low).to_pylist(), strict=True):
                        ids = encoder.ids(text) if text else end[:0]
                        yield from packer.add(key, np.concatenate([ids, end]))
            yield from packer.settle()

        yield from _in_batches(pieces(), to_arrow_schema(schema))

    rows = pick(df, id=id_col, text=text_col)
    return rows.selectExpr("id", "cast(text as string) text").mapInArrow(run, schema)


def _lengths(texts: pa.Array) -> list[int | None]:
    import pyarrow.compute as pc

    return pc.binary_length(texts).to_pylist()


_ENCODERS: dict[int, Encoder] = {}


def _encoder_of(vocabulary: str) -> Encoder:
    """The encoder of this vocabulary, built once per worker."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]
