"""Word-piece counts by a linear longest-match automaton.

Greedy longest-match splitting of a word needs no backing up if the vocabulary's
trie has failure links: where a node has no child for the next byte, the link
leads to the node of what is left after the pieces that are certain by then, and
the number of those pieces is kept with the link. Counting therefore takes one
step per byte plus the links followed, and no piece is ever built.

Words are runs of anything but space, tab, line feed, vertical tab, form feed
and carriage return. Results are defined as follows. A null or empty text, or
one without a word, has zero words and pieces. A word that the vocabulary can't
spell counts as one piece and as unknown. Words and texts may be of any length.
Every row gives one row, repeated ones too; an empty table gives none.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from orderflow.llm.common import map_texts

#: Words whose counts a task remembers; beyond it the memory starts afresh.
REMEMBERED_WORDS = 400_000
#: Longer words, in bytes, are walked one by one instead of side by side, and not
#: remembered, so that the memory is bounded in bytes, too.
LONG_WORD = 64


class PieceAutomaton:
    """The trie of a vocabulary with failure links and popped-piece counts.

    ``initial`` pieces may start a word, ``continuation`` pieces may follow;
    without the latter all pieces may stand anywhere.
    """

    def __init__(self, initial: Iterable[bytes], continuation: Iterable[bytes] | None = None):
        children: dict[int, int] = {}
        depth_first = [(0, continuation if continuation is not None else initial)]
        self.start = 0
        count = 1
        if continuation is not None:
            self.start = 1
            count = 2
            depth_first.append((1, initial))
        ends = set()
        for root, pieces in depth_first:
            for piece in pieces:
                node = root
                for byte in piece:
                    after = children.get(node << 8 | byte)
                    if after is None:
                        after = children[node << 8 | byte] = count
                        count += 1
                    node = after
                if piece:
                    ends.add(node)
        self.children = children
        self._link(count, ends)
        keys = np.fromiter(children, dtype=np.int64, count=len(children))
        order = np.argsort(keys)
        targets = np.fromiter(children.values(), dtype=np.int64, count=len(children))
        self.keys, self.targets = keys[order], targets[order]

    def _link(self, count: int, ends: set[int]) -> None:
        below: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.children.items():
            below.setdefault(key >> 8, []).append((key & 255, node))
        fail, pops = [-1] * count, [0] * count
        tail = [-1] * count  # pieces left when a word ends here, -1: it can't end here
        tail[0] = 0
        queue = deque({0, self.start})
        while queue:
            parent = queue.popleft()
            for byte, node in below.get(parent, ()):
                queue.append(node)
                if node in ends:
                    fail[node], pops[node] = 0, 1
                else:
                    link, popped = fail[parent], pops[parent]
                    while link >= 0 and (link << 8 | byte) not in self.children:
                        popped += pops[link]
                        link = fail[link]
                    if link >= 0:
                        fail[node], pops[node] = self.children[link << 8 | byte], popped
                # Links lead to nodes of shorter words, which come first in this order.
                if fail[node] >= 0 and tail[fail[node]] >= 0:
                    tail[node] = pops[node] + tail[fail[node]]
        self.fail = np.array(fail, dtype=np.int64)
        self.pops = np.array(pops, dtype=np.int64)
        self.tail = np.array(tail, dtype=np.int64)

    def count_one(self, word: bytes) -> int:
        """Pieces of a word, -1 if the vocabulary can't spell it."""
        children, fail, pops = self.children, self.fail, self.pops
        node, total = self.start, 0
        for byte in word:
            after = children.get(node << 8 | byte)
            while after is None:
                total += int(pops[node])
                node = int(fail[node])
                if node < 0:
                    return -1
                after = children.get(node << 8 | byte)
            node = after
        rest = int(self.tail[node])
        return -1 if rest < 0 else total + rest

    def count(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each word, -1 for one that the vocabulary can't spell."""
        result = np.zeros(len(words), dtype=np.int64)
        if not words or not len(self.keys):
            result[[i for i, w in enumerate(words) if w]] = -1
            return result
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for i in np.flatnonzero(lengths > LONG_WORD):
            result[i] = self.count_one(words[i])
        order = np.flatnonzero((lengths <= LONG_WORD) & (lengths > 0))
        order = order[np.argsort(-lengths[order], kind="stable")]
        if not len(order):
            return result
        lengths = lengths[order]
        letters = np.frombuffer(b"".join([words[i] for i in order]), dtype=np.uint8)
        begins = np.cumsum(lengths) - lengths
        node = np.full(len(order), self.start, dtype=np.int64)
        total = np.zeros(len(order), dtype=np.int64)
        last = len(self.keys) - 1
        for step in range(int(lengths[0])):
            moving = np.arange(np.searchsorted(-lengths, -step, side="left"))
            moving = moving[node[moving] >= 0]
            while len(moving):
                key = node[moving] << 8 | letters[begins[moving] + step]
                at = np.minimum(np.searchsorted(self.keys, key), last)
                hit = self.keys[at] == key
                node[moving[hit]] = self.targets[at[hit]]
                moving = moving[~hit]
                total[moving] += self.pops[node[moving]]
                node[moving] = self.fail[node[moving]]
                moving = moving[node[moving] >= 0]
        rest = np.where(node >= 0, self.tail[node], -1)
        result[order] = np.where(rest < 0, -1, total + rest)
        return result


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes, in
    order, for the characters from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def byte_pieces(vocabulary: str) -> dict[bytes, int]:
    """Pieces and ids of a byte-level vocabulary file in JSON."""
    with open(vocabulary, encoding="utf-8") as file:
        pieces = json.load(file)["model"]["vocab"]
    alphabet = byte_alphabet()
    return {bytes(alphabet[c] for c in piece): i for piece, i in pieces.items()}


def count_tokens(
    df: DataFrame, automaton: PieceAutomaton, id_col: str, text_col: str, lead: bytes = b""
) -> DataFrame:
    """Words, pieces and unknown words of every whole text.

    ``lead`` goes before each word, as vocabularies ask for that mark the start
    of a word by a space. The automaton is bounded by its vocabulary and sent once.
    """
    sent = df.sparkSession.sparkContext.broadcast(automaton)
    results = [StructField(name, LongType()) for name in ("n_words", "n_tokens", "n_unknown")]

    def start():
        known: dict[bytes, int] = {}

        def work(texts):
            nonlocal known
            split = [text.encode("utf-8", "surrogatepass").split() if text else [] for text in texts]
            words = set().union(*split)
            new = words - known.keys()
            if len(known) + len(new) > REMEMBERED_WORDS:
                known, new = {}, words
            new = list(new)
            known.update(zip(new, sent.value.count([lead + w for w in new]).tolist(), strict=True))
            unknown = {w for w in words if known[w] < 0}
            missing = [sum(map(unknown.__contains__, ws)) if unknown else 0 for ws in split]
            counts = [
                sum(map(known.__getitem__, ws)) + 2 * n for ws, n in zip(split, missing, strict=True)
            ]
            for w in new:
                if len(w) > LONG_WORD:
                    del known[w]
            return [list(map(len, split)), counts, missing]

        return work

    return map_texts(df, id_col, text_col, results, start)
