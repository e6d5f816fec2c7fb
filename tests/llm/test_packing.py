from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderflow.llm.common import pick
from orderflow.llm.packing import Encoder, differencing, pack_documents, partition
from orderflow.llm.queries import op5_packing, vocabulary_file

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_file())


@pytest.fixture(scope="module")
def encoder():
    with open(vocabulary_file(), encoding="utf-8") as file:
        return Encoder(file.read())


def test_both_libraries_give_the_same_ids(encoder, tokenizer):
    assert encoder.fast is not None

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \t\n\r\x0b\x0c\x85\xa0'sdlv1²ⅷ_ß🙂<|endoftext|>")), max_size=80))
    def same(text):
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids

    same()
    for text in ("a<|endoftext|>b", "<|endoftext|>", " " * 3000, "x" * 3000, "it's we'LL  \n\n  I'd " * 50):
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_keep_to_their_library():
    path = vocabulary_file("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        other = Encoder(file.read())
    assert other.fast is None
    assert other.ids("Plain words").tolist() == Tokenizer.from_file(path).encode("Plain words", add_special_tokens=False).ids


def plain_differencing(sizes, windows):
    """Sums by the definition, on sorted lists."""
    parts = [(sorted([s] + [0] * (windows - 1), reverse=True), i) for i, s in enumerate(sizes)]
    ticket = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-(p[0][0] - p[0][-1]), p[1]))
        (a, _), (b, _) = parts[:2]
        sums = sorted((x + y for x, y in zip(a, reversed(b))), reverse=True)
        parts = parts[2:] + [([s - sums[-1] for s in sums], ticket)]
        ticket += 1
    return [s - parts[0][0][-1] for s in parts[0][0]]


def test_differencing_against_its_definition():
    rng = random.Random(1)
    for _ in range(100):
        sizes = [rng.randint(1, 512) for _ in range(rng.randint(1, 40))]
        windows = rng.randint(1, 6)
        found = differencing(sizes, windows)
        assert sorted(i for slot in found for i in slot) == list(range(len(sizes)))
        sums = sorted((sum(sizes[i] for i in slot) for slot in found), reverse=True)
        assert [s - sums[-1] for s in sums] == plain_differencing(sizes, windows)
    assert differencing([], 3) == [[], [], []]


def test_window_count_rises_until_the_capacity_holds():
    assert sorted(map(len, partition([6, 6, 6], 10))) == [1, 1, 1]
    assert partition([], 10) == []
    with pytest.raises(ValueError):
        partition([11], 10)


def check(rows, documents, tokenizer, window):
    """Every id of every document in one piece; sequences without gaps, within the window."""
    expected = defaultdict(list)
    for key, text in documents:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1] if text else [1]
        expected[key].append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert 0 < r.length <= window and len(r.ids) == 4 * r.length
    assert pieces.keys() == expected.keys()
    for key, texts in expected.items():
        if len(texts) == 1:
            parts = sorted(pieces[key])
            joined = np.frombuffer(b"".join(p[1] for p in parts), dtype="<u4").tolist()
            assert joined == texts[0]
            assert [p[0] for p in parts] == np.cumsum([0, *[len(p[1]) // 4 for p in parts]])[:-1].tolist()
        assert sum(len(p[1]) // 4 for p in pieces[key]) == sum(map(len, texts))
        assert {p[2] for p in pieces[key]} == {len(t) for t in texts}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return sequences


def test_odd_and_empty_tables(spark, odd_documents, no_documents, tokenizer):
    documents = [tuple(r) for r in pick(odd_documents, i="doc_id", t="text").collect()]
    for window in (7, 2048):
        rows = pack_documents(odd_documents.repartition(2), "doc_id", "text", vocabulary_file(), window).collect()
        check(rows, documents, tokenizer, window)
    assert pack_documents(no_documents, "doc_id", "text", vocabulary_file()).count() == 0


def test_given_documents_with_little_padding(spark, tokenizer):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = pack_documents(df, "doc_id", "text", vocabulary_file()).collect()
    sequences = check(rows, [(r.doc_id, r.text) for r in df.collect()], tokenizer, 2048)
    used = sum(length for parts in sequences.values() for _, length in parts)
    assert used / (2048 * len(sequences)) > 0.97
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in op5_packing(spark, FOLDER).collect()}
    assert digest == {(r.doc_id, r.start): zlib.crc32(r.ids) for r in rows}
