from __future__ import annotations

import random
from collections import Counter

import pytest

from orderflow.llm import decontaminate
from orderflow.llm.common import pick
from orderflow.llm.decontaminate import (
    ItemIndex,
    drop_contaminated,
    find_items,
    item_indexes,
    normalised,
)
from orderflow.llm.queries import op6_decontamination

FOLDER = "/root/testdata/sf0.01"
LETTERS = "abcdefgh"


def plain(text):
    """Lower-case letters and digits, single spaces between."""
    return " ".join("".join(c.lower() if c.isalnum() else " " for c in text).split())


def region_edits(item, text):
    """Fewest edits between an item and any region of the text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, code in enumerate(item, 1):
        after = [i]
        for j, other in enumerate(text, 1):
            after.append(min(row[j - 1] + (code != other), row[j] + 1, after[j - 1] + 1))
        row = after
    return min(row)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        after = [i]
        for j, y in enumerate(b, 1):
            after.append(min(row[j - 1] + (x != y), row[j] + 1, after[j - 1] + 1))
        row = after
    return row[-1]


def edited(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        at = rng.randrange(len(text))
        kind = rng.random()
        if kind < 0.4:
            text[at] = rng.choice(LETTERS)
        elif kind < 0.7:
            text.insert(at, rng.choice(LETTERS))
        elif len(text) > 1:
            del text[at]
    return "".join(text)


def test_normalisation_keeps_places():
    text = "  Ärger, 12\t\n漢字—İx!  "
    codes, places = normalised(text)
    assert "".join(map(chr, codes)) == plain(text.replace("İ", "i")).replace("ix", "İx")
    assert [text[p].lower() for p in places if text[p].isalnum()][:5] == list("ärger")
    assert len(normalised(" \n")[0]) == 0


def test_regions_against_the_full_table():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choices(LETTERS, k=n))
    for _ in range(25):
        items = [word(rng.randint(8, 90)) for _ in range(6)]
        index = ItemIndex(list(enumerate(items)))
        texts = []
        for _ in range(10):
            parts = [word(rng.randint(0, 60))]
            for item in rng.sample(items, rng.randint(0, 2)):
                parts += [edited(rng, item, rng.randint(0, len(item) // 8)), word(rng.randint(0, 40))]
            texts.append("".join(parts))
        for text, hits in zip(texts, index.search(texts), strict=True):
            best = {i: region_edits(item, text) for i, item in enumerate(items)}
            budgets = {i: int(index.edits[i]) for i in best}
            least = {}
            for hit in hits:
                assert distance(items[hit.item], text[hit.start : hit.end]) == hit.edits
                least[hit.item] = min(hit.edits, least.get(hit.item, 99))
            assert least == {i: e for i, e in best.items() if e <= budgets[i]}


def test_short_items_keep_the_whole_budget():
    rng = random.Random(6)
    word = lambda n: "".join(rng.choices(LETTERS, k=n))
    for _ in range(10):
        items = [word(n) for n in (2, 3, 5, 7, 9, 10, 13, 15, 20, 23, 30, 31, 39, 60)]
        indexes = item_indexes(list(enumerate(items)))
        assert sorted(i for index in indexes for i in index.ids) == list(range(len(items)))
        texts = []
        for item in items:
            texts.append(f"{word(40)} {edited(rng, item, len(item) // 10)} {word(40)}")
            texts.append(word(40) + edited(rng, item, len(item) // 10) + word(40))
        found = [set() for _ in texts]
        for index in indexes:
            for own, hits in zip(found, index.search(texts), strict=True):
                own.update(index.ids[h.item] for h in hits)
        for text, own in zip(texts, found, strict=True):
            apart = lambda item: len(item) >= 8 or f" {item} " in f" {plain(text)} "  # noqa: E731, B023
            near = {i for i, item in enumerate(items) if region_edits(item, text) <= len(item) // 10}
            assert own == {i for i in near if apart(items[i])}


def test_short_items_in_tables(spark):
    items = spark.createDataFrame([(1, "answer it"), (2, "forty two"), (3, "abc1"), (4, "one long question of the benchmark, asked"), (5, "what is new?")], "item_id int, text string")
    df = spark.createDataFrame([(1, "so ABC1."), (2, "say what iz new now"), (3, "nothing"), (4, "forty-two")], "doc_id int, text string")
    found = find_items(df, "doc_id", "text", items, "item_id", "text").collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in found) == [(1, 3, 0), (2, 5, 1), (4, 2, 0)]
    kept = lambda **more: [r.doc_id for r in drop_contaminated(df, "text", items, "item_id", "text", **more).collect()]
    assert kept() == [1, 3] and kept(least=0) == [3]


def test_short_answers_drop_no_clean_text(spark):
    items = spark.createDataFrame([(1, "no"), (2, "Yes"), (3, "a b"), (4, "aa")], "item_id int, text string")
    texts = ["I know nothing of it", "Yesterday was fine", "Oh no, not this", "yes", "aaa aaaa", "was a, b or c", "(No)"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = find_items(df, "doc_id", "text", items, "item_id", "text").collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(2, 1), (3, 2), (5, 3), (6, 1)]
    assert drop_contaminated(df, "text", items, "item_id", "text").count() == len(texts)


def test_repeated_characters_and_ends():
    items = [("a", "a" * 60), ("ab", "ab" * 30), ("b", "short"), ("n", None), ("e", "")]
    index = ItemIndex(items)
    assert index.ids == ["a", "ab"]
    hits = index.search(["a" * 130, "a" * 58, "a" * 50, "b" + "ab" * 29, None, "", "A" * 30 + "-" + "a" * 30])
    assert [Counter(index.ids[h.item] for h in own) for own in hits] == [{"a": 2}, {"a": 1}, {}, {"ab": 1}, {}, {}, {"a": 1}]


def test_odd_and_empty_tables(spark, odd_documents, no_documents, monkeypatch):
    items = spark.createDataFrame(
        [(1, "Plain WORDS in a plain line -- said by no one in particular"), (2, None), (3, "word " * 20), (4, "x" * 100)],
        "item_id int, text string",
    )
    expected = None
    for block_chars in (decontaminate.BLOCK_CHARS, 100):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block_chars)
        rows = find_items(odd_documents, "doc_id", "text", items, "item_id", "text").collect()
        found = Counter((r.doc_id, r.item_id) for r in rows)
        assert found[(1, 1)] == found[(5, 1)] == 1
        assert 0.9 * 1500 < found[(8, 3)] <= 1500 and 0.9 * 700 < found[(9, 4)] <= 700
        assert set(found) == {(1, 1), (5, 1), (8, 3), (9, 4)}
        expected = expected or sorted(map(tuple, rows))
        assert sorted(map(tuple, rows)) == expected
        kept = drop_contaminated(odd_documents, "text", items, "item_id", "text")
        assert kept.columns == odd_documents.columns
        left = Counter(r[0] for r in kept.collect())
        assert left == Counter(r[0] for r in odd_documents.collect()) - Counter([1, 5, 8, 9])
    assert find_items(no_documents, "doc_id", "text", items, "item_id", "text").count() == 0
    assert find_items(odd_documents, "doc_id", "text", items.limit(0), "item_id", "text").count() == 0
    assert drop_contaminated(no_documents, "text", items, "item_id", "text").count() == 0


def test_given_documents(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = {r.item_id: r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    texts = {r[0]: r[1] for r in pick(documents, i="doc_id", t="text").collect()}
    rows = op6_decontamination(spark, FOLDER).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    whole = {(d, i) for d, t in texts.items() for i, item in items.items() if plain(item) in plain(t)}
    assert whole and whole <= found
    for r in rows:
        assert distance(plain(items[r.item_id]), plain(texts[r.doc_id][r.start : r.end])) == r.edits


def test_a_budget_of_nothing_finds_exact_passages_only(spark):
    items = spark.createDataFrame([(1, "one line of a test that must stay out")], "item_id int, text string")
    df = spark.createDataFrame([(1, "X one line of a test that must stay out."), (2, "one line of a test that must stay in")], "doc_id int, text string")
    found = find_items(df, "doc_id", "text", items, "item_id", "text", budget=0.0).collect()
    assert [(r.doc_id, r.start, r.end, r.edits) for r in found] == [(1, 2, 39, 0)]
    with pytest.raises(ValueError):
        find_items(df, "doc_id", "none", items, "item_id", "text")
