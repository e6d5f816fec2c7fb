from __future__ import annotations

import random
import zlib

from pyspark.sql import functions as F

from orderflow.llm import language
from orderflow.llm.common import pick
from orderflow.llm.language import (
    STRETCH,
    CrossParser,
    SuffixAutomaton,
    held_out,
    identify_languages,
    keep_identified,
    letters_only,
    sample_texts,
)
from orderflow.llm.queries import op8_language_id

FOLDER = "/root/testdata/sf0.001"


def phrases_of(text: str, sample: str) -> int:
    """Longest phrases that occur in the sample, found by searching it."""
    at = count = 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        at, count = end, count + 1
    return count


def test_automaton_holds_exactly_the_substrings():
    rng = random.Random(1)
    for _ in range(50):
        text = rng.choices(range(3), k=rng.randint(1, 30))
        automaton = SuffixAutomaton(text)
        for _ in range(60):
            probe = rng.choices(range(4), k=rng.randint(1, 6))
            state = 0
            for letter in probe:
                state = automaton.next[state].get(letter) if state is not None else None
            inside = any(text[i : i + len(probe)] == probe for i in range(len(text)))
            assert (state is not None) == inside


def test_phrases_against_searching():
    rng = random.Random(2)
    letters = "abcdeß é"
    samples = {k: "".join(rng.choices(letters, weights, k=600)) for k, weights in (("x", range(1, 9)), ("y", range(8, 0, -1)))}
    parser = CrossParser(samples)
    plain = {k: letters_only(v) for k, v in samples.items()}
    for length in (0, 1, 5, 300, STRETCH, 3 * STRETCH + 7):
        text = letters_only("".join(rng.choices(letters + "zñ漢", k=length)))
        codes = parser.encode(text)
        assert len(codes) == len(text)
        cut = [codes[i : i + STRETCH] for i in range(0, len(codes), STRETCH)]
        found = parser.phrases(cut).sum(axis=0).tolist() if cut else [0, 0]
        assert found == [
            sum(phrases_of(text[i : i + STRETCH], plain[k]) for i in range(0, len(text), STRETCH))
            for k in parser.languages
        ]


def test_held_out_accuracy(spark):
    rows = op8_language_id(spark, FOLDER).collect()
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    kept = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert len(rows) == len(labels) and len(kept) > 40
    assert sum(labels[r.doc_id] == r.lang_pred for r in kept) / len(kept) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    other = df.withColumn("lang", F.when(held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    other = other.withColumn("source", F.lit(None).cast("string"))
    assert sample_texts(df, "doc_id", "text", "lang") == sample_texts(other, "doc_id", "text", "lang")
    assert sample_texts(df.repartition(7), "doc_id", "text", "lang") == sample_texts(df, "doc_id", "text", "lang")


def unheld(count: int, start: int = 10_000_000) -> list[int]:
    return [i for i in range(start, start + 4 * count + 9) if zlib.crc32(str(i).encode()) % 3 != 1][:count]


def test_rare_and_letterless_labels_cut_no_other_sample(spark):
    df = pick(spark.read.parquet(f"{FOLDER}/documents.parquet"), doc_id="doc_id", text="text", lang="lang")
    rare = "tämä on harvinainen kieli jota puhutaan vain täällä pohjoisessa metsässä järven rannalla " * 3
    first, second = unheld(2)
    more = spark.createDataFrame([(first, rare, "fi"), (second, "12 34 5678 " * 40, "digits")], df.schema)
    before = sample_texts(df, "doc_id", "text", "lang")
    samples = sample_texts(df.unionByName(more), "doc_id", "text", "lang")
    assert samples.keys() == before.keys() | {"fi"}
    assert all(samples[k] == before[k] for k in before) and min(map(len, before.values())) > 2_000
    found = identify_languages(df.unionByName(more), "doc_id", "text", samples).collect()
    labels = {r.doc_id: r.lang for r in df.collect()}
    hits = [labels[r.doc_id] == r.lang_pred for r in found if r.doc_id in labels]
    assert sum(hits) / len(hits) > 0.97
    assert {r.lang_pred for r in found if r.doc_id in (first, second)} == {"fi", "und"}


def test_texts_of_any_length_are_learned(spark):
    df = pick(spark.read.parquet(f"{FOLDER}/documents.parquet"), doc_id="doc_id", text="text", lang="lang")
    short = df.withColumn("text", F.substring("text", 1, 150))
    assert short.agg(F.max(F.length("text"))).first()[0] < 200
    # A label of many titles and one of a single book fill their samples as far as they can.
    ids = unheld(402)
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choices(letters, k=6))
    more = [(i, word("abcde") + " " + word("abcde"), "titles") for i in ids[:400]]
    more += [(ids[400], " ".join(word("vwxyz") for _ in range(9_000)), "book"), (ids[401], "7 æ 7", "letter")]
    table = short.unionByName(spark.createDataFrame(more, df.schema))
    samples = sample_texts(table, "doc_id", "text", "lang")
    labels = {r.lang for r in df.where("text is not null and lang is not null").select("lang").distinct().collect()}
    assert samples.keys() == labels | {"titles", "book", "letter"}
    assert len(samples["book"]) == 40_000 and len(samples["titles"]) == 400 * 14 - 1
    assert samples["letter"] == "æ"
    found = {r.doc_id: r.lang_pred for r in identify_languages(df, "doc_id", "text", samples).collect()}
    hits = [r.lang == found[r.doc_id] for r in df.collect()]
    assert sum(hits) / len(hits) > 0.95
    assert keep_identified(table, "text", samples).count() == table.where(F.col("text").rlike(r"\p{L}")).count()


def test_copies_do_not_leave_a_sample_short(spark):
    ids = unheld(300)
    rows = [(ids[0], "same words in every copy of it " * 80, "xx")] * 3_000
    rows += [(i, f"{'abcdefghij'[n % 10] * 3} {'klmnopqrst'[n % 9] * 3} " * 300, "xx") for n, i in enumerate(ids[1:])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert len(sample_texts(df, "doc_id", "text", "lang")["xx"]) == 40_000


def test_a_shared_header_is_not_what_is_learned(spark):
    rng = random.Random(4)
    header = " ".join("".join(rng.choices("vwxyz", k=6)) for _ in range(290))
    body = lambda: " ".join("".join(rng.choices("abcde", k=6)) for _ in range(2_000))
    ids = unheld(60)
    df = spark.createDataFrame([(i, f"{header} {body()}", "xx") for i in ids], "doc_id bigint, text string, lang string")
    sample = sample_texts(df, "doc_id", "text", "lang")["xx"]
    assert len(sample) == 40_000
    assert sum(c in "vwxyz" for c in sample) < 0.4 * len(sample)


def test_one_id_of_many_rows_brings_no_more_than_its_letters(spark, monkeypatch):
    the_id = unheld(1)[0]
    df = spark.range(4_000).selectExpr(f"{the_id}L doc_id", "repeat(concat('abc', char(97 + id % 26), ' ', translate(id, '0123456789', 'klmnopqrst'), ' '), 250) text", "'xx' lang")
    taken, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: taken.append(collect(self)) or taken[-1])
    assert len(sample_texts(df, "doc_id", "text", "lang")["xx"]) == 40_000
    assert sum(len(r.piece) for rows in taken for r in rows if "piece" in r) <= 42_100


def test_phrases_are_priced_by_the_size_of_their_sample():
    samples = {"x": "the words and lines of this long sample are many " * 90, "y": "die wörter"}
    parser = CrossParser(samples)
    assert parser.predict(["many words of this sample", "die wörter"])[0] == ["x", "y"]
    # Letters that no sample has tie, whatever the sizes.
    assert parser.predict(["漢字"]) == (["x"], [0.0])


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    samples = {"en": "the words and lines of this language " * 9, "de": "die wörter und zeilen dieser sprache " * 9}
    found = identify_languages(odd_documents, "doc_id", "text", samples).collect()
    texts = [r[0] for r in pick(odd_documents, t="text").collect()]
    for row, text in zip(found, texts, strict=True):
        letters = any(c.isalpha() for c in text or "")
        assert (row.lang_pred == "und") == (not letters)
        assert 0 <= row.score <= 1
    assert found[0].lang_pred == "en" and found[0].lang_pred == found[4].lang_pred
    nothing = identify_languages(odd_documents, "doc_id", "text", {}).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert identify_languages(no_documents, "doc_id", "text", samples).count() == 0
    assert sample_texts(no_documents, "doc_id", "text", "lang") == {}


def test_large_alphabets_take_bounded_room_and_change_nothing(monkeypatch):
    rng = random.Random(8)
    words = lambda letters, n: " ".join("".join(rng.choices(letters, k=rng.randrange(1, 7))) for _ in range(n))
    han = [chr(0x4E00 + i) for i in range(3000)]
    kinds = {k: sorted(rng.sample("abcdefghijklmnopqrstuvwxyzäöüßéèñ", 20)) for k in ("aa", "bb", "cc", "dd")} | {"zh": han}
    samples = {k: words(letters, 12_000)[:40_000] for k, letters in kinds.items()}
    parser = CrossParser(samples)
    assert parser.width > 3000 and parser.nbytes < 200_000_000
    few = {k: v[:1500] for k, v in samples.items()}
    texts = [words(kinds[k], 30) for k in kinds for _ in range(8)] + [words(kinds["aa"] + han[:50], 40), "", None, "Ж ж", "漢字 aa"]
    found = CrossParser(few).predict(texts)
    for dense in (1, 7, 5000):
        monkeypatch.setattr(language, "DENSE", dense)
        assert CrossParser(few).predict(texts) == found
    monkeypatch.undo()
    labels = parser.predict(texts)[0][: 8 * len(kinds)]
    assert labels == [k for k in kinds for _ in range(8)]
