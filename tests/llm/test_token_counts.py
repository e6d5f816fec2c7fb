from __future__ import annotations

import random

from tokenizers import Tokenizer, models, pre_tokenizers

from orderflow.llm.queries import vocabulary_file
from orderflow.llm.token_counts import PieceAutomaton, byte_pieces, count_tokens


def greedy(word: bytes, initial: set, continuation: set) -> int:
    """Longest match by trying every length."""
    at, count = 0, 0
    while at < len(word):
        pieces = continuation if at else initial
        for end in range(len(word), at, -1):
            if word[at:end] in pieces:
                break
        else:
            return -1
        at, count = end, count + 1
    return count


def test_random_vocabularies_against_greedy_search():
    rng = random.Random(3)
    for _ in range(300):
        pieces = lambda: {bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(rng.randint(0, 12))}
        initial, continuation = pieces(), pieces()
        words = [bytes(rng.choices(b"abcd", k=rng.choice([0, 1, 2, 5, 9, 80]), weights=[8, 8, 8, 1])) for _ in range(40)]
        two = PieceAutomaton(initial, continuation)
        one = PieceAutomaton(initial)
        assert two.count(words).tolist() == [greedy(w, initial, continuation) for w in words]
        assert one.count(words).tolist() == [greedy(w, initial, initial) for w in words]


def test_against_a_public_word_piece_model():
    rng = random.Random(4)
    first = {"".join(rng.choices("abcdé", k=rng.randint(1, 4))) for _ in range(60)}
    later = {"".join(rng.choices("abcdé", k=rng.randint(1, 3))) for _ in range(40)}
    vocabulary = {p: i for i, p in enumerate(["[UNK]", *sorted(first), *("##" + p for p in sorted(later))])}
    model = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=1000))
    model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    automaton = PieceAutomaton([p.encode() for p in first], [p.encode() for p in later])
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 30))) for _ in range(500)]
    expected = [-1 if "[UNK]" in e.tokens else len(e.tokens) for e in model.encode_batch(words)]
    assert automaton.count([w.encode() for w in words]).tolist() == expected


def test_whole_texts(spark, odd_documents, no_documents):
    vocabulary = byte_pieces(vocabulary_file())
    automaton = PieceAutomaton(vocabulary)
    plain = odd_documents.drop("n_tokens")
    found = count_tokens(odd_documents, automaton, "doc_id", "text", lead=b" ").collect()
    texts = [(r[0], r[1]) for r in plain.collect()]
    longest = max(map(len, vocabulary))
    assert [r.doc_id for r in found] == [i for i, _ in texts]
    for row, (_, text) in zip(found, texts, strict=True):
        words = (text or "").encode().split()
        total = 0
        for word in words:
            left = b" " + word
            while left:
                end = next(e for e in range(min(longest, len(left)), 0, -1) if left[:e] in vocabulary)
                left, total = left[end:], total + 1
        assert (row.n_words, row.n_tokens, row.n_unknown) == (len(words), total, 0)
    assert count_tokens(no_documents, automaton, "doc_id", "text").count() == 0
    empty = count_tokens(odd_documents, PieceAutomaton([]), "doc_id", "text").collect()
    assert all(r.n_tokens == r.n_words == r.n_unknown for r in empty)


def test_long_words_are_counted_each_time_and_not_kept(spark):
    automaton = PieceAutomaton([b"a", b"aa", b"b"])
    long_word, unknown = "a" * 5001, "a" * 300 + "?"
    texts = [(i, f"{long_word} b {unknown} {long_word}") for i in range(5)]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    found = {tuple(r)[1:] for r in count_tokens(df, automaton, "doc_id", "text").collect()}
    assert found == {(4, 2501 + 1 + 1 + 2501, 1)}
