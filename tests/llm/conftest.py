from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

#: Rows with nulls, empty and odd texts, ties and repeats; a clashing and a further column.
ODD_TEXTS = [
    (1, "Plain words in a plain line, said by no one in particular."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\x0c\r "),
    (5, "Plain words in a plain line, said by no one in particular."),
    (6, "a"),
    (7, "é ü ß 漢字 🙂 é \x00 \x1c end"),
    (8, "word " * 30_000),
    (9, "x" * 70_000),
    (None, "A row without an id."),
    (10, "<|endoftext|> and #*$%&|<> symbols"),
    (10, "<|endoftext|> and #*$%&|<> symbols"),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    rows = [
        (i, text, "en" if n % 3 else None, f"src{n % 2}", len(text or ""), "TEXT", n)
        for n, (i, text) in enumerate(ODD_TEXTS)
    ]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, `Text` string, n_tokens int",
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
