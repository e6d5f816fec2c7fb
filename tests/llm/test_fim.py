"""Fill-in-middle against its definition, and the boundary set against a sorted list."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderflow.llm import fim
from orderflow.llm.common import pick
from orderflow.llm.fim import BoundarySet, Settings, fill_in_middle, restored


def by_definition(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    if not text or re.search("<P>|<S>|<M>", text) or h[2] % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < spm:
        return (doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


TEXTS = [
    "one\ntwo\nthree", "one\ntwo\n", "\n", "\n\n\n\n", "no break", "a\r\nb c\x0bd\n", "has <P> in it\nx",
    "漢字\n🙂🙂\né", "<M>", "< P>\n<p>", "line\n" * 30_000, "\n" * 70_000, "x" * 200_000 + "\ny", "$1\\E\n\\Q",
]


@pytest.fixture(scope="module")
def documents(spark, odd_documents):
    more = [(100 + 50 * k + i, t) for i, t in enumerate(TEXTS) for k in range(3)]
    return pick(odd_documents, doc_id="doc_id", text="text").union(spark.createDataFrame(more, "doc_id bigint, text string"))


@pytest.mark.parametrize("setting", [Settings(), Settings(seed=3, rate=60, spm=20)])
def test_cuts_as_defined_and_restores(documents, setting):
    cut = fill_in_middle(documents, "doc_id", "text", setting)
    rows = cut.select("*", restored(F.col("output"), F.col("form")).alias("back")).collect()
    expected = [by_definition(*r, setting.seed, setting.rate, setting.spm) for r in documents.collect()]
    key = lambda r: (str(r[0]), r[5])
    assert sorted((tuple(r)[:6] for r in rows), key=key) == sorted(expected, key=key)
    assert sorted(r.back for r in rows) == sorted(r.text or "" for r in documents.collect())
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_further_columns_and_empty_table(odd_documents, no_documents):
    assert fill_in_middle(odd_documents, "doc_id", "text").count() == odd_documents.count()
    assert fill_in_middle(no_documents, "doc_id", "text").collect() == []


def test_containers_by_what_they_hold():
    kinds = lambda values: [type(c).__name__ for c in BoundarySet(np.array(values)).containers]
    some = np.random.default_rng(1).choice(65_536, 20_000, replace=False)
    assert kinds([3, 70_000, 200_001]) == ["ArrayContainer"] * 3
    assert kinds(range(10, 60_000)) == ["RunContainer"]
    assert kinds(np.sort(some)) == ["BitmapContainer"]


@settings(max_examples=60, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.integers(0, 300_000).map(lambda v: [v]),
            st.tuples(st.integers(0, 300_000), st.integers(1, 9_000)).map(lambda r: list(range(r[0], r[0] + r[1]))),
            st.tuples(st.integers(0, 300_000), st.integers(1, 9_000)).map(lambda r: list(range(r[0], r[0] + 3 * r[1], 3))),
        ),
        min_size=1,
        max_size=8,
    )
)
def test_select_is_the_sorted_list(parts):
    values = np.unique(np.concatenate([np.array(p) for p in parts]))
    found = BoundarySet(values)
    assert len(found) == len(values)
    assert (found.select(np.arange(len(values))) == values).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab\n\r🙂", max_size=30), max_size=6))
def test_line_ends_of_a_group(texts):
    offsets, units = fim.line_ends(texts)
    lines = [re.findall(r"[^\n]*\n|[^\n]+", t) for t in texts]
    assert units.tolist() == [len(x) for x in lines]
    assert offsets.tolist() == np.cumsum([len(u) for x in lines for u in x], dtype=int).tolist()
