from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from orderflow.llm.common import pick
from orderflow.llm.components import connected_components
from orderflow.llm.simhash import anchors_of, links, near_duplicates


def fingerprint_of(text) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def roots_of(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in (e for e in edges if e[0] != e[1]):
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {n: find(n) for n in nodes}


def test_every_word_has_one_home_and_all_anchors_near_it():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**32, 400)
    whose, which, home = anchors_of(words)
    distance = np.bitwise_count((words[whose] ^ which).astype(np.uint64))
    assert distance.max() <= 2 and distance[home].max() <= 1
    assert home.sum() == len(words) and len(set(zip(whose.tolist(), which.tolist()))) == len(whose)
    sent = set(zip(whose.tolist(), which.tolist()))
    homes = which[:400]
    for bit in range(32):
        moved = anchors_of(words ^ (1 << bit))
        assert all((i, int(h)) in sent for i, h in enumerate(moved[1][:400]))
    assert np.array_equal(anchors_of(homes)[1][:400], homes)


def test_links_lose_no_pair(spark):
    rng = random.Random(2)
    fps = {0, 2**64 - 1, 1, 3, 7}
    for _ in range(60):
        centre = rng.getrandbits(64)
        for _ in range(12):
            moved = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                moved ^= 1 << bit
            fps.add(moved)
    fps = sorted(fps)
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    for distance in (0, 1, 2, 3):
        found = {frozenset((r.a, r.b)) for r in links(nodes, distance).collect()}
        assert found == {
            frozenset((signed(x), signed(y)))
            for i, x in enumerate(fps)
            for y in fps[:i]
            if (x ^ y).bit_count() <= distance
        }
    with pytest.raises(ValueError):
        links(nodes, 4)


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)]
    edges += [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(-5, -9), (7, 7)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.root for r in connected_components(df).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert found == roots_of(nodes, edges)
    assert connected_components(df.limit(0)).count() == 0


def check(df):
    rows = [tuple(r) for r in pick(df, i="doc_id", t="text").collect()]
    found = near_duplicates(df, "doc_id", "text").collect()
    prints = [fingerprint_of(t) for _, t in rows]
    distinct = sorted(set(prints))
    edges = [(x, y) for n, x in enumerate(distinct) for y in distinct[:n] if (x ^ y).bit_count() <= 2]
    roots = roots_of(distinct, edges)
    least = {}
    for (i, _), f in zip(rows, prints, strict=True):
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    expected = sorted(((i, signed(f), least.get(roots[f])) for (i, _), f in zip(rows, prints, strict=True)), key=repr)
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in found), key=repr) == expected
    return expected


def test_documents_against_all_pairs(spark, odd_documents, no_documents):
    check(odd_documents)
    assert check(no_documents) == []
    rng = random.Random(4)
    base = [f"w{rng.randrange(50)}" for _ in range(400)]
    texts = [" ".join(base)] * 30
    for _ in range(80):
        changed = list(base)
        changed[rng.randrange(400)] = "Other"
        texts.append(" ".join(changed))
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id bigint, text string")
    assert len({c for *_, c in check(df)}) < 40
