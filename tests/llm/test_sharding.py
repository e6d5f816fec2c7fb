from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from orderflow.llm.common import pick
from orderflow.llm.sharding import jump_hash, shard_rows, with_shard, write_shards


def jump_of(key: int, shards: int) -> int:
    """The published loop, one key at a time."""
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_loop():
    keys = np.random.default_rng(5).integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2)
    for shards in (1, 2, 16, 17, 1000):
        assert jump_hash(keys, shards).tolist() == [jump_of(int(k), shards) for k in keys]


def test_growth_moves_rows_only_into_the_new_shard():
    keys = np.random.default_rng(6).integers(0, 2**63, 20_000).astype(np.uint64)
    for shards in (1, 5, 16):
        old, new = jump_hash(keys, shards), jump_hash(keys, shards + 1)
        moved = new[old != new]
        assert set(moved) == {shards}
        assert abs(len(moved) / len(keys) - 1 / (shards + 1)) < 0.02
        assert max(Counter(old.tolist()).values()) < 1.15 * len(keys) / shards


def test_rows_places_and_odd_texts(spark, odd_documents):
    rows = shard_rows(odd_documents.repartition(3), "doc_id", "text", 4).collect()
    sent = pick(odd_documents, doc_id="doc_id", text="text").collect()
    found = Counter((r.doc_id, r["size"], r.text_crc32) for r in rows)
    expected = Counter()
    for r in sent:
        data = (r[1] or "").encode()
        expected[(r[0], len(data) + 1, zlib.crc32(data))] += 1
    assert found == expected
    places, shards = defaultdict(list), defaultdict(set)
    for r in rows:
        places[r.shard].append(r.slot)
        shards[r.doc_id].add((r.shard, r.grown_shard))
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert all(len(s) == 1 for s in shards.values())


def test_hot_key_and_empty_table(spark, no_documents):
    hot = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit("same").alias("text"))
    rows = shard_rows(hot, "doc_id", "text", 16).collect()
    assert len({r.shard for r in rows}) == 1
    assert sorted(r.slot for r in rows) == list(range(3000))
    assert shard_rows(no_documents, "doc_id", "text", 16).count() == 0


def test_written_shards_hold_whole_rows(spark, tmp_path):
    rows = spark.range(500).selectExpr("concat('k', id) as key", "id as value")
    write_shards(rows, str(tmp_path / "out"), "key", 8)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.key, r.value) for r in back.collect()} == {(f"k{i}", i) for i in range(500)}
    again = {(r.key, r.shard) for r in with_shard(rows, "key", 8).collect()}
    assert {(r.key, r.shard) for r in back.collect()} == again
