"""Sharding: counts at most one apart, gapless slots, a sequential ring as brute force, limited movement."""

from __future__ import annotations

import zlib

import pytest
import xxhash

from orderscope.llm import sharding
from orderscope.llm.sharding import CELL_BITS, capacities, sharded

from .conftest import AWKWARD, DOCS, REPEATED


def test_rows_law_sizes_and_slots(spark):
    docs = AWKWARD + REPEATED + [(i, f"text {i}") for i in range(100, 300)]
    rows = sharded(spark.createDataFrame(docs, DOCS).repartition(5), shards=7).collect()
    assert len(rows) == len(docs)
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    counts = [len(by_shard.get(s, [])) for s in range(7)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append(((len((t or "").encode()) + 1), zlib.crc32((t or "").encode())))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.size, r.text_crc32))
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in texts.items()}


def walk(keys, owners, room):
    """Brute force: arcs offer the keys they have left, in place order, to their next shard clockwise."""
    arcs = sharding.clockwise(owners)
    waiting = [[k for k in keys if first <= k[0] < end] for first, end, _ in arcs]
    shard_of = {}
    for turn in range(len(room)):
        for (_, _, way), left in zip(arcs, waiting, strict=True):
            while left and turn < len(way) and room[way[turn]]:
                shard_of[left.pop(0)] = way[turn]
                room[way[turn]] -= 1
    assert not any(waiting)
    return shard_of


@pytest.mark.parametrize("load", [1.0, 1.2])
def test_same_as_a_sequential_walk_round_the_ring(spark, load):
    ids = [i * 37 - 2000 for i in range(400)]
    rows = {r.doc_id: r for r in sharded(spark.createDataFrame([(i, "t") for i in ids], DOCS), shards=5, vnodes=8, load=load).collect()}
    # Spark's xxhash64 of a long: XXH64 of its eight little-endian bytes, seed 42
    place = {i: xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42) >> 1 for i in ids}
    keys = sorted((place[i] >> (63 - CELL_BITS), place[i], i) for i in ids)
    want = walk(keys, sharding.ring(5, 8), capacities(len(ids), 5, load))
    assert {i: rows[i].shard for i in ids} == {k[2]: s for k, s in want.items()}


def test_one_more_shard_moves_few_keys(spark):
    df = spark.createDataFrame([(i, "t") for i in range(4000)], DOCS)
    before = {r.doc_id: r.shard for r in sharded(df, shards=16, load=1.25).collect()}
    after = {r.doc_id: r.shard for r in sharded(df, shards=17, load=1.25).collect()}
    assert sum(before[i] != after[i] for i in before) < 0.15 * len(before)
    assert max(list(after.values()).count(s) for s in range(17)) <= capacities(4000, 17, 1.25)[0]


def test_empty_table_and_clashing_columns(empty, awkward):
    assert sharded(empty).collect() == []
    assert sharded(awkward).columns == ["doc_id", "size", "text_crc32", "shard", "slot", "home_shard"]
    assert sharded(awkward).count() == len(AWKWARD)


def test_more_shards_than_rows():
    assert capacities(3, 5, 1.0) == [1, 1, 1, 0, 0]
