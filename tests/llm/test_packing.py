"""Packing: every word in one place, bins within their length, costs no worse than one fixed length."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from orderscope.llm import packing
from orderscope.llm.packing import CAPACITIES, best_fit, cost, pack, packed, shrunk, token_packed
from orderscope.llm.token_counts import VOCABULARY, Encoder, token_lengths

from .conftest import AWKWARD, DOCS, REPEATED, white_words


def check(rows, want):
    """``want``: (id, length) of every document row; pieces of a row follow each other."""
    total = {}
    bins = {}
    for r in rows:
        assert r.start == r.piece * CAPACITIES[-1]
        if r.length == 0:
            assert r.bin_id is None and r.bin_capacity is None
            continue
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
        bins.setdefault(r.bin_id, []).append(r)
    expected = {}
    for i, n in want:
        if n:
            expected[i] = expected.get(i, 0) + n
    assert total == expected
    for inside in bins.values():
        inside.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in inside:
            assert r.bin_offset == at
            at += r.length
        assert {r.bin_used for r in inside} == {at}
        assert {r.bin_capacity for r in inside} == {shrunk(at, CAPACITIES)}


def lengths_of(docs):
    return [(i, len(white_words(t)) + 1 if white_words(t) else 0) for i, t in docs]


def test_awkward_documents(spark):
    docs = AWKWARD + REPEATED
    rows = packed(spark.createDataFrame(docs, DOCS)).collect()
    check(rows, lengths_of(docs))
    assert sum(r.doc_id == 11 for r in rows) == 3
    assert sum(r.doc_id == 9 for r in rows) == -(-60_001 // 4096)


def test_many_groups_cover_every_piece(spark):
    rnd = random.Random(1)
    docs = [(i, "w " * rnd.choice([3, 40, 300, 700, 5000])) for i in range(300)]
    rows = packed(spark.createDataFrame(docs, DOCS).repartition(4), group_pieces=60).collect()
    check(rows, lengths_of(docs))
    assert len({r.bin_id >> 32 for r in rows if r.bin_id is not None}) == 5


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, used = best_fit(np.array([3000, 2500, 1000, 900]), CAPACITIES, 4096)
    assert bins.tolist() == [0, 1, 0, 1] and offsets.tolist() == [0, 0, 3000, 2500] and used == [4000, 3400]


def slow_best_fit(lengths, capacities, limit):
    """One bin after the other: of the open bins that hold the piece the one with least room, then the oldest."""
    rooms, used, bins, offsets, since = [], [], [], [], {}
    for i, n in enumerate(lengths):
        fitting = [b for b in range(len(rooms)) if rooms[b] >= n]
        if fitting:
            # bins of one room queue up in the order in which they came to it
            b = min(fitting, key=lambda b: (rooms[b], since[b]))
        else:
            least = min(c for c in capacities if c >= n)
            beside = lambda c: sum(x for x in lengths if x <= min(c - n, n))
            c = min([c for c in capacities if c >= n and (c <= limit or c == least)], key=lambda c: cost(c) / min(c, n + beside(c)))
            b = len(rooms)
            rooms.append(c)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        rooms[b] -= n
        since[b] = i
    return bins, offsets, used


def test_every_piece_goes_where_a_slow_best_fit_puts_it():
    rnd = random.Random(5)
    for _ in range(60):
        high = rnd.choice([5, 60, 700, 4096])
        lengths = sorted((rnd.randint(1, high) for _ in range(rnd.randint(1, 90))), reverse=True)
        capacities = rnd.choice([CAPACITIES, (high,), (high // 2 + 1, high * 2)])
        capacities = tuple(sorted({c for c in capacities if c} | ({high} if max(capacities) < high else set())))
        for limit in capacities:
            bins, offsets, used = best_fit(np.array(lengths), capacities, limit)
            assert (bins.tolist(), offsets.tolist(), used) == slow_best_fit(lengths, capacities, limit)


def test_lengths_are_tokens_of_the_vocabulary(spark, empty):
    encode = Encoder(open(VOCABULARY, "rb").read()).encoding.encode_ordinary
    docs = AWKWARD + REPEATED + [(50, "x" * 20_000)]
    rows = token_packed(spark.createDataFrame(docs, DOCS).repartition(3)).collect()
    check(rows, [(i, len(encode(t)) + 1 if t else 0) for i, t in docs])
    assert {r.doc_id: r.n_tokens for r in token_lengths(spark.createDataFrame(AWKWARD, DOCS)).collect()} == {i: len(encode(t or "")) for i, t in AWKWARD}
    assert token_packed(empty).collect() == []


def test_lengths_are_weighed_jointly_and_bins_shrink():
    rnd = random.Random(2)
    for _ in range(20):
        lengths = np.sort([rnd.randint(1, 4096) for _ in range(rnd.randint(1, 200))])[::-1]
        _, _, used, final = pack(lengths, CAPACITIES)
        assert all(u <= f and f == shrunk(u, CAPACITIES) for u, f in zip(used, final, strict=True))
        total = sum(map(cost, final))
        for limit in CAPACITIES:
            _, _, other = best_fit(lengths, CAPACITIES, limit)
            assert total <= sum(cost(shrunk(u, CAPACITIES)) for u in other) + 1e-9


def test_own_lengths_empty_table_and_clashing_columns(spark, empty, awkward):
    assert packed(empty).collect() == []
    assert packed(awkward).columns == ["doc_id", "piece", "start", "length", "bin_id", "bin_capacity", "bin_used", "bin_offset"]
    df = spark.createDataFrame([(1, 600), (2, 400), (3, None)], "doc_id long, n long")
    rows = packed(df, length=F.coalesce("n", F.lit(0))).collect()
    assert {(r.doc_id, r.bin_capacity) for r in rows} == {(1, 1024), (2, 1024), (3, None)}
    assert packing.cost(512) < packing.cost(4096)


def test_groups_are_bounded_for_long_documents(spark):
    """A few documents of many pieces are dealt by pieces, not by documents."""
    df = spark.createDataFrame([(i, 1_000_000) for i in range(10)], "doc_id long, n long")
    rows = packed(df, length=F.col("n"), group_pieces=100).collect()
    sizes = Counter(r.bin_id >> 32 for r in rows)
    assert len(rows) == 10 * 245 and len(sizes) == 13 and max(sizes.values()) < 300
