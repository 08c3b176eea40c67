"""Periodic runs: every run against a scan of all lags, the collapsed text, awkward texts."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from orderscope.llm import periodic
from orderscope.llm.frames import read
from orderscope.llm.periodic import collapsed, looped, periodic_runs, runs_of_documents, surviving_segments
from orderscope.llm.queries import op12_periodic

from .conftest import AWKWARD, DOCS, REPEATED, white_words

SF = "/root/testdata/sf0.01"


def plain_runs(words, least=12):
    """Every lag from 1 up; of equal stretches the smallest lag counts."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(least, 2 * q):
                out.setdefault((s, i - s + q), q)
            i += 1
    return sorted(((s, n_, q) for (s, n_), q in out.items()), key=lambda r: (r[0], r[2]))


def got(docs, least=12):
    rows, doc = runs_of_documents(docs, least)
    return [[tuple(r) for r in rows[doc == d].tolist()] for d in range(len(docs))]


WORD = st.sampled_from([b"a", b"b", b"c"])
BLOCK = st.lists(WORD, min_size=1, max_size=9)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(
    st.lists(WORD, max_size=90),
    st.tuples(BLOCK, BLOCK, st.lists(st.integers(0, 5), max_size=12)).map(
        lambda x: [w for i, m in enumerate(x[2]) for w in x[i % 2] * m]),
    st.tuples(BLOCK, st.integers(2, 6), BLOCK, st.integers(1, 3)).map(lambda x: (x[0] * x[1] + x[2]) * x[3])), max_size=5),
    st.sampled_from([2, 5, 12, 30]))
def test_all_runs_of_small_alphabets(docs, least):
    assert got(docs, least) == [plain_runs(d, least) for d in docs]


def test_periods_inside_runs_of_shorter_periods():
    fibonacci, last = [b"a", b"b"], [b"a"]
    while len(fibonacci) < 400:
        fibonacci, last = fibonacci + last, fibonacci
    broken = [b"a", b"b"] * 9 + [b"a"]
    nested = (broken * 3 + [b"c"]) * 3
    spaced = ([b"x"] * 20 + [b"y"]) * 4 + [b"x"] * 7
    for words in (fibonacci, broken * 2, nested, spaced, nested + spaced + nested):
        assert got([words]) == [plain_runs(words)]


def test_splitting_ends_where_every_word_repeats_in_its_segment():
    rng = random.Random(3)
    docs = [[rng.randrange(m) for _ in range(rng.randrange(200))] for m in (2, 10, 40, 90, 200)]
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    flat = np.array([w for d in docs for w in d])
    low, high, pair = surviving_segments(flat, first, 5)

    def plain(a, b):
        words = flat[a:b].tolist()
        cuts = [a + i for i, w in enumerate(words) if words.count(w) == 1]
        if not cuts:
            return [(a, b)] if b - a >= 5 else []
        return [s for x, y in zip([a, *[c + 1 for c in cuts]], [*cuts, b], strict=True) for s in plain(x, y)]
    assert list(zip(low.tolist(), high.tolist(), strict=True)) == [s for a, b in zip(first[:-1], first[1:], strict=True) for s in plain(int(a), int(b))]
    for a, b in zip(low, high, strict=True):
        assert len(np.unique(pair[a:b])) == len(np.unique(flat[a:b]))


def test_long_documents_are_not_quadratic():
    rng = random.Random(1)
    third = [b"%d" % rng.randrange(30_000) for _ in range(50_000)]
    peeled = [b"1", b"U"] + [w for i in range(2, 10_000) for w in (b"%d" % i, b"%d" % (i - 1))]
    began = time.time()
    assert got([third * 3, [b"a"] * 150_000, peeled]) == [[(0, 150_000, 50_000)], [(0, 150_000, 1)], []]
    assert time.time() - began < 30


def plain_looped(key, words):
    h, n = zlib.crc32(str(key).encode()), len(words)
    if h % 10 or not n:
        return words
    a, p = (h // 10) % n, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query_on_the_driver_table(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    rows = op12_periodic(spark, SF).collect()
    assert len(rows) == len(texts)
    runs = 0
    for r in rows:
        words = plain_looped(r.doc_id, white_words(texts[r.doc_id]))
        assert [w.decode() for w in looped(r.doc_id, [w.encode() for w in white_words(texts[r.doc_id])])] == words
        if len(words) > 700:
            continue
        expected = plain_runs(words)
        runs += len(expected)
        assert r.n_runs == len(expected)
        assert r.runs_sha256 == periodic.runs_digest(expected)
        dropped = {i for s, n, q in expected for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        best = min(expected, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (best[1] and 1000 * best[1] // best[2])
    assert runs > 50


def test_defined_cases(spark, empty, awkward):
    assert periodic_runs(empty).collect() == []
    rows = {r.doc_id: r for r in periodic_runs(awkward).collect()}
    assert len(rows) == len(AWKWARD) and periodic_runs(spark.createDataFrame(REPEATED, DOCS)).count() == 3
    for i in (2, 3, 4):
        assert (rows[i].n_words, rows[i].n_runs, rows[i].start, rows[i].length, rows[i].period, rows[i].kept_text) == (0, 0, None, None, None, "")
    assert (rows[10].n_runs, rows[10].length, rows[10].period, rows[10].kept_text) == (1, 22, 1, "same")
    assert looped(None, [b"a"]) == [b"a"] and collapsed([b"a"], np.zeros((0, 3), int)) == [b"a"]
    clash = spark.createDataFrame([(1, "a " * 12, "b", 5)], "doc_id long, text string, Text string, DOC_ID int")
    assert [(r.doc_id, r.n_runs, r.kept_text) for r in periodic_runs(clash).collect()] == [(1, 1, "a")]


def test_results_do_not_depend_on_pieces(spark, monkeypatch):
    docs = read(spark, SF, "documents").limit(300).cache()
    whole = {r.doc_id: r for r in periodic_runs(docs, edit=looped).collect()}
    monkeypatch.setattr(periodic, "PIECE_BYTES", 1000)
    assert {r.doc_id: r for r in periodic_runs(docs, edit=looped).collect()} == whole
