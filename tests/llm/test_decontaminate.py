"""Decontamination against brute force, in one block and in many."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from orderscope.llm import decontaminate
from orderscope.llm.decontaminate import matches

from .conftest import AWKWARD, DOCS, REPEATED, plain_words

ITEMS = "item_id long, text string"


def brute(docs, items, window=10):
    windows = {}
    for i, text in items:
        w = plain_words(text)
        for a in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[a:a + window]), set()).add("" if i is None else str(i))
    lengths, out = {len(w) for w in windows}, []
    for i, text in docs:
        w = plain_words(text)
        hit, found = [False] * len(w), set()
        for n in lengths:
            for a in range(len(w) - n + 1):
                key = tuple(w[a:a + n])
                if key in windows:
                    found |= windows[key]
                    hit[a:a + n] = [True] * n
        out.append((i, len(w), sum(hit), sorted(found)))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_words", [1 << 20, 100])
def test_matches_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontaminate, "CANDIDATES_AT_ONCE", 50)
    rnd = random.Random(3)
    words = ["the", "of", "a", "Éa", "ÀB", *[f"w{k}" for k in range(25)]]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([0, 1, 3, 9, 10, 11, 30])))) for i in range(24)]
    items += [(99, None), (None, "w1 w2 w3"), (5, "w7 w8 of the w9")]
    docs = list(AWKWARD) + list(REPEATED)
    for i in range(100, 200):
        w = rnd.choices(words, k=rnd.randint(0, 50))
        for _ in range(rnd.randint(0, 2)):
            w += (rnd.choice(items)[1] or "").split()[:rnd.randint(5, 40)]
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(w)))
    got = rows(matches(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS)))
    assert got == brute(docs, items)
    assert any(g[2] for g in got)


def brute_near(docs, items, window=10, slop=decontaminate.SLOP_WORDS, terms=decontaminate.NEAR_TERMS):
    """Items of whose windows the rarest different words (two at least) stand near the rarest one, without an exact match."""
    counts = Counter(w for _, text in docs for w in plain_words(text))
    out = []
    for i, text in docs:
        words = plain_words(text)
        places = {w: [p for p, x in enumerate(words) if x == w] for w in set(words)}
        near = set()
        for item, body in items:
            b = plain_words(body)
            for a in range(max(1, len(b) - window + 1)) if b else ():
                by_rarity = sorted(range(len(b[a:a + window])), key=lambda o: counts[b[a + o]])
                rare = list(dict.fromkeys(b[a + o] for o in by_rarity))[:terms]
                if len(rare) > 1 and any(all(any(abs(p - q) <= slop for q in places.get(w, ())) for w in rare[1:]) for p in places.get(rare[0], ())):
                    near.add("" if item is None else str(item))
        out.append((i, near))
    exact = {i: set(found) for i, _, _, found in brute(docs, items, window)}
    return sorted(((i, sorted(near - exact[i])) for i, near in out), key=str)


@pytest.mark.parametrize("block_words", [1 << 20, 100])
def test_proximity_matches_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block_words)
    monkeypatch.setattr(decontaminate, "CANDIDATES_AT_ONCE", 50)
    rnd = random.Random(8)
    words = [f"w{k}" for k in range(12)]
    items = [(i, " ".join(rnd.choices(rnd.sample(words, rnd.randint(1, 8)), k=rnd.choice([1, 2, 5, 10, 14])))) for i in range(30)]
    docs = [(i, " ".join(w for x in rnd.choices(words, k=rnd.randint(0, 12)) for w in [x, *["far"] * rnd.choice([0, 0, 8])])) for i in range(120)]
    out = matches(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)).collect()
    got = sorted(((r.doc_id, list(r.near_items)) for r in out), key=str)
    assert got == brute_near(docs, items) and sum(len(n) for _, n in got) > 50


def test_a_repeated_rare_word_does_not_hide_a_proximity_match(spark):
    body = " ".join("a" * 8)
    items = [(1, f"zed {body} b"), (2, f"zed zed {body[2:]} b"), (3, "a a a a a a a a a a")]
    docs = [(1, "zed x a b"), (2, "a a b"), (3, "b zed a y")]
    out = {r.doc_id: r.near_items for r in matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert out == {1: ["1", "2"], 2: [], 3: ["1", "2"]}


def test_hits_are_ranges_and_proximity_is_told_apart(spark):
    item = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    docs = [(1, "x alpha beta gamma delta epsilon zeta eta theta iota kappa y"),
            (2, "kappa of iota theta eta zeta epsilon delta gamma beta alpha"),       # near, not exact
            (3, "alpha " + "far " * 50 + "beta " + "far " * 50 + "gamma")]
    out = {r.doc_id: r for r in matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(item, ITEMS)).collect()}
    assert [(h.start, h.end) for h in out[1].hits] == [(1, 11)] and out[1].contaminated and not out[1].near_items
    assert out[2].near_items == ["1"] and not out[2].contaminated and out[2].n_hit == 0
    assert not out[3].near_items and not out[3].contaminated


def test_empty_tables_and_clashing_columns(spark, empty, awkward):
    items = spark.createDataFrame([(1, "a b c")], ITEMS)
    none = spark.createDataFrame([], ITEMS)
    assert matches(empty, items).collect() == []
    assert matches(awkward, none).filter("contaminated").count() == 0
    assert matches(awkward, none).count() == len(AWKWARD)
    assert matches(awkward, items).columns == ["doc_id", "n_words", "n_hit", "hits", "items", "near_items", "contaminated"]
