"""Substring dedup against brute force: repeats, runs, periods, nulls, long texts, repeated rows."""

from __future__ import annotations

import random

import pytest

from orderscope.llm.substring import WINDOW_WORDS, substring_dedup

from .conftest import AWKWARD, DOCS, white_words


def brute(docs, window):
    """Smallest id first (null before all), every window judged on the input."""
    seen, out = set(), {}
    for i, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        words = white_words(text)
        gone = [False] * len(words)
        for a in range(len(words) - window + 1):
            w = tuple(words[a:a + window])
            if w in seen:
                gone[a:a + window] = [True] * window
            seen.add(w)
        out[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return out


def check(spark, docs, window, parts=3):
    df = spark.createDataFrame(docs, DOCS).repartition(parts)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(df, window=window).collect()}
    assert got == brute(docs, window)
    return got


@pytest.mark.parametrize(("vocabulary", "window", "parts"), [(2, 20, 1), (4, 7, 3), (60, 20, 8), (1500, 20, 5)])
def test_matches_brute_force(spark, vocabulary, window, parts):
    rnd = random.Random(vocabulary)
    words = [f"w{k}" if k % 3 else f"länger-{k}-" + "x" * 20 for k in range(vocabulary)]
    base = [rnd.choices(words, k=rnd.randint(0, 200)) for _ in range(12)]
    docs = []
    for i in range(90):
        w = []
        for _ in range(rnd.randint(0, 3)):
            b = rnd.choice(base)
            at = rnd.randint(0, len(b))
            w += b[at:at + rnd.randint(0, 90)]
            w += [rnd.choice(words)] * rnd.choice([0, 0, 50]) + rnd.choices(words, k=2) * rnd.choice([0, 0, 25])
        docs.append((1000 - i * 3, docs[-1][1] if docs and rnd.random() < 0.2 else rnd.choice([" ", "\n", " \t"]).join(w)))
    got = check(spark, docs, window, parts)
    assert sum(g[1] for g in got.values()) > 0


def test_awkward_cases(spark):
    docs = [*AWKWARD, (20, AWKWARD[8][1]), (21, " ".join(white_words(AWKWARD[8][1])[17:])), (22, AWKWARD[9][1])]
    got = check(spark, docs, WINDOW_WORDS)
    assert got[2] == (0, 0, "") and got[20][2] == "" and got[10][1] > 0


def test_rows_that_share_an_id_or_have_none_are_documents_of_their_own(spark):
    """As many rows out as in; an earlier document is one with a smaller id, and each passage stays once."""
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(None, "alpha beta"), (None, "gamma delta"), (1, "one two"), (1, "three four"), (2, None), (2, None), (None, None),
            (None, f"x {passage}"), (None, f"y {passage}"), (3, f"z {passage}"), (3, f"u {passage}"), (3, f"u {passage}"), (4, passage)]
    rows = substring_dedup(spark.createDataFrame(docs, DOCS).repartition(4)).collect()
    assert sorted((r.doc_id, r.n_words) for r in rows if r.doc_id) == sorted((i, len(white_words(t))) for i, t in docs if i)
    assert sorted(r.kept_text for r in rows if r.n_words == 2) == ["alpha beta", "gamma delta", "one two", "three four"]
    whole = [r for r in rows if r.n_words >= 30 and not r.n_removed]
    assert len(whole) == 1 and whole[0].doc_id is None
    assert sorted(r.kept_text for r in rows if r.doc_id == 3) == ["", "u", "z"] and [r.kept_text for r in rows if r.doc_id == 4] == [""]
    assert substring_dedup(spark.createDataFrame(docs, DOCS)).columns == ["doc_id", "n_words", "n_removed", "kept_text"]


def test_names_that_differ_in_case_only(spark):
    df = spark.createDataFrame([(1, "a b", "no", 9)], "doc_id long, text string, TEXT string, DOC_ID long")
    assert [tuple(r) for r in substring_dedup(df).collect()] == [(1, 2, 0, "a b")]


def test_hot_passage_keeps_its_first_place_only(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [(i, f"own{i} start{i} {passage} end{i}") for i in range(400)]
    rows = {r.doc_id: r for r in substring_dedup(spark.createDataFrame(docs, DOCS).repartition(9)).collect()}
    assert rows[0].n_removed == 0 and all(rows[i].n_removed == 60 for i in range(1, 400))


def test_untouched_documents_can_stay_as_they_are(spark):
    text = "a  b\n\nc\td"
    row = substring_dedup(spark.createDataFrame([(1, text), (2, None)], DOCS), untouched_as_is=True)
    assert {r.doc_id: r.kept_text for r in row.collect()} == {1: text, 2: None}


def test_empty_table_and_clashing_columns(spark, empty, awkward):
    assert substring_dedup(empty).collect() == []
    assert substring_dedup(awkward).columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    assert substring_dedup(awkward).count() == len(AWKWARD)
