"""Licence scan: base places by brute force, notices, verification, awkward texts."""

from __future__ import annotations

import random
import re
from collections import Counter

from orderscope.llm import licenses
from orderscope.llm.licenses import BASE_PHRASES, TEMPLATES, rare_words, scan, scan_summary, template

from .conftest import AWKWARD, DOCS, REPEATED, plain_words

SF = "/root/testdata/sf0.01"


def brute(text):
    words, places = plain_words(text), []
    for phrase, label in BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


CASES = AWKWARD + REPEATED + [
    (20, "MIT License"), (21, "mit license mit license, general public license"), (22, "--- released under THE mit-license"),
    (23, "mit license " * 3000), (24, "license " * 5000), (25, "İ Kelvin K mit license"), (26, " , "),
    (27, "x Licensed under CC BY-NC 4.0. y"), (28, "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    (29, "licensed under the terms of another license version 2 0"),
]


def test_base_places_match_brute_force(spark):
    rows = scan_summary(scan(spark.createDataFrame(CASES, DOCS).repartition(3))).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=str)
    assert got == sorted(((i, *brute(t)) for i, t in CASES), key=str)


def test_driver_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in scan_summary(scan(docs)).collect()}
    for d in docs.collect():
        r = rows[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(d.text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert ("cc-by-nc" in r.labels) == ("CC BY-NC" in d.text)


def test_notices_need_agreeing_places_and_their_key_phrase(spark):
    docs = [(1, "before. " + " ".join(TEMPLATES[1].words) + " after"),                        # a whole notice
            (2, " ".join(reversed(TEMPLATES[1].words))),                                      # its words out of place
            (3, " ".join(TEMPLATES[1].words).replace("redistribution and use in source", "use and redistribution of source")),
            (4, " ".join(w if i % 9 else "other" for i, w in enumerate(TEMPLATES[9].words, 1)))]
    rows = {r.doc_id: r for r in scan(spark.createDataFrame(docs, DOCS)).collect()}
    assert [(n.label, n.start, n.score) for n in rows[1].notices] == [("bsd", 1, 1.0)]
    assert not rows[2].notices and not rows[3].notices
    assert [(n.label, n.start) for n in rows[4].notices] == [("mit", 0)] and 0.8 < rows[4].notices[0].score < 1


def test_rare_words_come_first_and_ties_in_alphabetical_order():
    t = (template("x", "the rare common odd the", "rare common"),)
    assert rare_words({"the": 9, "rare": 1, "common": 5, "odd": 1}, t, 3) == {"odd": [(0, 3)], "rare": [(0, 1)], "common": [(0, 2)]}


def test_empty_table_clashing_columns_and_no_python(spark, empty, awkward):
    assert scan_summary(scan(empty)).collect() == []
    assert scan(awkward).columns == ["doc_id", "n_words", "places", "notices"]
    assert not re.search("Python|Pandas|Arrow", scan_summary(scan(awkward))._jdf.queryExecution().toString())
    assert all(t.words[t.key_at:t.key_at + len(t.key)] == t.key for t in licenses.TEMPLATES)


def test_shortened_notices_are_found_by_their_key_phrase(spark):
    """The key phrase alone makes the label, whatever else the corpus holds of the notice."""
    docs = [(28, dict(CASES)[28]), (1, "see the Mozilla Public License"), (2, "x GNU Lesser General Public License y"), (3, "this is free software")]
    rows = {r.doc_id: r for r in scan(spark.createDataFrame(docs, DOCS)).collect()}
    assert {i: [(n.label, n.start) for n in r.notices] for i, r in rows.items()} == {28: [("mit", 0)], 1: [("mpl", -9)], 2: [("lgpl", -4)], 3: []}
    assert rows[28].notices[0].score == 16 / 20
    assert {r.doc_id: r.labels for r in scan_summary(scan(spark.createDataFrame(docs, DOCS))).collect()} == {28: "mit", 1: "mpl", 2: "gpl,lgpl", 3: ""}


def test_notices_are_the_places_of_key_phrases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in scan(docs).collect()}
    for d in docs.collect():
        words = plain_words(d.text)
        expected = [(t.label, i - t.key_at) for t in TEMPLATES for i in range(len(words)) if tuple(words[i:i + len(t.key)]) == t.key]
        assert sorted((n.label, n.start) for n in rows[d.doc_id].notices) == sorted(expected)


def brute_in_step(words, frequency, start, t):
    """How many of the file's four rarest licence words put one of their places on this start of the template."""
    vocabulary = {w for x in TEMPLATES for w in x.words}
    looked_up = sorted({w for w in words if w in vocabulary}, key=lambda w: (frequency[w], w))[:licenses.LOOKED_UP]
    return sum(any(0 <= start + i < len(words) and words[start + i] == w for i, x in enumerate(t.words) if x == w) for w in looked_up)


def test_looked_up_words_of_a_file_agree_on_its_notices(spark):
    """in_step of every notice, by brute force over files that hold several notices, whole, cut and mixed."""
    rnd = random.Random(6)
    filler = ["the", "of", "word", "other", "software", "license", "free"]
    docs = []
    for i in range(80):
        words = rnd.choices(filler, k=rnd.randint(0, 12))
        for t in rnd.choices(TEMPLATES, k=rnd.randint(0, 3)):
            a = rnd.choice([0, 0, rnd.randint(0, t.key_at)])
            words += [w if rnd.random() < 0.9 or t.key_at <= k < t.key_at + len(t.key) else "odd" for k, w in enumerate(t.words)][a:]
            words += rnd.choices(filler, k=rnd.randint(0, 6))
        docs.append((i, " ".join(words)))
    docs += [(100, None), (101, "license " * 4000), (102, "mit license " * 2000)]
    frequency = Counter(w for _, text in docs for w in set(plain_words(text)))
    rows = {r.doc_id: r for r in scan(spark.createDataFrame(docs, DOCS).repartition(4)).collect()}
    agreed = 0
    for i, text in docs:
        words = plain_words(text)
        expected = [(t.label, at - t.key_at, brute_in_step(words, frequency, at - t.key_at, t))
                    for t in TEMPLATES for at in range(len(words)) if tuple(words[at:at + len(t.key)]) == t.key]
        assert sorted((n.label, n.start, n.in_step) for n in rows[i].notices) == sorted(expected), i
        agreed += sum(n >= 2 for _, _, n in expected)
    assert agreed > 50


def test_score_is_the_share_of_words_in_place(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400).cache()
    rows = {r.doc_id: r for r in scan_summary(scan(docs)).collect()}
    for d in docs.collect():
        words = plain_words(d.text)
        shares = [sum(0 <= at - t.key_at + k < len(words) and words[at - t.key_at + k] == w for k, w in enumerate(t.words)) / len(t.words)
                  for t in TEMPLATES for at in range(len(words)) if tuple(words[at:at + len(t.key)]) == t.key]
        assert rows[d.doc_id].score == max([*shares, 0.5 if rows[d.doc_id].n_base else 0.0])
