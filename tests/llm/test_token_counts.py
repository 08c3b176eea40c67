"""Token counts: sections sum to the whole, spans round trip, the rules at crossing tokens."""

from __future__ import annotations

import bisect
import random

import numpy as np
import pytest

from orderscope.llm.token_counts import RULES, VOCABULARY, Encoder, attribute, section_tokens

from .conftest import AWKWARD, DOCS, REPEATED

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def encoder():
    with open(VOCABULARY, "rb") as file:
        return Encoder(file.read())


@pytest.mark.parametrize("rule", RULES)
def test_lines_sum_to_the_document_and_spell_it(spark, encoder, rule):
    docs = AWKWARD + [(r.doc_id + 1000, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(200).collect()]
    found = {}
    for r in section_tokens(spark.createDataFrame(docs, DOCS).repartition(3), rule).collect():
        found.setdefault(r.doc_id, []).append(r)
    for i, text in docs:
        text = text or ""
        rows = sorted(found[i], key=lambda r: r.section)
        assert sum(r.n_tokens for r in rows) == pytest.approx(len(encoder.encoding.encode_ordinary(text)))
        assert "".join(text[r.start:r.end] for r in rows) == text
        assert [text[r.start:r.end].count("\n") for r in rows[:-1]] == [1] * (len(rows) - 1)


def test_first_rule_by_brute_force(spark, encoder):
    text = "Añ\n\n\n  wörds 日本\n\tand 😀\n more\n"
    ends = encoder.ends(text).tolist()
    starts, bounds = [0, *ends[:-1]], [0]
    for line in text.splitlines(keepends=True):
        bounds.append(bounds[-1] + len(line.encode()))
    want = [0] * (len(bounds) - 1)
    for s in starts:
        want[bisect.bisect_right(bounds, s) - 1] += 1
    rows = section_tokens(spark.createDataFrame([(1, text)], DOCS), "first").orderBy("section").collect()
    assert [r.n_tokens for r in rows] == want


def test_rules_at_a_token_that_crosses():
    ends, bounds = np.array([2, 7, 9]), np.array([0, 3, 9])      # bytes 2..7 cross at 3: one byte to four
    assert [attribute(ends, bounds, rule)[0].tolist() for rule in RULES] == [[2, 1], [1, 2], [1, 2], [1.2, 1.8]]
    assert attribute(ends, bounds, "first")[1].tolist() == [1, 1]


def brute_attribute(ends, bounds, rule):
    """Byte by byte: each byte has a token and a stretch."""
    n = len(bounds) - 1
    stretch_of = [max(k for k in range(n) if bounds[k] <= b < bounds[k + 1]) for b in range(bounds[-1])]
    tokens, crossing, start = [0.0] * n, [0] * n, 0
    for end in ends:
        own = stretch_of[start:end]
        if own[0] != own[-1]:
            crossing[own[0]] += 1
            crossing[own[-1]] += 1
        if rule == "first":
            tokens[own[0]] += 1
        elif rule == "last":
            tokens[own[-1]] += 1
        elif rule == "most":
            tokens[max(dict.fromkeys(own), key=own.count)] += 1          # the earlier of equals comes first
        else:
            for k in own:
                tokens[k] += 1 / len(own)
        start = end
    return tokens, crossing


@pytest.mark.parametrize("rule", RULES)
def test_every_rule_by_brute_force(rule):
    rnd = random.Random(11)
    for _ in range(300):
        size = rnd.randint(1, 60)
        ends = sorted(rnd.sample(range(1, size), min(size - 1, rnd.randint(0, 15)))) + [size]
        bounds = [0, *sorted(rnd.choices(range(size + 1), k=rnd.randint(0, 12))), size]
        tokens, crossing = attribute(np.array(ends), np.array(bounds), rule)
        expected = brute_attribute(ends, bounds, rule)
        assert tokens.tolist() == pytest.approx(expected[0]) and crossing.tolist() == expected[1], (ends, bounds)


def test_one_very_long_word(spark, encoder):
    text = "w" * 200_000
    rows = section_tokens(spark.createDataFrame([(1, text)], DOCS)).collect()
    assert [(r.section, r.start, r.end, r.n_tokens) for r in rows] == [(0, 0, 200_000, len(encoder.encoding.encode_ordinary(text)))]


def test_given_sections_overlaps_and_the_rest(spark, encoder):
    text = "alpha beta gamma delta"
    data = [(1, text, [(6, 10), (8, 16)]), (2, text, []), (3, None, [(0, 4)]), (4, text, [(0, 100)]), (4, text, [(0, 100)])]
    df = spark.createDataFrame(data, "doc_id long, text string, s array<struct<start:int,end:int>>")
    rows = section_tokens(df, "share", sections_col="s").collect()
    spans = {(r.doc_id, r.section): text[r.start:r.end] for r in rows if r.section >= 0 and r.doc_id != 3}
    assert spans == {(1, 0): "beta", (1, 1): " gamma", (4, 0): text}
    n = len(encoder.encoding.encode_ordinary(text))
    assert sum(r.n_tokens for r in rows if r.doc_id == 1) == pytest.approx(n)
    assert sum(r.n_tokens for r in rows if r.doc_id == 2) == pytest.approx(n)
    assert sum(r.doc_id == 4 for r in rows) == 2


def test_defined_cases(spark, empty, awkward):
    assert section_tokens(empty).collect() == []
    assert section_tokens(awkward).columns == ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]
    rows = section_tokens(spark.createDataFrame(AWKWARD + REPEATED, DOCS)).collect()
    assert [(r.section, r.start, r.end, r.n_tokens) for r in rows if r.doc_id in (2, 3)] == [(0, 0, 0, 0.0)] * 2
    assert sum(r.doc_id == 11 for r in rows) == 3
    with pytest.raises(ValueError):
        section_tokens(awkward, "middle")
