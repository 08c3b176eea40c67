"""Invertible Bloom lookup fingerprints: exact likeness, recovered digests, retries, awkward texts."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from orderscope.llm import versions
from orderscope.llm.versions import changed_paragraphs, version_fingerprints

from .conftest import AWKWARD, DOCS, with_clashing_columns


def paragraphs(text):
    return {p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if p.strip(" ")}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(docs):
    """Every row in order of id (null first); rows of one id are given in order."""
    docs = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    texts = [t or "" for _, t in docs]
    out = []
    for n, (i, _) in enumerate(docs):
        text, after = texts[n], texts[(n + 1) % len(texts)]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(paragraphs(text), paragraphs(edited)),
                    likeness(paragraphs(text), paragraphs(after))))
    return out


def check(spark, docs):
    rows = version_fingerprints(spark.createDataFrame(docs, DOCS).repartition(3)).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:3])
    got = sorted([(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in rows], key=order)
    want = sorted(brute(docs), key=order)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[3:] == pytest.approx(w[3:]), g
    return {r.doc_id: r for r in rows}


def test_likeness_is_exact_awkward_cases_included(spark):
    rnd = random.Random(4)
    lines = [f"Line {k} of many. It has a second sentence {k}?" for k in range(80)]
    docs = AWKWARD + [(100 + i * 3, "\n".join(rnd.choices(lines, k=rnd.randint(0, 60)))) for i in range(60)]
    rows = check(spark, docs)
    assert any(0 < r.near_next < 1 for r in rows.values())
    assert rows[1].fingerprint == rows[5].fingerprint != ""
    assert rows[2].fingerprint == rows[3].fingerprint == ""


def test_rows_that_share_an_id_or_have_none_are_documents_of_their_own(spark):
    hashes = {t: h for t, h in spark.createDataFrame([("b. b.",), ("a. a.",), ("n1. n.",), ("n2. n.",)], "t string").selectExpr("t", "xxhash64(t) h").collect()}
    by_hash = lambda *texts: sorted(texts, key=hashes.__getitem__)
    docs = [(None, None), *[(None, t) for t in by_hash("n1. n.", "n2. n.")], (500, None), *[(500, t) for t in by_hash("b. b.", "a. a.")],
            (501, "c. c."), (501, "c. c."), (502, "d. d.")]
    check(spark, docs)


def test_small_tables_are_tried_again_larger(spark, monkeypatch):
    """With next to no spare cells many documents fail at first and are mended."""
    monkeypatch.setattr(versions, "SPARE_CELLS", 3)
    monkeypatch.setattr(versions, "_size", lambda a, b, share, attempt, size=versions._size: size(a, b, share / 4, attempt))
    rnd = random.Random(9)
    check(spark, [(i, "\n".join(f"l{rnd.randrange(90)}" for _ in range(25))) for i in range(40)])


def test_changed_paragraphs_are_recovered(spark):
    old = [(1, "a\nb\nc"), (2, "x"), (3, None), (4, "only old")]
    new = [(1, "a\nc\nd\ne"), (2, "x"), (3, "now"), (None, "n")]
    digest = {p: h for p, h in spark.createDataFrame([(p,) for p in "abcdex"] + [("now",), ("only old",), ("n",)], "p string")
              .selectExpr("p", "xxhash64(p) h").collect()}
    got = {(r.doc_id, r.digest, r.side) for r in changed_paragraphs(spark.createDataFrame(old, DOCS), spark.createDataFrame(new, DOCS)).collect()}
    assert got == {(1, digest["b"], 1), (1, digest["d"], -1), (1, digest["e"], -1), (3, digest["now"], -1),
                   (4, digest["only old"], 1), (None, digest["n"], -1)}


def test_single_document_empty_table_and_clashing_columns(spark, empty):
    assert version_fingerprints(empty).collect() == []
    rows = version_fingerprints(with_clashing_columns(spark, [(1, "alone. It is.")]))
    assert rows.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert [(r.doc_id, r.near_next) for r in rows.collect()] == [(1, 1.0)]


def test_no_python_on_the_main_path(spark):
    docs = spark.createDataFrame(AWKWARD, DOCS)
    links = versions._next_links(docs, "doc_id")
    plan = versions._compared(versions._versions(docs, links, "doc_id", "text"), 0, versions.BASE_CELLS)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
