"""Small documents that hold every awkward case, and brute-force word helpers."""

from __future__ import annotations

import re

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"
# Columns whose names the operators use themselves.
CLASH = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, shard int, rank long"


def white_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def with_clashing_columns(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), -1.0, "k", 7, 9) for i, t in rows], CLASH)


LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
AWKWARD = [
    (1, "A plain text of some words, with a Stop. And another one!\nA second line"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "A plain text of some words, with a Stop. And another one!\nA second line"),   # equal to 1
    (None, "the null id has a text of its own, words and all, to the very end of it"),
    (7, "one"),
    (8, "Ünïcödé 日本語 текст ñandú 😀 Ünïcödé 日本語 текст ñandú 😀"),
    (9, LONG),
    (10, "same same same same same same same same same same same same same same same same same same same same same same"),
]
REPEATED = [(11, "repeated row"), (11, "repeated row"), (11, "repeated row")]


@pytest.fixture
def awkward(spark):
    return with_clashing_columns(spark, AWKWARD)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)
