"""Licence scan with a positional index of rare template words.

Base places are where the words of a base phrase stand consecutively. The
method adds notices, whole or shortened:

1. *Rarity.* For every template word, the number of documents that hold it is
   counted over the whole table; the fewer, the higher its IDF.
2. *Index.* Every template word that some document holds is posted with its
   positions in the templates.
3. *Look-up.* Of the licence words that a file holds, the ``LOOKED_UP`` with the
   highest IDF are looked up: a posting at template position t and the word at
   place p of the file make p - t a start of that template.
4. *Intersect.* Starts on which at least two of the file's looked-up words agree
   (their postings meet by relative position) are candidates. A file may hold
   less of a notice than that, or rarer words of another one; so that no notice
   is lost, the starts implied by the rarest word of a template's key phrase are
   candidates too.
5. *Verify.* A candidate counts if the template's mandatory key phrase stands
   word for word where that start puts it. Its score is the share of template
   words that stand in their places; ``in_step`` says how many of the file's
   looked-up words agreed on it.

Everything is DataFrame functions on one row per document: no shuffle but the
counting of at most as many words as the templates have, and that count is
all that reaches the driver. Starts are numbers, so telling them apart is a
hash set and a sort however often a word stands in a text.

Defined cases: null text counts as empty; a text without words has no places
(null ``first_word`` and ``last_word``, empty labels, score 0); a null id is
returned as null; repeated rows are scanned each; words tied in rarity are
taken in alphabetical order; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
LOWER_FROM, LOWER_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Licence words of a file that are looked up.
LOOKED_UP = 4
# A start is numbered (template, start + LONGEST, word): templates are shorter than LONGEST, texts than 2^33 words.
LONGEST, START_BITS, WORD_BITS = 1 << 16, 34, 4
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice: its words, and the phrase in it without which it doesn't count."""

    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.key)


def template(label: str, text: str, key: str) -> Template:
    return Template(label, tuple(text.split()), tuple(key.split()))


# Short public notices, lower case, words only.
TEMPLATES = (
    template("apache", "licensed under the apache license version 2 0", "apache license"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
                    "provided that the following conditions are met", "redistribution and use in source and binary forms"),
    template("cc-by", "licensed under cc by 4 0", "cc by 4 0"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                    "general public license as published by the free software foundation", "gnu general public license"),
    template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
             "lesser general public license"),
    template("mit", "released under the mit license", "mit license"),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                    "associated documentation files", "permission is hereby granted free of charge"),
    template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    template("unlicense", "this is free and unencumbered software released into the public domain",
             "free and unencumbered software"),
)


def words(text: Column) -> Column:
    """Lower-cased (A-Z) words of a text, in order."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), LOWER_FROM, LOWER_TO), BETWEEN)
    # only the first and the last part can be empty
    from_ = F.when(parts[0] == "", 2).otherwise(1)
    n = F.size(parts) - F.when(parts[0] == "", 1).otherwise(0) - F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.slice(parts, from_, n)


def _strings(values: list[str] | tuple[str, ...]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of documents that hold each word, over the whole table (column ``words``)."""
    held = docs.select(F.explode(F.array_intersect("words", _strings(vocabulary))).alias("word"))
    found = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {w: found.get(w, 0) for w in vocabulary}


def rare_words(frequency: dict[str, int], templates: tuple[Template, ...], n: int | None = None) -> dict[str, list[tuple[int, int]]]:
    """Postings (template number, position) of each template's different words, or of the n rarest, in order of rarity."""
    postings: dict[str, list[tuple[int, int]]] = {}
    for number, t in enumerate(templates):
        for word in sorted(set(t.words), key=lambda w: (frequency[w], w))[:n]:
            postings.setdefault(word, []).extend((number, i) for i, w in enumerate(t.words) if w == word)
    return dict(sorted(postings.items(), key=lambda x: (frequency[x[0]], x[0])))


def _phrase_places(phrase: str) -> Column:
    """Starts of a phrase in ``words``; looked for only where its last word is present."""
    parts = phrase.split()
    n = len(parts)
    starts = F.sequence(F.lit(0), F.size("words") - n)
    def here(i: Column) -> Column:
        agree = F.get("words", i + (n - 1)) == parts[-1]
        for j, part in enumerate(parts[:-1]):
            agree = agree & (F.get("words", i + j) == part)
        return agree
    return F.when(F.array_contains("words", parts[-1]) & (F.size("words") >= n), F.filter(starts, here)) \
        .otherwise(F.array().cast("array<int>"))


def _labelled(starts: Column, label: str) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("start"), F.lit(label).alias("label")))


def key_postings(frequency: dict[str, int], templates: tuple[Template, ...]) -> dict[str, list[tuple[int, int]]]:
    """Postings (template number, position) of the rarest word of each key phrase that can stand somewhere."""
    keys = tuple(Template(t.label, t.key, t.key) for t in templates)
    found = {w: [(t, i + templates[t].key_at) for t, i in places if frequency[w]] for w, places in rare_words(frequency, keys, 1).items()}
    return {w: places for w, places in found.items() if places}


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once (a lambda would compute it for every element)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _starts(postings: dict[str, list[tuple[int, int]]], looked_up: Column, by_word: bool) -> Column:
    """Numbers of all (template, start, word) that the postings of those words imply; without ``by_word`` the word is 0."""
    none = F.array().cast("array<bigint>")
    if not postings:
        return none
    table = F.create_map(*[x for word, places in postings.items() for x in (
        F.lit(word), F.array(*[F.lit((t << START_BITS) - p + LONGEST).cast("bigint") for t, p in places]))])
    placed = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.cast("bigint").alias("i"))), lambda x: F.array_contains(looked_up, x["w"]))
    word = lambda x: F.array_position(looked_up, x["w"]) if by_word else F.lit(0)
    numbers = F.flatten(F.transform(placed, lambda x: F.transform(
        F.element_at(table, x["w"]), lambda y: F.shiftleft(y + x["i"], WORD_BITS) + word(x))))
    return F.when(F.size(looked_up) > 0, numbers).otherwise(none)


def _candidates(rarest: Column, fallback: Column) -> Column:
    """(t, start, in_step) of the starts on which two looked-up words agree, and of the fallback's, each once."""
    def met(b: Column) -> Column:
        start = lambda x: F.shiftright(x, WORD_BITS)
        heads = F.filter(F.transform(b, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                         lambda h: F.coalesce(start(F.get(b, h["i"] - 1)) != start(h["x"]), F.lit(True)))

        def opened(h: Column) -> Column:
            here = start(h["x"])
            # sorted, so the words of a start follow it (0 of the fallback first)
            agree = [F.coalesce((start(F.get(b, h["i"] + k)) == here) & (F.get(b, h["i"] + k).bitwiseAND((1 << WORD_BITS) - 1) > 0), F.lit(False)).cast("int")
                     for k in range(LOOKED_UP + 1)]
            t = F.shiftright(here, START_BITS)
            return F.struct(t.cast("int").alias("t"), (here - F.shiftleft(t, START_BITS) - LONGEST).cast("int").alias("start"),
                            reduce(Column.__add__, agree).alias("in_step"), (h["x"].bitwiseAND((1 << WORD_BITS) - 1) == 0).alias("by_key"))
        return F.filter(F.transform(heads, opened), lambda c: (c["in_step"] >= 2) | c["by_key"])
    return _let(F.array_sort(F.array_distinct(F.concat(rarest, fallback))), met)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: tuple[Template, ...] = TEMPLATES, phrases: dict[str, str] | None = None) -> DataFrame:
    """Rows ``doc_id, n_words, places, notices``, one for each row of ``docs``.

    ``places``: (start, label) of base phrases, by start; ``notices``: (label,
    start, score, in_step) of verified templates.
    """
    phrases = BASE_PHRASES if phrases is None else phrases
    rows = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col).cast("string")).alias("words"))
    frequency = document_frequencies(rows, sorted({w for t in templates for w in t.words}))
    every = {w: places for w, places in rare_words(frequency, templates).items() if frequency[w]}
    by_key = key_postings(frequency, templates)
    held = lambda postings: F.array_intersect(_strings(list(postings)), "words") if postings else F.array().cast("array<string>")
    known = F.array(*[F.struct(F.lit(t.label).alias("label"), _strings(t.words).alias("words"), _strings(t.key).alias("key"),
                               F.lit(t.key_at).alias("key_at")) for t in templates])
    places = F.array_sort(F.concat(*[_labelled(_phrase_places(p), label) for p, label in phrases.items()]))
    # array_intersect keeps the order of its first array: the file's licence words, rarest first
    found = rows.withColumn("places", places).withColumns({"rarest": F.slice(held(every), 1, LOOKED_UP), "key_words": held(by_key)}) \
        .withColumn("starts", _candidates(_starts(every, F.col("rarest"), True), _starts(by_key, F.col("key_words"), False)))

    def verified(x: Column) -> Column:
        t = F.element_at(known, x["t"] + 1)
        at = x["start"] + t["key_at"]
        return (at >= 0) & (F.slice("words", F.greatest(at, F.lit(0)) + 1, F.size(t["key"])) == t["key"])

    def notice(x: Column) -> Column:
        t = F.element_at(known, x["t"] + 1)
        agree = F.filter(t["words"], lambda w, i: (x["start"] + i >= 0) & (F.get("words", F.greatest(x["start"] + i, F.lit(0))) == w))
        return F.struct(t["label"].alias("label"), x["start"].alias("start"), (F.size(agree) / F.size(t["words"])).alias("score"),
                        x["in_step"].alias("in_step"))

    notices = F.transform(F.filter("starts", verified), notice)
    return found.select("doc_id", F.size("words").cast("bigint").alias("n_words"), "places", notices.alias("notices"))


def scan_summary(scanned: DataFrame) -> DataFrame:
    """The digest columns of :func:`scan`: counts, first and last place, labels, score.

    The score is the best notice's share of template words in place; a base
    phrase outside any notice counts one half.
    """
    base = F.array_distinct(F.transform("places", lambda x: x["label"]))
    more = F.array_distinct(F.concat(base, F.transform("notices", lambda x: x["label"])))
    best = F.coalesce(F.array_max(F.transform("notices", lambda x: x["score"])), F.lit(0.0))
    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.get("places", F.lit(0))["start"].cast("bigint").alias("first_word"),
        F.get("places", F.size("places") - 1)["start"].cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(more), ",").alias("labels"),
        F.greatest(best, F.when(F.size("places") > 0, 0.5).otherwise(0.0)).alias("score"))
