"""LM scoring: gradients, normalised probabilities, a corpus it can learn, awkward texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from orderscope.llm import lm
from orderscope.llm.lm import SIDE, VOCABULARY, Network, Numbering, pseudo_likelihood

from .conftest import AWKWARD, DOCS, REPEATED, plain_words


def network():
    return Network.fresh(np.arange(VOCABULARY)[::-1].astype(float))


def test_probabilities_of_all_entries_sum_to_one():
    context = np.array([[1, 2, 3, 4], [VOCABULARY, 5, 6, VOCABULARY]])
    every = [network().log_probability(np.repeat(c[None], VOCABULARY, 0), np.arange(VOCABULARY)) for c in context]
    assert [np.exp(e).sum() for e in every] == pytest.approx([1, 1], rel=1e-4)


def test_a_step_goes_down_the_gradient():
    rng = np.random.default_rng(2)
    context, word = rng.integers(0, VOCABULARY + 1, (300, 2 * SIDE)), rng.integers(0, VOCABULARY, 300)
    net = network()
    before = net.log_probability(context, word).mean()
    for _ in range(5):
        net.train(context, word, 0.05)
    assert net.log_probability(context, word).mean() > before + 0.1


def test_learns_the_middle_word_from_both_sides(spark):
    """The word between two others follows from both; shuffled texts score lower."""
    rng = np.random.default_rng(3)

    def text(n):
        pairs = rng.integers(0, 6, (n, 2))
        return " ".join(f"l{a} m{(a + b) % 6} r{b}" for a, b in pairs)
    docs = [(i, text(60)) for i in range(150)]
    shuffled = [(1000 + i, " ".join(rng.permutation(t.split()))) for i, t in docs[:20]]
    rows = {r.doc_id: r for r in pseudo_likelihood(spark.createDataFrame(docs + shuffled, DOCS).repartition(2)).collect()}
    good = np.mean([rows[i].mean_log_likelihood for i in range(20)])
    assert good > np.mean([rows[1000 + i].mean_log_likelihood for i in range(20)]) + 0.5
    assert good > -np.log(18)                        # better than an even guess among its words


def test_score_is_the_sum_over_words(spark):
    docs = [(i, t) for i, t in AWKWARD if i != 9] + REPEATED
    df = spark.createDataFrame(docs, DOCS)
    numbering, net = lm.fit(df)
    rows = pseudo_likelihood(df).collect()
    assert len(rows) == len(docs)
    frequent, _ = lm.frequent_words(df)
    again = Numbering(frequent)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, t)
    for r in rows:
        words = plain_words(texts[r.doc_id])
        assert r.n_words == len(words)
        total = 0.0
        if words:
            piece = next(lm.pieces(pa.array([texts[r.doc_id]]), lm.NOT_ALNUM, lower=True))
            ids = again(piece.hashes())
            padded = [VOCABULARY] * SIDE + ids.tolist() + [VOCABULARY] * SIDE
            context = np.array([padded[k:k + SIDE] + padded[k + SIDE + 1:k + 2 * SIDE + 1] for k in range(len(ids))])
            total = net.log_probability(context, ids).sum()
        assert r.log_likelihood == pytest.approx(total, rel=1e-4, abs=1e-4)
        assert (r.mean_log_likelihood is None) == (not words)


def test_does_not_depend_on_the_order_of_tasks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = {r.doc_id: r.log_likelihood for r in pseudo_likelihood(docs).collect()}
    assert a == {r.doc_id: r.log_likelihood for r in pseudo_likelihood(docs).collect()}


def test_word_counts_cover_the_corpus(spark):
    df = spark.createDataFrame([(1, "b a a"), (2, "a c"), (3, None)], DOCS)
    frequent, entries = lm.frequent_words(df)
    assert len(frequent) == 3 and entries[:3].tolist() == [3, 1, 1] and entries.sum() == 5


def test_empty_table_and_clashing_columns(empty, awkward):
    assert pseudo_likelihood(empty).collect() == []
    assert pseudo_likelihood(awkward).columns == ["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"]


def test_every_word_has_a_probability_of_its_own(spark):
    """One-word texts of all words: their probabilities sum to one but for empty entries, and a commoner word of an entry has more of it."""
    words = [f"w{k}" for k in range(1500)]
    docs = [(k, w) for k, w in enumerate(words)] + [(5000 + i, w) for i, w in enumerate(words[:900] * 2 + words[:800])]
    rows = {r.doc_id: r.log_likelihood for r in pseudo_likelihood(spark.createDataFrame(docs, DOCS).repartition(3)).collect()}
    assert len(rows) == len(docs)
    assert sum(np.exp(rows[k]) for k in range(len(words))) == pytest.approx(1, abs=0.01)
    hashes = next(lm.pieces(pa.array([" ".join(words)]), lm.NOT_ALNUM, lower=True)).hashes()
    frequent, _ = lm.frequent_words(spark.createDataFrame(docs, DOCS))
    entry = Numbering(frequent)(hashes)
    common, rare = next((a, b) for a in range(900) for b in range(900, 1500) if entry[a] == entry[b] >= lm.FREQUENT)
    assert rows[common] - rows[rare] == pytest.approx(np.log(4 if common < 800 else 3), abs=1e-4)


def test_every_position_trains_in_one_round():
    keys, counts = np.arange(40, dtype=np.uint64), np.array([0, 1, 2, 5] * 10)
    rounds = [lm.training_rows(keys, counts, turn).tolist() for turn in range(lm.ROUNDS)]
    assert sorted(x for r in rounds for x in r) == list(range(counts.sum())) and all(rounds)


def test_learns_from_short_texts(spark):
    """Each word is trained on once: the middle word still follows from both sides."""
    rng = np.random.default_rng(4)

    def text(n):
        return " ".join(f"l{a} m{(a + b) % 4} r{b}" for a, b in rng.integers(0, 4, (n, 2)))
    docs = [(i, text(4)) for i in range(6000)]
    shuffled = [(10_000 + i, " ".join(rng.permutation(t.split()))) for i, t in docs[:50]]
    rows = {r.doc_id: r for r in pseudo_likelihood(spark.createDataFrame(docs + shuffled, DOCS).repartition(2)).collect()}
    good = np.mean([rows[i].mean_log_likelihood for i in range(50)])
    assert good > np.mean([rows[10_000 + i].mean_log_likelihood for i in range(50)]) + 0.5
    assert good > -np.log(12)


def test_tables_give_the_same_hidden_layer():
    rng = np.random.default_rng(5)
    context, word = rng.integers(0, VOCABULARY + 1, (200, 2 * SIDE)), rng.integers(0, VOCABULARY, 200)
    net = network()
    _, h = net.hidden(context)
    class_ = h @ net.weights["class_"] + net.weights["class_bias"]
    expected = []
    for row, z, w in zip(h, class_, word, strict=True):
        inner = row @ net.weights["entry"][w // lm.ENTRIES] + net.weights["entry_bias"][w // lm.ENTRIES]
        expected.append(z[w // lm.ENTRIES] - np.log(np.exp(z).sum()) + inner[w % lm.ENTRIES] - np.log(np.exp(inner).sum()))
    assert net.log_probability(context, word) == pytest.approx(expected, abs=1e-4)
