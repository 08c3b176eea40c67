"""The pipeline: columns between stages, decisions against the operators, planted cases, awkward rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
import corpus_pipeline
from orderscope.llm import quality, queries, simhash, substring
from orderscope.llm.frames import read
from orderscope.session import fresh_path

from .conftest import AWKWARD, REPEATED, plain_words, with_clashing_columns

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's output over the driver's small tables."""
    docs, out = read(spark, SF, "documents"), {"documents": read(spark, SF, "documents")}
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_and_rows_shrink_stage_by_stage(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    before = texts(stages["documents"])
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns
        after = texts(stages[name])
        assert set(after) <= set(before)
        if name != "repeated_passages":
            assert all(after[i] == before[i] for i in after)
        before = after


def test_quality_keeps_clean_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in read(spark, SF, "labels").collect()}
    kept = set(texts(stages["quality"]))
    good, bad = [i for i, q in labels.items() if q == 1], [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)


def test_one_document_of_each_near_duplicate_group_stays(stages):
    groups = {r.doc_id: r.component_id for r in simhash.simhash_components(stages["quality"]).collect()}
    assert sorted(texts(stages["near_duplicates"])) == sorted(set(groups.values()))


def test_repeated_passages_go_and_untouched_texts_stay(stages):
    before, after = texts(stages["near_duplicates"]), texts(stages["repeated_passages"])
    assert set(before) == set(after)
    rows = {r.doc_id: r for r in substring.substring_dedup(stages["near_duplicates"]).collect()}
    for i, r in rows.items():
        assert after[i] == (before[i] if r.n_removed == 0 else r.kept_text)
    assert all(r.n_chars == len(r.text) for r in stages["repeated_passages"].collect())


def test_no_benchmark_window_is_left(spark, stages):
    windows = set()
    for r in read(spark, SF, "benchmark").collect():
        w = plain_words(r.text)
        windows |= {tuple(w[a:a + 10]) for a in range(max(1, len(w) - 9))} if w else set()
    before, after = texts(stages["repeated_passages"]), texts(stages["benchmark"])
    def leaks(t):
        w = plain_words(t)
        return any(tuple(w[a:a + 10]) in windows for a in range(max(1, len(w) - 9)))
    assert set(after) == {i for i, t in before.items() if not leaks(t)} and len(after) < len(before)


def test_packing_places_every_kept_document(stages):
    placed = {r.doc_id for r in stages["packing"].collect()}
    assert placed == set(texts(stages["benchmark"]))


def test_run_is_the_stages_in_turn(spark, stages):
    key = lambda df: sorted((r.doc_id, r.piece, r.length) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages["packing"])


@pytest.mark.parametrize("rows", [AWKWARD + REPEATED, []])
def test_awkward_rows_and_extra_columns_pass_every_stage(spark, rows):
    docs = with_clashing_columns(spark, rows)
    columns, total = docs.columns, len(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = fresh_path(spark, "test-awkward")
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == columns
        out.write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
        assert docs.count() <= total
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_every_operator_is_registered():
    for n in range(1, 14):
        assert any(k.startswith(f"op{n}_") for k in queries.QUERIES)
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert quality.SAMPLE_ROWS == 20_000


def test_rows_without_or_with_shared_ids_stay_apart(spark):
    """Unrelated texts under no id, or one id, pass the stages whole; a missing text doesn't win over one."""
    say = lambda a, b: " ".join(f"{w}{k}" for k in range(a, b) for w in ("alpha", "beta", "gamma"))
    leak = read(spark, SF, "benchmark").first().text
    rows = [(None, say(0, 40)), (None, say(100, 140)), (5, say(200, 240)), (5, say(300, 340)), (6, None), (6, ""), (7, say(400, 440)), (7, say(500, 520) + " " + leak)]
    docs = with_clashing_columns(spark, rows)
    got = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    near = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    expected = sorted([r for r in rows if r != (6, None)], key=str)
    assert got(near) == expected
    passages = corpus_pipeline.repeated_passage_stage(spark, near, SF)
    assert got(passages) == expected
    assert got(corpus_pipeline.benchmark_stage(spark, passages, SF)) == [r for r in expected if r != rows[-1]]


def test_of_rows_equal_in_id_and_text_the_first_by_its_columns_stays(spark):
    text = "some words of a text that two rows share with each other and with none else"
    rows = [(1, text, "fr", "b", 1), (1, text, "de", "z", 1), (1, text, "de", "a", 1), (2, None, "en", "y", 0), (2, None, "en", "x", 0)]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    for order in (rows, rows[::-1]):
        kept = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(order, columns).repartition(3), SF).collect()
        assert sorted((r.doc_id, r.lang, r.source) for r in kept) == [(1, "de", "a"), (2, "en", "x")]
