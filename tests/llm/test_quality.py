"""Quality classifier: held-out accuracy, flattened trees, awkward texts, missing labels."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from orderscope.llm import quality
from orderscope.llm.quality import STATISTICS, batch_statistics, fit, fit_trees, quality_scores, score

from .conftest import AWKWARD, DOCS, REPEATED

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy_on_the_driver_tables(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == docs.count()
    known = {r.doc_id: r.quality for r in labels.collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(known[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in known]
    assert np.mean([a == b for a, b in held]) >= 0.95
    kept = [p for a, p in held if a == 1]
    assert np.mean(kept) >= 0.97


def test_held_out_labels_are_not_learned(spark):
    """Turning every held-out label over changes no score."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", quality.F.when(quality.held_out("doc_id"), 1 - quality.F.col("quality"))
                               .otherwise(quality.F.col("quality")))
    a, b = fit(docs, labels), fit(docs, turned)
    assert np.array_equal(a.value, b.value) and np.array_equal(a.threshold, b.threshold)


def test_trees_learn_and_flat_walk_equals_a_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = fit_trees(x[:1500], y[:1500])
    p = model.score(x[1500:])
    assert np.mean((p >= 0.5) == y[1500:]) > 0.95

    def plain(row):
        total = model.base
        for root in model.roots:
            node = root
            while model.left[node] >= 0:
                node = model.left[node] + int(row[model.feature[node]] > model.threshold[node])
            total += model.value[node]
        return 1 / (1 + np.exp(-total))
    assert p[:50] == pytest.approx([plain(r) for r in x[1500:1550]])


def test_statistics_of_awkward_texts_are_finite_and_do_not_depend_on_neighbours():
    texts = [t for _, t in AWKWARD]
    together = batch_statistics(pa.array(texts, pa.string()))
    assert together.shape == (len(texts), len(STATISTICS)) and np.isfinite(together).all()
    alone = np.concatenate([batch_statistics(pa.array([t], pa.string())) for t in texts])
    assert together == pytest.approx(alone, rel=1e-5, abs=1e-6)
    assert not together[1].any() and not together[2].any()


def test_defined_cases(spark, empty, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (3, None, 0)], LABELS)
    assert quality_scores(empty, labels).collect() == []
    rows = quality_scores(spark.createDataFrame(AWKWARD + REPEATED, DOCS), labels).collect()
    assert len(rows) == len(AWKWARD) + 3
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert quality_scores(awkward, labels).columns == ["doc_id", "held_out", "score", "predicted"]
    none = fit(awkward, spark.createDataFrame([], LABELS))
    assert {r.score for r in score(awkward, none).collect()} == {0.5}
    assert score(awkward, none).select("doc.*").columns == awkward.columns
