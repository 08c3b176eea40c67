"""Versions, incremental reports, rewritten months, bucketed storage, observed statistics."""

from __future__ import annotations

import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from orderscope.operators import reports
from orderscope.plans import batch, incremental
from orderscope.schemas import REPORTS
from orderscope.session import fresh_path
from orderscope.sources import bucketed, files, tables, versions

from .conftest import SF_SMALL, rows
from .test_fixtures import frame, order
from .test_plans import plan, scans

KEY = str


def local(path):
    return urlparse(path).path or path


def as_rows(tables_):
    return {name: rows(df, order=KEY) for name, df in tables_.items()}


# --- versions ---

def test_readers_see_one_version_or_the_next(spark):
    base = fresh_path(spark, "test-versions")
    assert versions.current(spark, base) is None
    assert all(df.count() == 0 and df.schema == REPORTS[name] for name, df in batch.current_reports(spark, base).items())
    old = frame(spark, [order(1)])
    batch.run_pipeline(spark, old, base, 0)
    first = as_rows(batch.current_reports(spark, base))
    # a second run that has written some of its reports, and not published them
    folder = versions.new_folder(base)
    newer = reports.report_tables(frame(spark, [order(1), order(2, categoria="B")]), 0)
    files.write_report_csv(newer["categorias"], files.report_path(f"{base}/{folder}", "categorias"))
    assert as_rows(batch.current_reports(spark, base)) == first
    held = batch.current_reports(spark, base)
    files.write_reports({k: v for k, v in newer.items() if k != "categorias"}, f"{base}/{folder}")
    versions.publish(spark, base, folder, versions.current(spark, base))
    assert as_rows(batch.current_reports(spark, base)) == as_rows(newer)
    assert as_rows(held) == first                      # a reader that began before still reads the old set


def test_a_missing_report_of_a_version_is_empty(spark):
    base = fresh_path(spark, "test-partial")
    folder = versions.new_folder(base)
    files.write_report_csv(reports.report_status(frame(spark, [order(1)])), files.report_path(f"{base}/{folder}", "estados"))
    versions.publish(spark, base, folder, None)
    found = batch.current_reports(spark, base)
    assert found["estados"].count() == 1 and found["mensual"].count() == 0 and found["mensual"].schema == REPORTS["mensual"]


def test_the_later_of_two_writers_fails(spark):
    base = fresh_path(spark, "test-conflict")
    one = versions.publish(spark, base, versions.new_folder(base), None, {"de": "uno"})
    with pytest.raises(versions.Conflict):
        versions.publish(spark, base, versions.new_folder(base), None, {"de": "dos"})
    two = versions.publish(spark, base, versions.new_folder(base), one)
    with pytest.raises(versions.Conflict):
        versions.publish(spark, base, versions.new_folder(base), one)
    assert versions.current(spark, base) == two and two.number == 2
    assert not [n for n in os.listdir(local(base)) if n.startswith("_aside")]


def test_prune_keeps_the_newest(spark):
    base = fresh_path(spark, "test-prune")
    last = None
    for i in range(4):
        folder = versions.new_folder(base)
        spark.range(i + 1).write.parquet(f"{base}/{folder}/t")
        last = versions.publish(spark, base, folder, last)
    assert versions.prune(spark, base, keep=2) == [1, 2]
    assert versions.current(spark, base) == last and spark.read.parquet(f"{last.path}/t").count() == 4
    assert len([n for n in os.listdir(local(base)) if n.startswith("v-")]) == 2


# --- incremental reports ---

def test_deltas_equal_a_full_run(spark):
    base = fresh_path(spark, "test-deltas")
    orders = tables.ventas(spark, SF_SMALL)
    for i in range(3):
        incremental.apply(spark, base, f"l{i}", orders.filter(F.col("orden_id") % 3 == i), min_city_orders=0)
    assert as_rows(batch.current_reports(spark, base)) == as_rows(reports.report_tables(orders, 0))
    incremental.compact(spark, base, keep=1, min_city_orders=0)
    assert versions.current(spark, base).notes["lotes"] == [incremental.FOLDED, "l2"]
    incremental.apply(spark, base, "l2", orders.filter(F.col("orden_id") % 3 == 2), replace=True, min_city_orders=0)
    assert as_rows(batch.current_reports(spark, base)) == as_rows(reports.report_tables(orders, 0))


def test_a_batch_counts_once(spark):
    base = fresh_path(spark, "test-once")
    data = frame(spark, [order(1, precio=1e20), order(2, calificacion=None)])
    incremental.apply(spark, base, "a", data, min_city_orders=0)
    with pytest.raises(ValueError, match="batch 'a'"):
        incremental.apply(spark, base, "a", data)
    incremental.apply(spark, base, "b", frame(spark, [order(3, precio=0.0, calificacion=1.0)]), min_city_orders=0)
    incremental.apply(spark, base, "a", data, replace=True, min_city_orders=0)
    every = data.unionByName(frame(spark, [order(3, precio=0.0, calificacion=1.0)]))
    assert as_rows(batch.current_reports(spark, base)) == as_rows(reports.report_tables(every, 0))


def test_only_the_new_batch_is_scanned(spark, monkeypatch):
    paths = [fresh_path(spark, f"test-delta-{i}") for i in range(2)]
    for i, path in enumerate(paths):
        frame(spark, [order(10 * i + j) for j in range(5)]).write.parquet(path)
    base = fresh_path(spark, "test-scan")
    incremental.apply(spark, base, "0", spark.read.parquet(paths[0]), min_city_orders=0)
    written = []
    from pyspark.sql.readwriter import DataFrameWriter
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        written.extend(self._df.inputFiles()), real(self, path, *a, **k))[1])
    incremental.apply(spark, base, "1", spark.read.parquet(paths[1]), min_city_orders=0)
    text = "\n".join(written)
    assert "test-delta-1" in text and "test-delta-0" not in text and "medidas" in text
    assert rows(batch.current_reports(spark, base)["estados"])[0]["total_ordenes"] == 10


# --- months written again ---

def snapshot(path):
    return {os.path.join(d, n): os.path.getmtime(os.path.join(d, n)) for d, _, names in os.walk(local(path)) for n in names if n.endswith(".parquet")}


def test_a_month_can_be_written_again_without_the_others(spark):
    from orderscope.operators import clean
    path = fresh_path(spark, "test-months")
    right = clean.clean_orders(tables.ventas(spark, SF_SMALL)).cache()
    files.write_clean_parquet(right, path)
    before = snapshot(path)
    month = right.filter("anio = 1996 AND mes = 3")
    files.rewrite_clean_months(month.withColumn("categoria", F.lit("?")), path)
    for _ in range(2):
        files.rewrite_clean_months(month, path)
    after = snapshot(path)
    other = {f: t for f, t in before.items() if "anio=1996/mes=3/" not in f}
    assert other == {f: t for f, t in after.items() if "anio=1996/mes=3/" not in f}
    assert not set(before) & {f for f in after if "anio=1996/mes=3/" in f}
    assert rows(files.read_clean_parquet(spark, path), order=KEY) == rows(right, order=KEY)
    right.unpersist()


# --- buckets ---

def test_bucketed_lines_are_joined_without_an_exchange(spark):
    buckets = bucketed.store(spark, SF_SMALL, 4)
    df = bucketed.ventas(spark, buckets)
    p = plan(df)
    assert "SortMergeJoin" in p and "Exchange hashpartitioning" not in p and "hashpartitioning(l_orderkey" not in p
    assert p.count("Bucketed: true") == 2
    assert rows(df, order=KEY) == rows(tables.ventas(spark, SF_SMALL), order=KEY)
    bucketed.drop(spark, buckets)
    assert not spark.catalog.tableExists(buckets.lines)


# --- statistics in the pass that stores ---

def test_cleaning_reads_its_input_once_and_profiles_on_the_way(spark, monkeypatch):
    from orderscope.operators import clean
    source = fresh_path(spark, "test-observed")
    data = frame(spark, [order(i, calificacion=None if i % 3 == 0 else float(i % 5), descuento=None if i % 4 == 0 else 5.0, precio=float(i % 7))
                         for i in range(50)])
    data.write.parquet(source)
    raw = spark.read.parquet(source)
    written = []
    from pyspark.sql.readwriter import DataFrameWriter
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        written.append(self._df._jdf.queryExecution().executedPlan().toString()), real(self, path, *a, **k))[1])
    path = fresh_path(spark, "test-observed-clean")
    stats = batch.clean_to_parquet(raw, path)
    assert sum(scans(p) for p in written if "test-observed" in p) == 1 and "CollectMetrics" in written[0]
    assert len(written) == 2                    # the raw rows, and the clean rows from them
    assert stats == rows(clean.profile(raw))[0]
    assert rows(files.read_clean_parquet(spark, path), order=KEY) == rows(clean.clean_orders(raw), order=KEY)
