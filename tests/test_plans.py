"""Plan checks: pushdown, pruning, top-k, no Python in the hot path, filter above window."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as E
from orderscope.operators import clean, questions, reports
from orderscope.plans import registry
from orderscope.session import fresh_path
from orderscope.sources import files, tables

from .conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


def plan(df) -> str:
    """The formatted physical plan (full text, not truncated)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def raw_parquet(spark):
    path = fresh_path(spark, "test-raw-orders")
    tables.ventas(spark, SF_SMALL).write.parquet(path)
    return path


def test_validity_predicates_reach_the_scan(spark, raw_parquet):
    df = clean.clean_orders(spark.read.parquet(raw_parquet))
    p = plan(df)
    assert "GreaterThan(precio_unitario,0.0)" in p
    assert "GreaterThan(cantidad,0)" in p


def test_report_reads_only_needed_columns(spark, raw_parquet):
    p = plan(reports.report_status(spark.read.parquet(raw_parquet)))
    read_schema = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    for unused in ("producto", "cliente_id", "ciudad", "categoria"):
        assert unused not in read_schema


def test_top_cities_is_take_ordered(spark):
    cities = reports.report_city(tables.ventas(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan(questions.top_cities(cities, 3).drop("posicion"))


def scans(text: str) -> int:
    return sum(line.lstrip(" :+-").startswith(("Scan parquet", "* Scan parquet")) or "FileScan parquet" in line for line in text.splitlines())


@pytest.mark.parametrize("key", ["clean_orders", "parquet_roundtrip"])
def test_cleaning_joins_the_tables_once(spark, key, monkeypatch):
    """All source tables are read by one write; what follows reads the stored rows."""
    from pyspark.sql.readwriter import DataFrameWriter

    written = []
    real = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (
        written.append(self._df._jdf.queryExecution().executedPlan().toString()), real(self, path, *a, **k))[1])
    final = plan(E.queries()[key](spark, SF_SMALL))
    joins = [p for p in [*written, final] if "SortMergeJoin" in p or "BroadcastHashJoin" in p]
    assert len(joins) == 1 and scans(joins[0]) == 6


def test_grouping_sets_expand_sums_not_orders(spark):
    lines = optimized(reports.grouped_measures(tables.ventas(spark, SF_SMALL))).splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand" in line)
    below = lines[expand + 1:]
    assert "Aggregate" in "".join(below[:2])          # the sums per combination of keys are right below


def test_year_filter_stays_above_the_window(spark):
    monthly = reports.report_monthly(tables.ventas(spark, SF_SMALL))
    opt = optimized(questions.monthly_for_year(monthly, 1996))
    lines = opt.splitlines()
    filt = next(i for i, line in enumerate(lines) if "Filter" in line and "anio" in line and "1996" in line)
    window = next(i for i, line in enumerate(lines) if line.lstrip(":- +").startswith("Window"))
    assert filt < window          # printed higher = applied later


def test_partitioned_write_prunes_partitions(spark):
    path = fresh_path(spark, "test-clean")
    files.write_clean_parquet(clean.clean_orders(tables.ventas(spark, SF_SMALL)), path)
    df = files.read_clean_parquet(spark, path).filter("anio = 1996 AND mes = 3")
    filters = [line for line in plan(df).splitlines() if line.startswith("PartitionFilters")]
    assert filters and "anio" in filters[0] and "1996" in filters[0]


@pytest.mark.parametrize("key", ["report_category", "report_monthly", "clean_orders", "executive_summary",
                                 "transcript_text"])
def test_no_python_in_plans(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert not any(node in p for node in PYTHON_NODES), key


def test_report_aggregates_once_with_partial_aggregation(spark):
    p = plan(reports.report_category(tables.ventas(spark, SF_SMALL)))
    assert p.count("HashAggregate") >= 2          # partial (map side) + final
    assert "BroadcastNestedLoopJoin" not in p     # no self-join for the totals


@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_no_cross_joins_or_python(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key
    assert not any(node in p for node in PYTHON_NODES), key
