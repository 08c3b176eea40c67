"""Every registered query against its DuckDB oracle on the driver tables.

Runs at sf0.01 by default; set ORDERSCOPE_ORACLE_SF (a list separated by
commas) for other scale factors.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from orderscope.plans import registry
from orderscope.plans.compare import compare, duckdb_connection

from .conftest import SF_MEDIUM

SF_DIRS = [d for d in os.environ.get("ORDERSCOPE_ORACLE_SF", SF_MEDIUM).split(",") if d]
_CONNECTIONS: dict[str, object] = {}


def _con(sf_dir):
    if sf_dir not in _CONNECTIONS:
        _CONNECTIONS[sf_dir] = duckdb_connection(sf_dir)
    return _CONNECTIONS[sf_dir]


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("sf_dir", SF_DIRS)
@pytest.mark.parametrize("key", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, key, sf_dir):
    result = compare(spark, key, sf_dir, _con(sf_dir))
    assert result["status"] == "match", result


def test_mean_threshold_removes_some_cities_but_not_all(spark):
    every = E.queries()["report_city"](spark, SF_MEDIUM).count()
    assert 0 < E.queries()["report_city_having"](spark, SF_MEDIUM).count() < every


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["categoria", "total_ordenes", "total_unidades", "ingreso_total",
                          "ticket_promedio", "calificacion_promedio", "pct_con_descuento"]
    assert df.count() > 0
