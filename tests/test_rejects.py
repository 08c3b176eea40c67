"""CSV scan with rejects: every line is accepted or rejected with its reasons, none is lost."""

from __future__ import annotations

import pytest

from orderscope.operators import clean
from orderscope.schemas import RAW_ORDERS
from orderscope.session import fresh_path
from orderscope.sources import files, rejects

from .conftest import rows
from .test_plans import scans
from .test_fixtures import frame, order

GOOD = "1,2022-01-01 10:00:00,1001,Ropa,\"Camiseta, azul\",2,10.5,,PSE,Bogota,Cundinamarca,Entregado,4"
LINES = {
    "precio": ("2,2022-01-01 10:00:00,1001,Ropa,x,2,ten,0,PSE,B,C,Entregado,4", ["tipo:precio_unitario"]),
    "dos": ("3,mañana,1001,Ropa,x,2.5,10,0,PSE,B,C,Entregado,4", ["tipo:fecha", "tipo:cantidad"]),
    "corta": ("4,2022-01-01 10:00:00,1001", ["columnas"]),
    "larga": (GOOD + ",y,z", ["columnas"]),
    "id": ("x5,2022-01-01 10:00:00,1001,Ropa,x,2,10,0,PSE,B,C,Entregado,4", ["tipo:orden_id"]),
    "grande": ("6,2022-01-01 10:00:00,1001,Ropa,x,99999999999,10,0,PSE,B,C,Entregado,4", ["tipo:cantidad"]),
}


@pytest.fixture
def checked(spark):
    path = fresh_path(spark, "test-dirty")
    header = ",".join(RAW_ORDERS.names)
    spark.createDataFrame([("\n".join([header, GOOD, *[line for line, _ in LINES.values()]]),)], "value string").coalesce(1).write.text(path)
    return rejects.read_orders_checked(spark, path)


def test_reasons_and_lines(checked):
    got = {r["linea"]: sorted(r["motivos"]) for r in rows(checked.rejects)}
    assert sorted(got.values()) == sorted(sorted(reasons) for _, reasons in LINES.values())
    for name in ("corta", "larga"):
        assert got[LINES[name][0]] == ["columnas"]
    assert all(r["archivo"].endswith(".txt") for r in rows(checked.rejects))


def test_no_row_is_lost(checked):
    counts = {r["motivo"]: r["filas"] for r in rows(rejects.reject_counts(checked))}
    assert counts == {"tipo:precio_unitario": 1, "tipo:fecha": 1, "tipo:cantidad": 2, "columnas": 2, "tipo:orden_id": 1,
                      "rechazadas": 6, "aceptadas": 1, "total": 7}
    assert rows(checked.good)[0]["producto"] == "Camiseta, azul" and rows(checked.good)[0]["descuento_pct"] is None
    assert checked.good.schema == RAW_ORDERS


def test_clean_files_are_accepted_whole(spark):
    data = frame(spark, [order(1), order(2, descuento=None, calificacion=None), order(3, categoria="", precio=-1.0)])
    path = fresh_path(spark, "test-clean-csv")
    files.write_orders_csv(data, path)
    found = rejects.read_orders_checked(spark, path)
    key = lambda r: r["orden_id"]
    assert rows(found.good, order=key) == rows(data, order=key) and found.rejects.count() == 0
    assert rows(clean.clean_orders(found.good), order=key) == rows(clean.clean_orders(data), order=key)


def test_empty_file_has_neither(spark):
    path = fresh_path(spark, "test-empty-csv")
    files.write_orders_csv(frame(spark, []), path)
    found = rejects.read_orders_checked(spark, path)
    assert found.good.count() == 0 and found.rejects.count() == 0


def test_inferred_types_give_the_same_orders(spark):
    data = frame(spark, [order(1), order(2, descuento=None, precio=10.0), order(3, calificacion=None)])
    path = fresh_path(spark, "test-inferred")
    files.write_orders_csv(data, path)
    inferred = files.read_orders_csv(spark, path, infer_schema=True)
    key = lambda r: r["orden_id"]
    assert rows(clean.conform(inferred), order=key) == rows(clean.conform(data), order=key)


def test_both_sides_read_the_stored_rows(checked):
    for side in (checked.good, checked.rejects):
        text = side._jdf.queryExecution().executedPlan().toString()
        assert scans(text) == 1 and "csv" not in text.lower().replace("to_csv", "")
