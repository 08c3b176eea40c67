"""Hand fixtures: nulls, NaN, invalid rows, thresholds, ties, empty input, half-cents."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from orderscope.operators import charts, clean, questions, reports
from orderscope.schemas import CLEAN_ORDERS, RAW_ORDERS

from .conftest import rows

T0 = dt.datetime(2022, 1, 1, 10, 0)


def order(i, categoria="A", ciudad="X", precio=10.0, cantidad=1, descuento=0.0, calificacion=4.0,
          fecha=T0, pago="Tarjeta", estado="Entregado", departamento="D"):
    return (i, fecha, 1000 + i, categoria, "p", cantidad, precio, descuento, pago, ciudad, departamento,
            estado, calificacion)


def frame(spark, data):
    return spark.createDataFrame(data, RAW_ORDERS)


def test_fill_uses_mean_over_all_raw_rows_including_invalid(spark):
    data = [order(1, calificacion=5.0), order(2, calificacion=None),
            order(3, precio=0.0, calificacion=1.0)]          # invalid row still counts for the mean
    out = rows(clean.clean_orders(frame(spark, data)), order=lambda r: r["orden_id"])
    assert [r["orden_id"] for r in out] == [1, 2]
    assert out[1]["calificacion"] == pytest.approx(3.0)
    report = rows(reports.report_category(frame(spark, data)))
    assert report[0]["calificacion_promedio"] == 4.0        # (5 + 3) / 2


def test_nan_counts_as_missing(spark):
    data = [order(1, calificacion=float("nan"), descuento=float("nan")), order(2, calificacion=2.0)]
    out = rows(clean.clean_orders(frame(spark, data)), order=lambda r: r["orden_id"])
    assert out[0]["calificacion"] == 2.0
    assert out[0]["descuento_pct"] == 0.0 and out[0]["tiene_descuento"] == 0
    assert not math.isnan(out[0]["total_venta"])


def test_validity_filter_three_valued(spark):
    data = [order(1, precio=0.0), order(2, precio=-5.0), order(3, precio=None), order(4, cantidad=0),
            order(5, cantidad=None), order(6, precio=float("nan")), order(7)]
    out = rows(clean.clean_orders(frame(spark, data)))
    assert [r["orden_id"] for r in out] == [7]
    prof = rows(clean.profile(frame(spark, data)))[0]
    assert prof["filas"] == 7 and prof["filas_validas"] == 1


def test_null_discount_is_zero_and_flag(spark):
    data = [order(1, descuento=None), order(2, descuento=10.0)]
    out = rows(clean.clean_orders(frame(spark, data)), order=lambda r: r["orden_id"])
    assert out[0]["descuento_pct"] == 0.0 and out[0]["tiene_descuento"] == 0
    assert out[1]["tiene_descuento"] == 1 and out[1]["total_venta"] == pytest.approx(9.0)


def test_derived_columns_and_null_route(spark):
    data = [order(1, ciudad=None, fecha=dt.datetime(2023, 12, 31, 23, 0))]
    out = rows(clean.clean_orders(frame(spark, data)))[0]
    assert (out["anio"], out["mes"], out["hora"]) == (2023, 12, 23)
    assert out["ruta"] is None
    assert [f.name for f in clean.clean_orders(frame(spark, data)).schema.fields] == CLEAN_ORDERS.fieldNames()


def test_city_having_is_strict(spark):
    data = [order(i, ciudad="Quinientos") for i in range(500)] + \
           [order(1000 + i, ciudad="Quinientosuno") for i in range(501)]
    out = rows(reports.report_city(frame(spark, data)))
    assert [r["ciudad"] for r in out] == ["Quinientosuno"]
    both = rows(reports.report_city(frame(spark, data), min_orders=499))
    assert {r["ciudad"] for r in both} == {"Quinientos", "Quinientosuno"}


def test_ties_are_broken_by_key(spark):
    data = [order(1, categoria="B"), order(2, categoria="A"), order(3, categoria="C")]
    cats = reports.report_category(frame(spark, data))
    assert [r["categoria"] for r in cats.collect()] == ["A", "B", "C"]
    ranked = questions.category_ranking(cats, "ingreso_total")
    assert [(r["posicion"], r["categoria"]) for r in ranked.collect()] == [(1, "A"), (2, "B"), (3, "C")]
    summary = rows(questions.executive_summary(cats, reports.report_city(frame(spark, data), 0),
                                               reports.report_payment(frame(spark, data))))[0]
    assert summary["categoria_top"] == "A"


def test_previous_month_zero_revenue_gives_null_change(spark):
    data = [order(1, precio=0.01, cantidad=1, descuento=100.0, fecha=dt.datetime(2022, 1, 5)),
            order(2, precio=10.0, fecha=dt.datetime(2022, 2, 5))]
    out = rows(reports.report_monthly(frame(spark, data)), order=lambda r: r["mes"])
    assert out[0]["ingreso_total"] == 0.0 and out[0]["variacion_pct"] is None
    assert out[1]["variacion_pct"] is None


def test_half_cent_revenue_rounds_half_up_exactly(spark):
    # 0.05 × 1 × (1 − 10 %) = 0.045 exactly; a double sum sees 0.04499… and rounds down.
    data = [order(1, precio=0.05, descuento=10.0)]
    out = rows(reports.report_category(frame(spark, data)))[0]
    assert out["ingreso_total"] == 0.05
    many = [order(i, precio=0.05, descuento=10.0) for i in range(3)]   # 0.135 → 0.14
    assert rows(reports.report_category(frame(spark, many)))[0]["ingreso_total"] == 0.14


def test_integer_rating_column_is_not_truncated(spark):
    data = spark.createDataFrame([(1, 5), (2, None), (3, 2)], "orden_id long, calificacion int")
    full = data.select(
        "orden_id", F.lit(T0).cast("timestamp_ntz").alias("fecha"), F.lit(1).cast("long").alias("cliente_id"),
        F.lit("A").alias("categoria"), F.lit("p").alias("producto"), F.lit(1).alias("cantidad"),
        F.lit(10.0).alias("precio_unitario"), F.lit(0.0).alias("descuento_pct"), F.lit("T").alias("metodo_pago"),
        F.lit("X").alias("ciudad"), F.lit("D").alias("departamento"), F.lit("E").alias("estado_envio"),
        "calificacion")
    out = rows(clean.clean_orders(full), order=lambda r: r["orden_id"])
    assert out[1]["calificacion"] == 3.5


def test_empty_input_gives_empty_reports_with_schema(spark):
    empty = spark.createDataFrame([], RAW_ORDERS)
    for name, df in reports.report_tables(empty).items():
        assert df.count() == 0, name
    cats = reports.report_category(empty)
    assert cats.count() == 0
    assert cats.columns[0] == "categoria"
    summary = rows(questions.executive_summary(cats, reports.report_city(empty), reports.report_payment(empty)))
    assert summary[0]["categoria_top"] == "N/A" and summary[0]["ciudad_top"] == "N/A"
    assert rows(charts.kpis(cats))[0]["total_ordenes"] is None


def test_lookup_ignores_case_and_misses_cleanly(spark):
    data = [order(1, categoria="Ropa"), order(2, categoria="Hogar")]
    cats = reports.report_category(frame(spark, data))
    assert rows(questions.category_lookup(cats, "rOPA"))[0]["categoria"] == "Ropa"
    assert questions.category_lookup(cats, "Juguetes").count() == 0
    assert [r["categoria"] for r in questions.category_options(cats).collect()] == ["Hogar", "Ropa"]


def test_ranking_whitelist_and_top_k_rules(spark):
    cats = reports.report_category(frame(spark, [order(1)]))
    for bad in ("total_unidades", "pct_con_descuento", "nope"):
        with pytest.raises(ValueError):
            questions.category_ranking(cats, bad)
    assert questions.top_k("25") == 25 and questions.top_k(3.9) == 3 and questions.top_k(0) == 0
    for n, limit in ((-1, None), (11, 10)):
        with pytest.raises(ValueError):
            questions.top_k(n, limit)
    cities = reports.report_city(frame(spark, [order(i, ciudad=f"c{i:02d}") for i in range(14)]), min_orders=0)
    assert questions.top_cities(cities, 12).count() == 12


def test_monthly_year_filter_keeps_lag_and_unknown_year_is_empty(spark):
    data = [order(1, fecha=dt.datetime(2022, 12, 1)), order(2, precio=20.0, fecha=dt.datetime(2023, 1, 1))]
    monthly = reports.report_monthly(frame(spark, data))
    jan = rows(questions.monthly_for_year(monthly, 2023))
    assert len(jan) == 1 and jan[0]["variacion_pct"] == 100.0 and jan[0]["variacion_texto"] == "+100.0%"
    assert questions.monthly_for_year(monthly, 1999).count() == 0
    everything = rows(questions.monthly_for_year(monthly, 0))
    assert [r["variacion_texto"] for r in everything] == ["base", "+100.0%"]
    assert everything[0]["linea"] == "  2022 Dic: 1 ordenes | $10 | var: base"


def test_text_formats_match_python(spark):
    from orderscope.functions import fmt
    values = [0.0, 0.5, 1.5, 2.5, 2.675, 1234.5, 1234567.891, 3540.055, -0.04, -12.35, 99.95, 1e9 + 0.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    out = df.select("x", fmt.thousands(F.col("x")).alias("a"), fmt.money2(F.col("x")).alias("b"),
                    fmt.fixed(F.col("x"), 2).alias("c"), fmt.fixed(F.col("x"), 1).alias("d"),
                    fmt.signed_pct(F.col("x")).alias("e")).collect()
    for r in out:
        x = r["x"]
        assert r["a"] == f"{x:,.0f}", x
        assert r["b"] == f"${x:,.2f}", x
        assert r["c"] == f"{x:.2f}", x
        assert r["d"] == f"{x:.1f}", x
        assert r["e"] == f"{x:+.1f}%", x


def test_schema_rows(spark):
    out = {r["columna"]: (r["posicion"], r["tipo"], r["nulos"])
           for r in clean.schema_rows(frame(spark, [order(1, descuento=None), order(2)])).collect()}
    assert out["orden_id"] == (1, "bigint", 0) and out["fecha"] == (2, "timestamp_ntz", 0)
    assert out["descuento_pct"] == (8, "double", 1) and len(out) == 13


def test_revenue_below_a_cent_is_not_lost(spark):
    data = [order(i, precio=0.004, cantidad=5) for i in range(1000)]
    report = rows(reports.report_category(frame(spark, data)))[0]
    assert report["ingreso_total"] == 20.0 and report["ticket_promedio"] == 0.02
    mixed = [order(1, precio=0.05, descuento=10.0), order(2, precio=1.2345, descuento=12.5), order(3, precio=3e9, cantidad=4)]
    assert rows(reports.report_category(frame(spark, mixed)))[0]["ingreso_total"] == pytest.approx(12e9 + 0.045 + 1.2345 * 0.875, abs=0.006)


def test_infinite_price_is_no_price_anywhere(spark):
    data = [order(1, precio=float("inf")), order(2, precio=10.0), order(3, calificacion=float("inf"), descuento=float("-inf"))]
    assert [r["orden_id"] for r in rows(clean.clean_orders(frame(spark, data)), order=lambda r: r["orden_id"])] == [2, 3]
    report = rows(reports.report_category(frame(spark, data)))[0]
    assert report["total_ordenes"] == 2 and report["ingreso_total"] == 20.0 and report["calificacion_promedio"] == 4.0


def test_clean_ratings_sum_exactly_in_any_order(spark):
    data = [order(i, calificacion=None if i % 3 else 1.0 + i % 5) for i in range(400)]
    cleaned = clean.clean_orders(frame(spark, data))
    want = rows(reports.report_category(frame(spark, data)))
    for parts in (1, 3, 11):
        assert rows(reports.report_category(cleaned.repartition(parts, "orden_id"))) == want


def test_answers_have_headers_and_say_when_there_are_no_data(spark):
    data = [order(1, categoria="Ropa"), order(2, categoria="Hogar", precio=20.0)]
    tables = reports.report_tables(frame(spark, data), min_city_orders=0)
    got = {r["pregunta"]: r["texto"] for r in questions.answers(tables, "ingreso_total", 3, 2022).collect()}
    assert got["ranking"] == "Ranking por ingreso_total:\n  1. Hogar: 20.0\n  2. Ropa: 10.0\n"
    assert got["ciudades"] == "Top 3 ciudades por ingreso:\n  1. X (D): $30 | 2 ordenes\n"
    assert got["pagos"] == "Metodos de pago:\n  Tarjeta: 2 ordenes | $30\n"
    assert got["meses"] == "Evolucion mensual (2022):\n  2022 Ene: 2 ordenes | $30 | var: base\n"
    assert got["estados"] == "Estados de envio:\n  Entregado: 2 ordenes | calif: 4.00/5\n"
    missing = rows(questions.category_answer(tables["categorias"], "Libros"))[0]["texto"]
    assert missing == "Categoria no encontrada. Opciones: ['Hogar', 'Ropa']"
    assert rows(questions.category_answer(tables["categorias"], "ROPA"))[0]["texto"].startswith("Ropa:\n  Ordenes:            1\n")
    nothing = reports.report_tables(frame(spark, []))
    assert {r["texto"] for r in questions.answers(nothing, "ingreso_total", 3, 0).collect()} == {"Datos no disponibles."}
    assert rows(questions.category_answer(nothing["categorias"], "Ropa"))[0]["texto"] == "Datos no disponibles."


def test_city_threshold_from_the_data(spark):
    data = [order(i, ciudad="grande") for i in range(9)] + [order(100, ciudad="chica")]
    assert [r["ciudad"] for r in rows(reports.report_city(frame(spark, data), min_orders=None))] == ["grande"]


def test_null_group_key_is_its_own_group(spark):
    data = [order(1, ciudad=None, departamento=None), order(2, ciudad=None, departamento=None),
            order(3, ciudad="X")]
    out = {r["ciudad"]: r["total_ordenes"] for r in reports.report_city(frame(spark, data), min_orders=0).collect()}
    assert out == {None: 2, "X": 1}
    shares = {r["metodo_pago"]: r["pct_of_total_ordenes"] for r in reports.report_payment(frame(spark, data)).collect()}
    assert shares == {"Tarjeta": 100.0}


def test_names_match_ignoring_case_in_every_script(spark):
    """By collation: the column is compared as it is, not lowered."""
    from .test_plans import plan
    data = [order(1, categoria="Électronica"), order(2, categoria="ΟΔΟΣ"), order(3, categoria="Hogar")]
    found = reports.report_category(frame(spark, data))
    for name in ("ÉLECTRONICA", "électronica"):
        assert [r["categoria"] for r in rows(questions.category_lookup(found, name))] == ["Électronica"]
        assert rows(questions.category_answer(found, name))[0]["texto"].startswith("Électronica:")
    assert rows(questions.category_lookup(found, "Electronica")) == []
    text = plan(questions.category_lookup(found, "hogar"))
    assert "lower(" not in text and "UTF8_LCASE" in text


def test_top_of_wide_keys_without_sorting_them(spark):
    from .test_plans import plan
    data = [order(i, precio=float(1 + i % 40)) for i in range(200)] + [order(500, precio=1e25), order(501, precio=1e25), order(502, precio=0.0)]
    df = frame(spark, data).withColumn("cliente_id", F.when(F.col("orden_id") < 500, F.col("orden_id") % 30).otherwise(F.col("orden_id") - 400))
    top = questions.top_keys(df, ["producto", "cliente_id"])
    out = {r["clave"]: r for r in rows(top)}
    assert (out["cliente_id"]["valor"], out["cliente_id"]["ingreso_total"], out["cliente_id"]["claves"]) == ("100", 1e25, 32)
    assert (out["producto"]["valor"], out["producto"]["total_ordenes"], out["producto"]["claves"]) == ("p", 202, 1)
    text = plan(top)
    assert "Window" not in text and "Sort" not in text.replace("SortAggregate", "") and "partial_min_by" in text
    assert rows(questions.top_keys(df.filter("cantidad < 0"), ["producto"])) == []

