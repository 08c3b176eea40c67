"""Arithmetic checks on the published report outputs (typed in below).

The original project's committed report tables are the only golden data:
its monthly revenues must reproduce its month-over-month changes, its
category rows its dashboard KPIs, its payment rows its shares.
"""

from __future__ import annotations

import pytest

from orderscope.operators import charts, questions, reports
from orderscope.schemas import REPORTS

from .conftest import rows

# Published monthly report (anio, mes, total_ordenes, ingreso_total, variacion_pct).
MONTHLY = [
    (2022, 1, 21218, 75756805.28, None), (2022, 2, 19198, 67181201.18, -11.32),
    (2022, 3, 21283, 74953274.01, 11.57), (2022, 4, 20425, 71752757.01, -4.27),
    (2022, 5, 21373, 75560934.1, 5.31), (2022, 6, 20532, 72367923.52, -4.23),
    (2022, 7, 21035, 74760466.41, 3.31), (2022, 8, 21124, 74709218.51, -0.07),
    (2022, 9, 20559, 73004788.66, -2.28), (2022, 10, 21420, 75872936.19, 3.93),
    (2022, 11, 20696, 73550305.18, -3.06), (2022, 12, 21267, 75141435.28, 2.16),
    (2023, 1, 21305, 75073795.54, -0.09), (2023, 2, 19394, 68437680.83, -8.84),
    (2023, 3, 21374, 75605226.56, 10.47), (2023, 4, 20344, 71742749.5, -5.11),
    (2023, 5, 21151, 74616642.95, 4.01), (2023, 6, 20480, 73263737.31, -1.81),
    (2023, 7, 21451, 76805718.63, 4.83), (2023, 8, 21249, 75062865.93, -2.27),
    (2023, 9, 20785, 73495422.68, -2.09), (2023, 10, 21451, 76239516.5, 3.73),
    (2023, 11, 20405, 71582963.44, -6.11), (2023, 12, 20481, 72143584.69, 0.78),
]

# Published category report.
CATEGORIES = [
    ("Electronica", 124969, 374648, 442186635.14, 3538.37, 3.62, 34.84),
    ("Ropa", 99475, 297848, 351207388.8, 3530.61, 3.62, 34.77),
    ("Deportes", 75442, 226771, 267345733.57, 3543.73, 3.62, 35.15),
    ("Hogar", 75174, 225595, 265306730.03, 3529.24, 3.62, 34.91),
    ("Belleza", 50079, 149852, 177638716.54, 3547.17, 3.62, 34.46),
    ("Libros", 49893, 149102, 176033459.64, 3528.22, 3.62, 34.68),
    ("Juguetes", 24968, 75239, 88963286.17, 3563.09, 3.62, 34.85),
]

# Published payment report.
PAYMENTS = [
    ("Tarjeta", 174849, 617876857.65, 34.97), ("PSE", 125293, 445022275.46, 25.06),
    ("Efectivo", 75200, 265948934.49, 15.04), ("Contraentrega", 74602, 262864467.76, 14.92),
    ("Nequi", 50056, 176969414.52, 10.01),
]


def test_monthly_changes_follow_from_rounded_revenue(spark):
    df = spark.createDataFrame([(a, m, n, r, 3.62) for a, m, n, r, _ in MONTHLY],
                               "anio int, mes int, total_ordenes long, ingreso_total double, "
                               "calificacion_promedio double")
    out = rows(reports.month_over_month(df))
    assert [r["variacion_pct"] for r in out] == [v for *_, v in MONTHLY]
    jan = rows(questions.monthly_for_year(reports.month_over_month(df), 2023))
    assert jan[0]["variacion_texto"] == "-0.1%" and len(jan) == 12


def test_kpis_mean_of_groups_and_weighted(spark):
    cats = spark.createDataFrame(CATEGORIES, REPORTS["categorias"])
    k = rows(charts.kpis(cats))[0]
    assert k["total_ordenes"] == 500000
    assert k["ingreso_total"] == pytest.approx(1768681949.89, abs=1e-6)
    assert k["ticket_promedio"] == 3540.06          # unweighted mean of the seven rows
    assert k["ticket_ponderado"] == 3537.36         # revenue / orders
    assert k["calificacion_fmt"] == "3.62 / 5"
    assert k["ingreso_fmt"] == "$1,768,681,950"


def test_payment_shares(spark):
    pay = spark.createDataFrame(PAYMENTS, REPORTS["pagos"])
    out = {r["metodo_pago"]: r["pct_ordenes"] for r in charts.payment_share(pay).collect()}
    assert out == {m: p for m, _, _, p in PAYMENTS}
    assert sum(out.values()) == pytest.approx(100.0, abs=0.05)


def test_summary_and_ranking_on_published_rows(spark):
    cats = spark.createDataFrame(CATEGORIES, REPORTS["categorias"])
    pay = spark.createDataFrame(PAYMENTS, REPORTS["pagos"])
    cities = spark.createDataFrame([("Bogota", "Cundinamarca", 149908, 528188715.84, 3523.42, 3.62)],
                                   REPORTS["ciudades"])
    s = rows(questions.executive_summary(cats, cities, pay))[0]
    assert (s["categoria_top"], s["ciudad_top"], s["metodo_pago_top"]) == ("Electronica", "Bogota", "Tarjeta")
    assert s["texto"].splitlines()[1] == "  Total ordenes:       500,000"
    ranked = rows(questions.category_ranking(cats, "ticket_promedio"))
    assert [r["categoria"] for r in ranked][:2] == ["Juguetes", "Belleza"]
    assert ranked[0]["linea"] == "  1. Juguetes: 3563.09"
    lookup = rows(questions.category_lookup(cats, "electronica"))[0]["texto"].splitlines()
    assert lookup[0] == "Electronica:" and lookup[3] == "  Ingreso total:      $442,186,635"
    assert lookup[5] == "  Calificacion prom:  3.62/5" and lookup[6] == "  Con descuento:      34.8%"
