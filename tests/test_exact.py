"""Exact sums of doubles of any size: against fractions, in the reports, and without cost for ordinary rows."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from orderscope.functions import exact
from orderscope.operators import charts, questions, reports
from orderscope.plans import batch
from orderscope.session import fresh_path
from orderscope.sources import files

from .conftest import rows
from .test_fixtures import frame, order
from .test_plans import PYTHON_NODES, plan


def limb_sums(spark, pairs, ordinary="0"):
    x, at = F.col("x"), F.col("at")
    df = spark.createDataFrame(pairs, "g int, x double").withColumn("at", exact.band(x)).repartition(7)
    sums = df.groupBy("g", "at").agg(F.sum(exact.low(x, at)).alias("lo"), F.sum(exact.middle(x, at)).alias("mid"), F.sum(exact.high(x, at)).alias("hi"))
    return sums.groupBy("g").agg(F.collect_list(exact.entry(at, F.col("lo"), F.col("mid"), F.col("hi"))).alias("e")) \
        .withColumn("t", exact.total(F.col("e"), F.lit(ordinary).cast("decimal(38,17)")))


def nearest(values):
    total = sum(map(Fraction, values))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def test_sums_equal_fractions(spark):
    rng = random.Random(7)
    pairs = []
    for g in range(150):
        for _ in range(rng.randrange(1, 9)):
            size = rng.choice([9, 12, 15, 16, 18, 20, 21, 25, 40, 100, 290, 307])
            x = rng.choice([rng.uniform(-1, 1) * 10.0 ** size, 2.0 ** 80, -(2.0 ** 79), 1e15 + 0.125, 1.7e308])
            pairs += [(g, x), (g, -x)] if rng.random() < 0.3 else [(g, x)]
    for ordinary in ("0", "12.345", "-7.005"):
        for r in limb_sums(spark, pairs, ordinary).collect():
            mine = [x for g, x in pairs if g == r.g]
            assert r.t.nearest == nearest([*mine, Fraction(ordinary)]), (mine, ordinary)
            if r.t.exact is not None:
                assert abs(Fraction(r.t.exact) - sum(map(Fraction, mine)) - Fraction(ordinary)) < Fraction(1, 10 ** 14)


def test_cancelled_and_infinite_values(spark):
    pairs = [(1, 1e300), (1, -1e300), (1, 3e15), (2, math.inf), (2, 1e15), (3, math.inf), (3, -math.inf), (4, -math.inf)]
    out = {r.g: r.t.nearest for r in limb_sums(spark, pairs).collect()}
    assert out[1] == 3e15 and out[2] == math.inf and math.isnan(out[3]) and out[4] == -math.inf


@pytest.mark.parametrize("price", [1e15, 123456789012345678.0, 1e22, 1.5e300])
def test_a_huge_price_gives_the_right_sum(spark, price):
    data = [order(1, precio=price, cantidad=3), order(2, precio=0.07, descuento=5.0), order(3, precio=price, cantidad=2, descuento=50.0)]
    out = rows(reports.report_category(frame(spark, data)))[0]
    total = Fraction(price * 3 * 1.0) + Fraction(price * 2 * 0.5) + Fraction("0.0665")
    assert out["ingreso_total"] == (float(round(total, 2)) if total < 10 ** 15 else float(total))
    assert out["ticket_promedio"] == pytest.approx(float(total) / 3, rel=1e-15)
    assert out["total_ordenes"] == 3


@pytest.mark.parametrize("rating", [1e12, 1.5e12, -4e18, 1e300])
def test_a_huge_rating_gives_the_right_mean(spark, rating):
    data = [order(1, calificacion=rating), order(2, calificacion=3.0), order(3, calificacion=None), order(4, categoria="B", calificacion=2.5, precio=0.0)]
    out = rows(reports.report_category(frame(spark, data)))[0]
    known, fill = rating + 3.0, nearest([rating, 3.0, 2.5]) / 3
    assert out["calificacion_promedio"] == pytest.approx((known + fill) / 3, rel=1e-12)


def test_a_sale_beyond_all_doubles_is_infinite_not_an_error(spark):
    data = [order(1, precio=1.7e308, cantidad=9), order(2), order(3, categoria="B", precio=1.7e308, cantidad=9, descuento=100.0)]
    out = {r["categoria"]: r["ingreso_total"] for r in rows(reports.report_category(frame(spark, data)))}
    assert out == {"A": math.inf, "B": 0.0}


def test_every_report_and_answer_survives_huge_values(spark):
    data = [order(i, precio=10.0 ** (i % 40), descuento=float(i % 3) * 1e5, calificacion=10.0 ** (i % 30)) for i in range(1, 80)]
    tables = reports.report_tables(frame(spark, data), 0)
    base = fresh_path(spark, "test-huge")
    files.write_reports(tables, base)
    for name, df in files.load_reports(spark, base).items():
        assert rows(df, order=str) == rows(tables[name], order=str), name
    one = {name: f(frame(spark, data)) for name, f in (("categorias", reports.report_category), ("mensual", reports.report_monthly))}
    for name, df in one.items():
        assert rows(df, order=str) == rows(tables[name], order=str)
    assert rows(charts.kpis(tables["categorias"]))[0]["total_ordenes"] == 79
    whole = rows(questions.executive_summary_of_orders(frame(spark, data), 0))
    assert whole == rows(questions.executive_summary(tables["categorias"], tables["ciudades"], tables["pagos"]))
    batch.run_pipeline(spark, frame(spark, data), fresh_path(spark, "test-huge-run"))


def test_the_sum_does_not_depend_on_the_order_of_rows(spark):
    rng = random.Random(2)
    data = [order(i, precio=rng.uniform(0.01, 1) * 10.0 ** rng.randrange(1, 19), descuento=rng.random() * 40) for i in range(400)]
    total = {rows(reports.report_category(frame(spark, rng.sample(data, 400)).repartition(n)))[0]["ingreso_total"] for n in (1, 3, 8)}
    assert len(total) == 1


def test_plan_has_no_python_and_no_further_shuffle(spark):
    text = plan(reports.report_category(frame(spark, [order(1)])))
    assert not any(node in text for node in PYTHON_NODES)
    exchanges = [line for line in text.splitlines() if line.lstrip(" :+-*").startswith("Exchange (")]
    assert len(exchanges) == 2          # by group, and to the group rows' one partition
