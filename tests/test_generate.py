"""Generator and exact k-smallest selection."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderscope.operators import generate as G
from orderscope.operators.selection import smallest_k_flag, threshold

from .conftest import SF_SMALL, rows


def brute_k_smallest(pairs, k):
    return {i for _, i in sorted(pairs)[:k]}


@pytest.mark.parametrize("k", [0, 1, 7, 50, 99, 100, 150])
def test_selection_matches_brute_force(spark, k):
    # few distinct draws: many ties on h, broken by id
    data = [((i * 7919) % 13, i) for i in range(100)]
    df = spark.createDataFrame(data, "h long, id long")
    got = {r["id"] for r in smallest_k_flag(df, "h", "id", k, "sel").filter("sel").collect()}
    assert got == brute_k_smallest(data, k)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=(1 << 32) - 1), min_size=1, max_size=60),
       st.integers(min_value=0, max_value=70))
def test_selection_random(spark, draws, k):
    data = [(h, i) for i, h in enumerate(draws)]
    df = spark.createDataFrame(data, "h long, id long")
    got = {r["id"] for r in smallest_k_flag(df, "h", "id", k, "sel").filter("sel").collect()}
    assert got == brute_k_smallest(data, k)


def test_threshold_none_when_k_covers_all(spark):
    df = spark.createDataFrame([(5, 1), (3, 2)], "h long, id long")
    assert threshold(df, "h", "id", 2) is not None
    assert threshold(df, "h", "id", 3) is None


def test_reference_calendar_has_17497_hours(spark):
    bounds = spark.createDataFrame([(G.CALENDAR_START, G.CALENDAR_END)], "start timestamp_ntz, end timestamp_ntz")
    cal = G.hourly_calendar(bounds)
    assert cal.count() == 17497 == G.HOURS_IN_CALENDAR
    last = cal.agg(F.max("fecha")).first()[0]
    assert last == dt.datetime(2023, 12, 31, 0, 0)


@pytest.fixture(scope="module")
def generated(spark):
    return G.generate_orders(G.order_ids(spark, SF_SMALL)).cache()


def test_generated_domains(spark, generated):
    r = generated.agg(
        F.min("cliente_id"), F.max("cliente_id"), F.min("cantidad"), F.max("cantidad"),
        F.min("precio_unitario"), F.max("precio_unitario"), F.min("fecha"), F.max("fecha"),
        F.count_if(F.col("descuento_pct").isNull()), F.count_if(F.col("calificacion").isNull()),
        F.count(F.lit(1)), F.countDistinct("orden_id")).first()
    assert 1000 <= r[0] and r[1] <= 49999 and 1 <= r[2] and r[3] <= 5
    assert 15.0 <= r[4] and r[5] <= 2500.0
    assert G.CALENDAR_START <= r[6] and r[7] <= G.CALENDAR_END
    n = r[10]
    assert r[11] == n                                       # one order per id
    assert r[8] == n * 2000 // 500000 and r[9] == n * 4000 // 500000
    cats = {x["categoria"] for x in generated.select("categoria").distinct().collect()}
    assert cats <= set(G.CATEGORIES)
    pairs = {(x["ciudad"], x["departamento"]) for x in generated.select("ciudad", "departamento").distinct().collect()}
    assert pairs <= set(G.CITIES.items())
    for x in generated.select("categoria", "producto").distinct().collect():
        assert x["producto"] in G.PRODUCTS[x["categoria"]]


def test_generation_independent_of_partitioning(spark, generated):
    ids = G.order_ids(spark, SF_SMALL)
    again = G.generate_orders(ids.repartition(5))
    key = lambda r: r["orden_id"]
    assert rows(again, order=key) == rows(generated, order=key)


def test_weighted_pick_follows_weights(spark):
    ids = spark.range(1, 200001).withColumnRenamed("id", "orden_id")
    counts = {(r["columna"], r["valor"]): r["n"] for r in G.weighted_counts(ids).collect()}
    n = 200000
    for value, weight in zip(G.CATEGORIES, G.CATEGORY_WEIGHTS):
        assert counts[("categoria", value)] / n == pytest.approx(weight / 100, abs=0.006)
    for value, weight in zip(G.STATUSES, G.STATUS_WEIGHTS):
        assert counts[("estado_envio", value)] / n == pytest.approx(weight / 100, abs=0.006)


def test_calendar_keeps_minute_phase_across_days(spark):
    start, end = dt.datetime(2022, 1, 1, 22, 30), dt.datetime(2022, 1, 3, 1, 30)
    bounds = spark.createDataFrame([(start, end)], "start timestamp_ntz, end timestamp_ntz")
    got = sorted(r["fecha"] for r in G.hourly_calendar(bounds).collect())
    want = [start + dt.timedelta(hours=i) for i in range(int((end - start).total_seconds() // 3600) + 1)]
    assert got == want


def test_selection_large_tie_group_uses_radix_on_ids(spark):
    data = [(7 if i % 3 else 2, (i * 104729) % 100003 - 50000) for i in range(300)]   # many ties, signed ids
    df = spark.createDataFrame(data, "h long, id long")
    for k in (1, 100, 150, 299):
        got = {r["id"] for r in smallest_k_flag(df, "h", "id", k, "sel").filter("sel").collect()}
        assert got == {i for _, i in sorted(data)[:k]}, k
