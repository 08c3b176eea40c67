"""Sources and sinks: lossless round trips, missing reports, the batch job."""

from __future__ import annotations

import datetime as dt

from orderscope.operators import reports
from orderscope.plans import batch
from orderscope.schemas import RAW_ORDERS, REPORTS
from orderscope.session import fresh_path, shared_dir
from orderscope.sources import files, tables

from .conftest import SF_SMALL, rows

T0 = dt.datetime(2022, 3, 4, 5, 0, 0, 123456)


def test_orders_csv_round_trip_is_lossless(spark):
    data = [
        (1, T0, 1001, "Ropa", "Camiseta, azul", 2, 0.1 + 0.2, None, "PSE", "Bogota", "Cundinamarca",
         "Entregado", None),
        (2, T0, 1002, "", 'Con "comillas"', None, 2500.0, 5.0, "Nequi", None, "X", "Pendiente", 3.625),
    ]
    df = spark.createDataFrame(data, RAW_ORDERS)
    path = fresh_path(spark, "test-orders-csv")
    files.write_orders_csv(df, path)
    back = files.read_orders_csv(spark, path)
    key = lambda r: r["orden_id"]
    assert rows(back, order=key) == rows(df, order=key)


def test_missing_report_reads_as_empty_table(spark):
    base = fresh_path(spark, "test-no-reports")
    loaded = files.load_reports(spark, base)
    for name, df in loaded.items():
        assert df.count() == 0 and df.schema == REPORTS[name]


def test_report_csv_round_trip(spark):
    orders = tables.ventas(spark, SF_SMALL)
    base = fresh_path(spark, "test-reports")
    monthly = reports.report_monthly(orders)
    files.write_report_csv(monthly, files.report_path(base, "mensual"))
    back = files.read_report(spark, base, "mensual")
    key = lambda r: (r["anio"], r["mes"])
    assert rows(back, order=key) == rows(monthly, order=key)
    assert rows(back, order=key)[0]["variacion_pct"] is None


def test_batch_job_writes_everything(spark):
    paths = batch.run_pipeline(spark, tables.ventas(spark, SF_SMALL))
    assert paths["clean"].startswith(shared_dir(spark).rstrip("/"))
    stored = batch.stored_reports(spark, paths)
    fresh = reports.report_tables(tables.ventas(spark, SF_SMALL))
    for name in REPORTS:
        key = lambda r: tuple(str(v) for v in r.values())
        assert rows(stored[name], order=key) == rows(fresh[name], order=key), name
    clean = files.read_clean_parquet(spark, paths["clean"])
    assert clean.count() == tables.ventas(spark, SF_SMALL).count()


def test_batch_command_line(spark, capsys):
    import json
    out = fresh_path(spark, "test-cli")
    batch.main(["--rows", "3000", "--out", out])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["rows_categorias"] == 7 and summary["rows_estados"] == 4
    assert summary["rows_pagos"] == 5 and summary["rows_ciudades"] >= 1
    cats = files.read_report(spark, summary["reports"], "categorias")
    assert cats.agg({"total_ordenes": "sum"}).first()[0] == files.read_clean_parquet(spark, summary["clean"]).count()


def test_csv_schema_inference_is_optional(spark):
    orders = tables.ventas(spark, SF_SMALL)
    path = fresh_path(spark, "test-infer-csv")
    files.write_orders_csv(orders, path)
    inferred = files.read_orders_csv(spark, path, infer_schema=True)
    types = dict(inferred.dtypes)
    assert types["orden_id"] in ("int", "bigint") and types["precio_unitario"] == "double"
    assert types["fecha"].startswith("timestamp")
    assert inferred.count() == orders.count()
    explicit = files.read_orders_csv(spark, path)
    assert explicit.schema == RAW_ORDERS


def test_appended_rows_are_seen_by_the_next_query(spark):
    base = fresh_path(spark, "test-append")
    events = tables.table(spark, SF_SMALL, "events")
    events.write.parquet(f"{base}/events.parquet")
    n = tables.events(spark, base).count()
    events.write.mode("append").parquet(f"{base}/events.parquet")
    assert tables.events(spark, base).count() == 2 * n


def test_session_keeps_what_was_submitted():
    """A new driver with another master and partition count finds both unchanged."""
    import os
    import subprocess
    import sys

    from .conftest import ROOT
    env = os.environ | {"PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS":
                        "--master local[2] --conf spark.sql.shuffle.partitions=400 --conf spark.ui.enabled=false pyspark-shell"}
    code = ("from orderscope.session import get_session; s = get_session(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "GOT local[2] 400 UTC" in out


def test_reports_on_prices_with_more_decimals_match_the_oracle(spark):
    """Three and more decimals, and one infinite price, against SQL that does not cast to cents."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from orderscope.plans.compare import compare, duckdb_connection
    path = fresh_path(spark, "test-decimals").removeprefix("file:")
    os.makedirs(path)
    for name in tables.TABLES:
        t = pq.read_table(f"{SF_SMALL}/{name}.parquet")
        if name == "part":
            prices = [0.004 if i % 4 == 0 else 12.3456 + i / 1000 if i % 4 == 1 else 9.99 for i in range(t.num_rows)]
            prices[2] = float("inf")
            t = t.set_column(t.schema.get_field_index("p_retailprice"), "p_retailprice", pa.array(prices))
        pq.write_table(t, f"{path}/{name}.parquet")
    con = duckdb_connection(path)
    for key in ("report_category", "report_city", "report_payment", "report_monthly", "report_status", "clean_orders", "kpis"):
        assert compare(spark, key, path, con)["status"] == "match", key
