"""Explicit schemas of the order tables and the five report tables.

Every read in this package passes a schema; inference is only an option of
the CSV reader. ``calificacion`` is a double from the start so that a mean
fill never truncates to an integer, and ``fecha`` is ``timestamp_ntz`` so
that date parts never depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_ORDERS = T.StructType([
    T.StructField("orden_id", T.LongType()),
    T.StructField("fecha", T.TimestampNTZType()),
    T.StructField("cliente_id", T.LongType()),
    T.StructField("categoria", T.StringType()),
    T.StructField("producto", T.StringType()),
    T.StructField("cantidad", T.IntegerType()),
    T.StructField("precio_unitario", T.DoubleType()),
    T.StructField("descuento_pct", T.DoubleType()),
    T.StructField("metodo_pago", T.StringType()),
    T.StructField("ciudad", T.StringType()),
    T.StructField("departamento", T.StringType()),
    T.StructField("estado_envio", T.StringType()),
    T.StructField("calificacion", T.DoubleType()),
])

CLEAN_ORDERS = T.StructType(RAW_ORDERS.fields + [
    T.StructField("total_venta", T.DoubleType()),
    T.StructField("tiene_descuento", T.IntegerType()),
    T.StructField("anio", T.IntegerType()),
    T.StructField("mes", T.IntegerType()),
    T.StructField("hora", T.IntegerType()),
    T.StructField("ruta", T.StringType()),
])

REPORTS = {
    "categorias": T.StructType([
        T.StructField("categoria", T.StringType()),
        T.StructField("total_ordenes", T.LongType()),
        T.StructField("total_unidades", T.LongType()),
        T.StructField("ingreso_total", T.DoubleType()),
        T.StructField("ticket_promedio", T.DoubleType()),
        T.StructField("calificacion_promedio", T.DoubleType()),
        T.StructField("pct_con_descuento", T.DoubleType()),
    ]),
    "ciudades": T.StructType([
        T.StructField("ciudad", T.StringType()),
        T.StructField("departamento", T.StringType()),
        T.StructField("total_ordenes", T.LongType()),
        T.StructField("ingreso_total", T.DoubleType()),
        T.StructField("ticket_promedio", T.DoubleType()),
        T.StructField("calificacion_promedio", T.DoubleType()),
    ]),
    "pagos": T.StructType([
        T.StructField("metodo_pago", T.StringType()),
        T.StructField("total_ordenes", T.LongType()),
        T.StructField("ingreso_total", T.DoubleType()),
        T.StructField("pct_of_total_ordenes", T.DoubleType()),
    ]),
    "mensual": T.StructType([
        T.StructField("anio", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
        T.StructField("total_ordenes", T.LongType()),
        T.StructField("ingreso_total", T.DoubleType()),
        T.StructField("calificacion_promedio", T.DoubleType()),
        T.StructField("variacion_pct", T.DoubleType()),
    ]),
    "estados": T.StructType([
        T.StructField("estado_envio", T.StringType()),
        T.StructField("total_ordenes", T.LongType()),
        T.StructField("ingreso_total", T.DoubleType()),
        T.StructField("calificacion_promedio", T.DoubleType()),
    ]),
}

# File names of the stored reports, one per report table.
REPORT_FILES = {
    "categorias": "agg_categorias",
    "ciudades": "agg_ciudades",
    "pagos": "agg_pagos",
    "mensual": "agg_mensual",
    "estados": "agg_estados",
}
