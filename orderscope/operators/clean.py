"""Cleaning: null fill, validity filter and derived columns.

Semantics kept from the reference pipeline:

* the rating fill value is the mean of the non-null ratings over **all** raw
  rows, taken before invalid rows are dropped;
* a missing discount counts as 0;
* a row is valid when price > 0, finite, and quantity > 0; a null in either
  drops it. This is the one place that decides on infinite prices: they are
  no prices, in the clean table and in the reports alike;
* NaN or infinity in discount or rating counts as missing.

The mean is a scalar subquery (one row, one column) that Spark evaluates
once and substitutes as a value. It is a second pass over ``raw``: give
``clean_orders`` a stored table (``batch.stage_raw``), not the join that makes it,
or the mean that ``batch.stage_profiled`` observes while it stores the rows.
The validity filter is written on the raw price and quantity columns, so
the ``> 0`` comparisons reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderscope.functions.money import revenue_double
from orderscope.schemas import CLEAN_ORDERS, RAW_ORDERS


def conform(raw: DataFrame) -> DataFrame:
    """Cast to the raw order schema and turn NaN into null in double columns.

    Price is left as read: the validity filter rejects NaN prices itself, and
    leaving the column untouched keeps its predicate pushable to the scan.
    """
    return raw.select(*_conform_columns())


@cache
def _conform_columns() -> tuple[Column, ...]:
    """Built once per process: a Column is an immutable expression tree."""
    cols = []
    for field in RAW_ORDERS.fields:
        c = F.col(field.name).cast(field.dataType)
        if field.name in ("descuento_pct", "calificacion"):
            c = F.when(F.abs(c) < F.lit(float("inf")), c)      # NaN is larger than infinity
        cols.append(c.alias(field.name))
    return tuple(cols)


def is_valid() -> Column:
    """0 < price < infinity and quantity > 0 (null and NaN are not valid)."""
    price = F.col("precio_unitario")
    return (price > 0) & (price < F.lit(float("inf"))) & (F.col("cantidad") > 0)


def rating_mean(raw: DataFrame) -> DataFrame:
    """One row: the mean of the non-null ratings over all raw rows."""
    return conform(raw).agg(F.avg("calificacion").alias("calificacion_media"))


def derived_columns(df: DataFrame) -> DataFrame:
    """Add revenue, discount flag, date parts and route in one projection."""
    return df.withColumns({
        "total_venta": revenue_double(F.col("precio_unitario"), F.col("cantidad"), F.col("descuento_pct")),
        "tiene_descuento": F.when(F.col("descuento_pct") > 0, F.lit(1)).otherwise(F.lit(0)),
        "anio": F.year("fecha"),
        "mes": F.month("fecha"),
        "hora": F.hour("fecha"),
        "ruta": F.concat(F.col("ciudad"), F.lit(">"), F.col("departamento")),
    })


def clean_orders(raw: DataFrame, rating_fill: Column | None = None) -> DataFrame:
    """Raw orders → clean orders (schema ``CLEAN_ORDERS``).

    ``rating_fill`` overrides the fill value (a literal or a scalar
    subquery); by default it is the mean over ``raw``.
    """
    rows = conform(raw)
    fill = rating_fill if rating_fill is not None else rating_mean(rows).scalar()
    valid = rows.filter(is_valid())
    filled = valid.withColumns({
        "calificacion": F.coalesce(F.col("calificacion"), fill.cast("double")),
        "descuento_pct": F.coalesce(F.col("descuento_pct"), F.lit(0.0)),
    })
    out = derived_columns(filled)
    return out.select(*[F.col(f.name).cast(f.dataType) for f in CLEAN_ORDERS.fields])


def profile(raw: DataFrame) -> DataFrame:
    """Row counts before and after cleaning and null counts, in one pass."""
    return conform(raw).agg(*profile_columns())


@cache
def profile_columns() -> tuple[Column, ...]:
    """The aggregates of the profile, over conformed rows; also what a write can observe on its way."""
    return (
        F.count(F.lit(1)).alias("filas"),
        F.count_if(is_valid()).alias("filas_validas"),
        F.count_if(F.col("calificacion").isNull()).alias("nulos_calificacion"),
        F.count_if(F.col("descuento_pct").isNull()).alias("nulos_descuento"),
        F.avg("calificacion").alias("calificacion_media"),
    )


def schema_rows(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and number of nulls (one pass, one aggregate)."""
    fields = df.schema.fields
    counted = df.agg(*[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in fields])
    rows = [F.struct(F.lit(i).alias("posicion"), F.lit(f.name).alias("columna"), F.lit(f.dataType.simpleString()).alias("tipo"),
                     F.col(f.name).alias("nulos")) for i, f in enumerate(fields, 1)]
    return counted.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows in a total order of all columns (top-k, not a full sort)."""
    if n < 0:
        raise ValueError("n must be >= 0")
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in df.columns]).limit(n)
