"""Chart-ready tables over the report tables (the data behind a dashboard).

Drawing is not done here; each function returns exactly the rows and
columns a chart or a formatted table shows. Inputs are report tables (one
row per group), so the global windows and one-row aggregates below move a
bounded number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderscope.functions import fmt
from orderscope.functions.money import sum_money


def _mean_of_rounded(col: str) -> F.Column:
    """Unweighted mean of a 2-decimal report column, summed exactly."""
    total = sum_money(F.col(col))
    return F.round(F.try_divide(total, F.count(F.col(col)).cast("double")), 2)


def kpis(categories: DataFrame) -> DataFrame:
    """V1: four headline figures in one row.

    ``ticket_promedio`` and ``calificacion_promedio`` are the unweighted means
    of the category rows, as the dashboard shows them; ``ticket_ponderado``
    is revenue / orders for comparison.
    """
    row = categories.agg(
        F.sum("total_ordenes").cast("bigint").alias("total_ordenes"),
        sum_money(F.col("ingreso_total")).alias("ingreso_total"),
        _mean_of_rounded("ticket_promedio").alias("ticket_promedio"),
        _mean_of_rounded("calificacion_promedio").alias("calificacion_promedio"),
    )
    return row.withColumns({
        "ticket_ponderado": F.round(F.try_divide(F.col("ingreso_total"), F.col("total_ordenes").cast("double")), 2),
        "ordenes_fmt": fmt.thousands(F.col("total_ordenes")),
        "ingreso_fmt": fmt.money0(F.col("ingreso_total")),
        "ticket_fmt": fmt.money2(F.col("ticket_promedio")),
        "calificacion_fmt": F.concat(fmt.fixed(F.col("calificacion_promedio"), 2), F.lit(" / 5")),
    })


def category_bars(categories: DataFrame) -> DataFrame:
    """V2: revenue per category, ascending (bar order) with its position."""
    w = Window.orderBy(F.asc("ingreso_total"), F.asc("categoria"))
    return categories.select(
        F.row_number().over(w).alias("orden"), "categoria", "ingreso_total",
    ).orderBy("orden")


def payment_share(payments: DataFrame) -> DataFrame:
    """V3: share of each payment method in the orders of the report (pie).

    The total is a window sum over the report rows (one per payment method).
    """
    total = F.sum("total_ordenes").over(Window.partitionBy())
    share = F.round(F.try_divide(F.col("total_ordenes").cast("double"), total.cast("double")) * 100, 2)
    return payments.select(
        "metodo_pago", "total_ordenes", share.alias("pct_ordenes"),
    ).orderBy(F.desc("total_ordenes"), F.asc("metodo_pago"))


def month_period(monthly: DataFrame) -> DataFrame:
    """V4: orders per ``YYYY-MM`` period (line chart)."""
    return monthly.select(
        "anio", "mes", fmt.period(F.col("anio"), F.col("mes")).alias("periodo"), "total_ordenes",
    ).orderBy("anio", "mes")


# Display names of the city and status tables.
CITY_COLUMNS = ["Ciudad", "Departamento", "Órdenes", "Ingreso ($)", "Ticket prom ($)", "Calificación"]
STATUS_COLUMNS = {"estado_envio": "Estado", "total_ordenes": "Órdenes",
                  "ingreso_total": "Ingreso ($)", "calificacion_promedio": "Calificación"}


def city_table(cities: DataFrame) -> DataFrame:
    """V5: the city report with display names and display formats."""
    return cities.select(
        F.col("ciudad"), F.col("departamento"),
        fmt.thousands(F.col("total_ordenes")),
        fmt.money0(F.col("ingreso_total")),
        fmt.money2(F.col("ticket_promedio")),
        fmt.fixed(F.col("calificacion_promedio"), 2),
    ).toDF(*CITY_COLUMNS)


def status_table(statuses: DataFrame) -> DataFrame:
    """V6: the status report with display names and formats (also feeds the status bars)."""
    formatted = statuses.select(
        F.col("estado_envio"),
        fmt.thousands(F.col("total_ordenes")).alias("total_ordenes"),
        fmt.money0(F.col("ingreso_total")).alias("ingreso_total"),
        fmt.fixed(F.col("calificacion_promedio"), 2).alias("calificacion_promedio"),
    )
    return formatted.withColumnsRenamed(STATUS_COLUMNS)
