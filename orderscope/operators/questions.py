"""Parameterised questions over the report tables, as DataFrame functions.

Each function takes report DataFrames (see ``operators.reports``) and
returns a small DataFrame: the figures asked for plus a ``linea`` / ``texto``
column with the answer formatted the way a reader sees it. Report tables
hold one row per group, so every window here runs over a handful of rows,
never over order rows.

Deviations from a single-machine original, decided once:

* ties are broken by the group key everywhere (a deterministic order);
* ``top_cities`` casts ``n`` to int, rejects n < 0 and returns all n; a
  caller's limit is an argument, and n above it is an error, not a cut;
* ``monthly_for_year``: 0 / None means all months, a year present in the
  data keeps that year, any other year gives no rows; the year filter sits
  above the month-over-month window, so January keeps its change against
  the previous December.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderscope.functions import fmt
from orderscope.functions.money import round_money, sum_money
from orderscope.operators import reports

# The metrics a ranking may use, in this order.
RANKING_METRICS = ["total_ordenes", "ingreso_total", "ticket_promedio", "calificacion_promedio"]

# The answer texts, as they read (labels are padded to align; {} takes a value).
LOOKUP_LABELS = ["  Ordenes:            ", "  Unidades vendidas:  ", "  Ingreso total:      ",
                 "  Ticket promedio:    ", "  Calificacion prom:  ", "  Con descuento:      "]
NOT_FOUND_TEXT = "Categoria no encontrada. Opciones: {}"
RANKING_HEADER = "Ranking por {}:"
RANKING_LINE = "  {}. {}: {}"
CITIES_HEADER = "Top {} ciudades por ingreso:"
CITIES_LINE = "  {}. {} ({}): {} | {} ordenes"
PAYMENTS_HEADER = "Metodos de pago:"
PAYMENTS_LINE = "  {}: {} ordenes | {}"
MONTHS_HEADER = "Evolucion mensual ({}):"
MONTHS_LINE = "  {} {}: {} ordenes | {} | var: {}"
STATUSES_HEADER = "Estados de envio:"
STATUSES_LINE = "  {}: {} ordenes | calif: {}/5"
SUMMARY_TITLE = "Resumen general:"
SUMMARY_LABELS = ["  Total ordenes:       ", "  Ingreso total:       ", "  Categoria top:       ",
                  "  Ciudad top:          ", "  Metodo de pago top:  "]
FIRST_MONTH = "base"
ALL_YEARS = "todos"
NOT_AVAILABLE = "N/A"
NO_DATA = "Datos no disponibles."


def _filled(text: str, *values: Column) -> Column:
    """A text with its {} places filled by columns."""
    parts = text.split("{}")
    out = [F.lit(parts[0])]
    for value, rest in zip(values, parts[1:], strict=True):
        out += [value, F.lit(rest)]
    return F.concat(*out)


def _text_block(first: Column, labels: list[str], values: list[Column]) -> Column:
    """``first``, then one ``label + value`` line per value (null if any part is null)."""
    parts = [first]
    for label, value in zip(labels, values, strict=True):
        parts += [F.lit("\n" + label), value]
    return F.concat(*parts)


def _plain(x: Column, integral: bool) -> Column:
    """A number printed the way ``str()`` prints it (ints plain, floats shortest)."""
    if integral:
        return x.cast("bigint").cast("string")
    return fmt.pattern_format(x, "0.0#")


def category_options(categories: DataFrame) -> DataFrame:
    """Valid category names, sorted (shown when a lookup finds nothing)."""
    return categories.select("categoria").distinct().orderBy("categoria")


def _lookup_text() -> Column:
    return _text_block(F.concat(F.col("categoria"), F.lit(":")), LOOKUP_LABELS, [
        fmt.thousands(F.col("total_ordenes")),
        fmt.thousands(F.col("total_unidades")),
        fmt.money0(F.col("ingreso_total")),
        fmt.money2(F.col("ticket_promedio")),
        F.concat(fmt.fixed(F.col("calificacion_promedio"), 2), F.lit("/5")),
        F.concat(fmt.fixed(F.col("pct_con_descuento"), 1), F.lit("%")),
    ])


# The collation in which category names are compared: equal ignoring case, in every script.
NAME_COLLATION = "UTF8_LCASE"


def same_name(column: Column, name: str) -> Column:
    """Equality ignoring case, by the column's collation; the column itself is not rewritten."""
    return F.collate(column, NAME_COLLATION) == F.lit(name)


def category_lookup(categories: DataFrame, categoria: str) -> DataFrame:
    """One category's figures; case-insensitive match, first hit in report order."""
    hit = categories.filter(same_name(F.col("categoria"), categoria)) \
        .orderBy(F.desc("ingreso_total"), F.asc("categoria")).limit(1)
    return hit.withColumn("texto", _lookup_text())


def category_answer(categories: DataFrame, categoria: str) -> DataFrame:
    """T1 as the reader sees it: one row ``texto`` with the figures, the valid options, or that there are no data."""
    hit = same_name(F.col("categoria"), categoria)
    found = F.min_by(F.when(hit, _lookup_text()), F.when(hit, F.struct(-F.col("ingreso_total"), F.col("categoria"))))
    names = F.transform(F.array_sort(F.collect_set("categoria")), lambda c: F.concat(F.lit("'"), c, F.lit("'")))
    options = _filled(NOT_FOUND_TEXT, F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]")))
    return categories.agg(F.when(F.count(F.lit(1)) == 0, F.lit(NO_DATA)).otherwise(F.coalesce(found, options)).alias("texto"))


def answer(header: Column, lines: DataFrame, order: list[str]) -> DataFrame:
    """One row ``texto``: a header and a report's lines in order, each ended by a line break.

    Reports hold one row per group, so one value holds them; without rows the
    text says that there are no data.
    """
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "linea"))), lambda x: x["linea"]), "\n")
    return lines.agg(F.when(F.count(F.lit(1)) == 0, F.lit(NO_DATA)).otherwise(
        F.concat(header, F.lit("\n"), body, F.lit("\n"))).alias("texto"))


def _numbered(lines: DataFrame, *order: Column) -> DataFrame:
    return lines.withColumn("posicion", F.row_number().over(Window.orderBy(*order)))


def answers(tables: dict[str, DataFrame], metrica: str, n: int, anio: int | None) -> DataFrame:
    """T2-T6 with their headers: rows ``pregunta, texto``."""
    year = int(anio) if anio else 0
    asked = {
        "ranking": answer(_filled(RANKING_HEADER, F.lit(metrica)), category_ranking(tables["categorias"], metrica), ["posicion"]),
        "ciudades": answer(_filled(CITIES_HEADER, F.lit(str(top_k(n)))), top_cities(tables["ciudades"], n), ["posicion"]),
        "pagos": answer(F.lit(PAYMENTS_HEADER), _numbered(payment_lines(tables["pagos"]), F.desc("total_ordenes"),
                                                          F.asc("metodo_pago")), ["posicion"]),
        "meses": answer(_filled(MONTHS_HEADER, F.lit(str(year) if year else ALL_YEARS)),
                        monthly_for_year(tables["mensual"], year), ["anio", "mes"]),
        "estados": answer(F.lit(STATUSES_HEADER), _numbered(status_lines(tables["estados"]), F.desc("total_ordenes"),
                                                            F.asc("estado_envio")), ["posicion"]),
    }
    out: DataFrame | None = None
    for name, rows in asked.items():
        row = rows.select(F.lit(name).alias("pregunta"), "texto")
        out = row if out is None else out.unionByName(row)
    return out


def category_ranking(categories: DataFrame, metrica: str) -> DataFrame:
    """Every category ranked 1..n by one whitelisted metric, descending."""
    if metrica not in RANKING_METRICS:
        raise ValueError(f"metrica invalida {metrica!r}; usa una de {RANKING_METRICS}")
    w = Window.orderBy(F.desc(metrica), F.asc("categoria"))
    integral = metrica == "total_ordenes"
    ranked = categories.select(
        F.row_number().over(w).alias("posicion"),
        F.col("categoria"),
        F.lit(metrica).alias("metrica"),
        F.col(metrica).cast("double").alias("valor"),
        _plain(F.col(metrica), integral).alias("valor_texto"),
    )
    linea = _filled(RANKING_LINE, F.col("posicion").cast("string"), F.col("categoria"), F.col("valor_texto"))
    return ranked.withColumn("linea", linea).orderBy("posicion")


def top_k(n: int | str | float, limit: int | None = None) -> int:
    """``n`` as a whole number; negative or above the caller's limit is an error."""
    k = int(n)
    if k < 0:
        raise ValueError("n must be >= 0")
    if limit is not None and k > limit:
        raise ValueError(f"n must be <= {limit}")
    return k


def top_cities(cities: DataFrame, n: int | str | float, limit: int | None = None) -> DataFrame:
    """The n cities with the highest revenue (top-k, no full sort)."""
    k = top_k(n, limit)
    order = [F.desc("ingreso_total"), F.asc("ciudad"), F.asc("departamento")]
    top = cities.orderBy(*order).limit(k)
    ranked = top.withColumn("posicion", F.row_number().over(Window.orderBy(*order)))
    linea = _filled(CITIES_LINE, F.col("posicion").cast("string"), F.col("ciudad"), F.col("departamento"),
                    fmt.money0(F.col("ingreso_total")), fmt.thousands(F.col("total_ordenes")))
    return ranked.select("posicion", "ciudad", "departamento", "ingreso_total", "total_ordenes",
                         linea.alias("linea")).orderBy("posicion")


def payment_lines(payments: DataFrame) -> DataFrame:
    """T4: every payment method with orders and revenue, in report order."""
    linea = _filled(PAYMENTS_LINE, F.col("metodo_pago"), fmt.thousands(F.col("total_ordenes")), fmt.money0(F.col("ingreso_total")))
    return payments.select("metodo_pago", "total_ordenes", "ingreso_total", linea.alias("linea")) \
        .orderBy(F.desc("total_ordenes"), F.asc("metodo_pago"))


def monthly_for_year(monthly: DataFrame, anio: int | None) -> DataFrame:
    """T5: monthly evolution of one year (0 / None = all years)."""
    year = int(anio) if anio else 0
    rows = monthly if year == 0 else monthly.filter(F.col("anio") == F.lit(year))
    var = F.coalesce(fmt.signed_pct(F.col("variacion_pct")), F.lit(FIRST_MONTH))
    linea = _filled(MONTHS_LINE, F.col("anio").cast("string"), fmt.month_name(F.col("mes")),
                    fmt.thousands(F.col("total_ordenes")), fmt.money0(F.col("ingreso_total")), var)
    return rows.select(
        "anio", "mes", fmt.month_name(F.col("mes")).alias("mes_nombre"), "total_ordenes", "ingreso_total",
        "variacion_pct", var.alias("variacion_texto"), linea.alias("linea"),
    ).orderBy("anio", "mes")


def status_lines(statuses: DataFrame) -> DataFrame:
    """Every delivery status with orders and mean rating."""
    linea = _filled(STATUSES_LINE, F.col("estado_envio"), fmt.thousands(F.col("total_ordenes")),
                    fmt.fixed(F.col("calificacion_promedio"), 2))
    return statuses.select("estado_envio", "total_ordenes", "calificacion_promedio", linea.alias("linea")) \
        .orderBy(F.desc("total_ordenes"), F.asc("estado_envio"))


def executive_summary(categories: DataFrame, cities: DataFrame, payments: DataFrame) -> DataFrame:
    """One row with totals and the top category, city and payment method.

    The three report tables are stacked into one (kind, key, revenue,
    orders) table and reduced by a single global aggregate with conditional
    arg-maxes, so the result is one row even on empty input; ``N/A`` marks a
    part whose report is empty.
    """
    stacked = categories.select(F.lit("cat").alias("_kind"), F.col("categoria").alias("_key"),
                                "ingreso_total", "total_ordenes") \
        .unionByName(cities.select(F.lit("city").alias("_kind"), F.col("ciudad").alias("_key"),
                                   "ingreso_total", "total_ordenes")) \
        .unionByName(payments.select(F.lit("pay").alias("_kind"), F.col("metodo_pago").alias("_key"),
                                     "ingreso_total", "total_ordenes"))
    is_cat, is_city, is_pay = (F.col("_kind") == F.lit(k) for k in ("cat", "city", "pay"))

    def top(cond: Column, value: Column) -> Column:
        order = F.when(cond, F.struct(value.alias("v"), F.col("_key").alias("k")))
        return F.coalesce(F.min_by(F.when(cond, F.col("_key")), order), F.lit(NOT_AVAILABLE))

    row = stacked.agg(
        F.sum(F.when(is_cat, F.col("total_ordenes"))).cast("bigint").alias("total_ordenes"),
        sum_money(F.when(is_cat, F.col("ingreso_total"))).alias("ingreso_total"),
        top(is_cat, -F.col("ingreso_total")).alias("categoria_top"),
        top(is_city, -F.col("ingreso_total")).alias("ciudad_top"),
        top(is_pay, -F.col("total_ordenes")).alias("metodo_pago_top"),
    )
    return row.withColumn("texto", _summary_text())


def _summary_text() -> Column:
    return _text_block(F.lit(SUMMARY_TITLE), SUMMARY_LABELS, [
        fmt.thousands(F.col("total_ordenes")),
        fmt.money0(F.col("ingreso_total")),
        F.col("categoria_top"),
        F.col("ciudad_top"),
        F.col("metodo_pago_top"),
    ])


def executive_summary_of_orders(orders: DataFrame,
                                min_city_orders: int = reports.DEFAULT_MIN_CITY_ORDERS) -> DataFrame:
    """T7 straight from order rows, in one scan and one plan branch.

    Grouping sets give the category, city and payment groups from a single
    aggregate; one global aggregate over those group rows then takes the
    totals and the three arg-maxes with conditional ``min_by`` (rows of the
    other sets have a null ordering and are skipped). Same result as
    ``executive_summary`` over the three report tables, which would need
    three scans (their branches prune columns differently, so Spark cannot
    share one aggregate among them).
    """
    names = ["categorias", "ciudades", "pagos"]
    keys = ["_gid", *dict.fromkeys(k for name in names for k in reports.KEYS[name])]
    groups = reports.folded(reports.grouped_measures(orders, names), keys).filter(F.col("_n_valid") > 0)
    rows = groups.withColumn("_rev", F.coalesce(round_money(F.col("_revenue.exact")), F.col("_revenue.nearest")))
    is_cat = F.col("_gid") == F.lit(reports.set_id("categorias", names))
    is_city = (F.col("_gid") == F.lit(reports.set_id("ciudades", names))) & (F.col("_n_ids") > F.lit(min_city_orders))
    is_pay = F.col("_gid") == F.lit(reports.set_id("pagos", names))
    neg_rev = -F.col("_rev")

    def top(cond: Column, key: str, value: Column) -> Column:
        return F.coalesce(F.min_by(F.when(cond, F.col(key)),
                                   F.when(cond, F.struct(value.alias("v"), F.col(key).alias("k")))), F.lit(NOT_AVAILABLE))

    row = rows.agg(
        F.sum(F.when(is_cat, F.col("_n_ids"))).cast("bigint").alias("total_ordenes"),
        sum_money(F.when(is_cat, F.col("_rev"))).alias("ingreso_total"),
        top(is_cat, "categoria", neg_rev).alias("categoria_top"),
        top(is_city, "ciudad", neg_rev).alias("ciudad_top"),
        top(is_pay, "metodo_pago", -F.col("_n_ids")).alias("metodo_pago_top"),
    )
    return row.withColumn("texto", _summary_text())


def top_keys(orders: DataFrame, keys: list[str]) -> DataFrame:
    """A15 over keys of any number of values (products, customers): rows ``clave, valor, ingreso_total, total_ordenes, claves``.

    For each key column the value with the highest revenue (in cents; ties go to
    the smallest value) and the number of values. One scan: grouping sets sum by
    value, and two aggregates take the maximum by a composite order, first within
    each task. Rows of values are never sorted, ranked or brought together.
    """
    by_value = reports.value_sums(orders, keys)
    amount = F.coalesce(round_money(F.col("_revenue.exact")), F.col("_revenue.nearest"))
    rows = by_value.select(*keys, "_gid", "_n_ids", amount.alias("_amount"))
    tops = []
    for i, key in enumerate(keys):
        mine = F.col("_gid") == (1 << len(keys)) - 1 - (1 << (len(keys) - 1 - i))
        row = F.struct(F.lit(key).alias("clave"), F.col(key).cast("string").alias("valor"), F.col("_amount").alias("ingreso_total"),
                       F.col("_n_ids").alias("total_ordenes"))
        order = F.struct((-F.col("_amount")).alias("amount"), F.col(key).alias("value"))
        tops.append(F.struct(F.min_by(F.when(mine, row), F.when(mine, order)).alias("top"), F.count_if(mine & F.col(key).isNotNull()).alias("claves")))
    listed = rows.agg(F.array(*tops).alias("tops")).select(F.inline("tops"))
    return listed.filter(F.col("top").isNotNull()).select("top.*", "claves")
