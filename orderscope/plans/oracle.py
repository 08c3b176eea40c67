"""Independent SQL statements of every registered query (DuckDB dialect).

These are the correctness oracle: each statement recomputes a query of
``__spark_entry__.queries()`` straight from the driver tables with plain
SQL, written the direct way (fill, then filter, then ``avg``), so it also
checks the one-pass rewrites of the Spark side. Column names equal the
Spark aliases.
"""

from __future__ import annotations

# Fixed values, written out here so that the oracle shares nothing with the code under test.
MONTH_NAMES = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]
NO_DATA = "Datos no disponibles."

VENTAS = """
ventas AS (
  SELECT l.l_orderkey AS orden_id,
         CAST(o.o_orderdate AS TIMESTAMP) AS fecha,
         o.o_custkey AS cliente_id,
         p.p_type AS categoria,
         p.p_name AS producto,
         CAST(trunc(l.l_quantity) AS INTEGER) AS cantidad,
         p.p_retailprice AS precio_unitario,
         CASE WHEN l.l_partkey % 250 = 0 THEN NULL ELSE round(l.l_discount * 100) END AS descuento_pct,
         o.o_orderpriority AS metodo_pago,
         n.n_name AS ciudad,
         r.r_name AS departamento,
         o.o_orderstatus AS estado_envio,
         CASE WHEN l.l_orderkey % 125 = 0 THEN NULL ELSE CAST(1 + l.l_linenumber % 5 AS DOUBLE) END AS calificacion
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

CLEAN = """
clean AS (
  SELECT orden_id, fecha, cliente_id, categoria, producto, cantidad, precio_unitario,
         coalesce(descuento_pct, 0.0) AS descuento_pct,
         metodo_pago, ciudad, departamento, estado_envio,
         coalesce(calificacion, (SELECT avg(calificacion) FROM ventas)) AS calificacion,
         precio_unitario * cantidad * (1 - coalesce(descuento_pct, 0.0) / 100) AS total_venta,
         CASE WHEN coalesce(descuento_pct, 0.0) > 0 THEN 1 ELSE 0 END AS tiene_descuento,
         CAST(year(fecha) AS INTEGER) AS anio,
         CAST(month(fecha) AS INTEGER) AS mes,
         CAST(hour(fecha) AS INTEGER) AS hora,
         ciudad || '>' || departamento AS ruta,
         CAST(CAST(precio_unitario AS DECIMAL(24,9)) * CAST(cantidad AS DECIMAL(10,0)) AS DECIMAL(24,9))
           * CAST(1 - CAST(coalesce(descuento_pct, 0.0) AS DECIMAL(11,6)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(13,8))
           AS venta_exacta
  FROM ventas
  WHERE precio_unitario > 0 AND isfinite(precio_unitario) AND cantidad > 0
)"""

CLEAN_COLUMNS = ("orden_id, fecha, cliente_id, categoria, producto, cantidad, precio_unitario, descuento_pct, "
                 "metodo_pago, ciudad, departamento, estado_envio, calificacion, total_venta, tiene_descuento, "
                 "anio, mes, hora, ruta")


def with_clean(body: str, extra: str = "") -> str:
    ctes = [VENTAS, CLEAN] + ([extra] if extra else [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


R_CATEGORY = """
report_category AS (
  SELECT categoria,
         CAST(count(orden_id) AS BIGINT) AS total_ordenes,
         CAST(sum(cantidad) AS BIGINT) AS total_unidades,
         CAST(round(sum(venta_exacta), 2) AS DOUBLE) AS ingreso_total,
         round(CAST(CAST(sum(venta_exacta) AS DECIMAL(38,6)) AS DOUBLE) / count(*), 2) AS ticket_promedio,
         round(avg(calificacion), 2) AS calificacion_promedio,
         round(CAST(sum(tiene_descuento) AS DOUBLE) / count(*) * 100, 2) AS pct_con_descuento
  FROM clean GROUP BY categoria
)"""

# Prices of 10^16 and ratings of 10^12: doubles that are whole numbers, summed as such.
R_HUGE = """
huge AS (
  SELECT categoria, cantidad, orden_id, coalesce(descuento_pct, 0.0) AS descuento, orden_id % 40 = 0 AS caro,
         CASE WHEN orden_id % 40 = 0 THEN precio_unitario * 1e14 ELSE precio_unitario END AS precio,
         CASE WHEN orden_id % 60 = 0 THEN calificacion * 1e12 ELSE calificacion END AS calificacion
  FROM ventas
),
huge_fill AS (
  SELECT CAST(sum(CAST(calificacion AS HUGEINT)) AS DOUBLE) / count(calificacion) AS fill FROM huge
),
huge_sums AS (
  SELECT categoria, count(orden_id) AS n, sum(cantidad) AS unidades, count(*) FILTER (WHERE descuento > 0) AS con_descuento,
         CAST(CAST(CAST(coalesce(sum(CAST(precio * cantidad * (1 - descuento / 100) AS HUGEINT)) FILTER (WHERE caro), 0) AS DECIMAL(38,6))
           + coalesce(sum(CAST(CAST(TRY_CAST(precio AS DECIMAL(24,9)) * CAST(cantidad AS DECIMAL(10,0)) AS DECIMAL(24,9))
               * CAST(1 - CAST(descuento AS DECIMAL(11,6)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(13,8)) AS DECIMAL(38,6)))
             FILTER (WHERE NOT caro), 0) AS VARCHAR) AS DOUBLE) AS ingreso,
         CAST(coalesce(sum(CAST(calificacion AS HUGEINT)), 0) AS DOUBLE) AS conocidas, count(*) - count(calificacion) AS faltan
  FROM huge WHERE precio > 0 AND isfinite(precio) AND cantidad > 0 GROUP BY categoria
),
report_huge AS (
  SELECT categoria, CAST(n AS BIGINT) AS total_ordenes, CAST(unidades AS BIGINT) AS total_unidades,
         CASE WHEN ingreso < 1e15 THEN round(ingreso, 2) ELSE ingreso END AS ingreso_total,      -- no decimals are left beyond
         CASE WHEN ingreso / n < 1e15 THEN round(ingreso / n, 2) ELSE ingreso / n END AS ticket_promedio, round((conocidas + faltan * fill) / n, 2) AS calificacion_promedio,
         round(CAST(con_descuento AS DOUBLE) / n * 100, 2) AS pct_con_descuento
  FROM huge_sums, huge_fill
)"""

R_CITY = """
report_city AS (
  SELECT ciudad, departamento,
         CAST(count(orden_id) AS BIGINT) AS total_ordenes,
         CAST(round(sum(venta_exacta), 2) AS DOUBLE) AS ingreso_total,
         round(CAST(CAST(sum(venta_exacta) AS DECIMAL(38,6)) AS DOUBLE) / count(*), 2) AS ticket_promedio,
         round(avg(calificacion), 2) AS calificacion_promedio
  FROM clean GROUP BY ciudad, departamento
  HAVING count(orden_id) > {min_orders}
)"""

MEAN_CITY_ORDERS = "(SELECT avg(n) FROM (SELECT count(orden_id) AS n FROM clean GROUP BY ciudad, departamento))"

R_PAYMENT = """
report_payment AS (
  SELECT metodo_pago,
         CAST(count(orden_id) AS BIGINT) AS total_ordenes,
         CAST(round(sum(venta_exacta), 2) AS DOUBLE) AS ingreso_total,
         round(count(orden_id) / (SELECT count(*) FROM clean) * 100, 2) AS pct_of_total_ordenes
  FROM clean GROUP BY metodo_pago
)"""

R_MONTHLY = """
month_rows AS (
  SELECT anio, mes,
         CAST(count(orden_id) AS BIGINT) AS total_ordenes,
         CAST(round(sum(venta_exacta), 2) AS DOUBLE) AS ingreso_total,
         round(avg(calificacion), 2) AS calificacion_promedio
  FROM clean GROUP BY anio, mes
),
report_monthly AS (
  SELECT anio, mes, total_ordenes, ingreso_total, calificacion_promedio,
         round((ingreso_total - lag(ingreso_total) OVER (ORDER BY anio, mes))
               / nullif(lag(ingreso_total) OVER (ORDER BY anio, mes), 0) * 100, 2) AS variacion_pct
  FROM month_rows
)"""

R_STATUS = """
report_status AS (
  SELECT estado_envio,
         CAST(count(orden_id) AS BIGINT) AS total_ordenes,
         CAST(round(sum(venta_exacta), 2) AS DOUBLE) AS ingreso_total,
         round(avg(calificacion), 2) AS calificacion_promedio
  FROM clean GROUP BY estado_envio
)"""


def thousands(x: str) -> str:
    return f"format('{{:,.0f}}', CAST({x} AS DOUBLE))"


def money0(x: str) -> str:
    return f"'$' || {thousands(x)}"


def money2(x: str) -> str:
    return f"'$' || format('{{:,.2f}}', CAST({x} AS DOUBLE))"


def fixed(x: str, decimals: int) -> str:
    return f"format('{{:.{decimals}f}}', CAST({x} AS DOUBLE))"


def month_name(m: str) -> str:
    names = ", ".join(f"'{n}'" for n in MONTH_NAMES)
    return f"([{names}])[{m}]"


def signed_pct(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 0 THEN '-' || printf('%.1f', abs({x})) || '%' "
            f"ELSE '+' || printf('%.1f', abs({x})) || '%' END")


NL = "chr(10)"


def report_ctes(*names: str, min_city_orders: int = 500) -> str:
    parts = {"category": R_CATEGORY, "city": R_CITY.format(min_orders=min_city_orders),
             "payment": R_PAYMENT, "monthly": R_MONTHLY, "status": R_STATUS}
    return ",\n".join(parts[n] for n in names)


def plain_number(x: str, integral: bool) -> str:
    return f"CAST(CAST({x} AS BIGINT) AS VARCHAR)" if integral else f"CAST(CAST({x} AS DOUBLE) AS VARCHAR)"


Q_CATEGORY_LOOKUP = """
SELECT categoria, total_ordenes, total_unidades, ingreso_total, ticket_promedio, calificacion_promedio,
       pct_con_descuento,
       categoria || ':' || {nl}
       || '  Ordenes:            ' || {ord} || {nl}
       || '  Unidades vendidas:  ' || {uni} || {nl}
       || '  Ingreso total:      ' || {ing} || {nl}
       || '  Ticket promedio:    ' || {tic} || {nl}
       || '  Calificacion prom:  ' || {cal} || '/5' || {nl}
       || '  Con descuento:      ' || {des} || '%' AS texto
FROM report_category
WHERE lower(categoria) = lower('{param}')
ORDER BY ingreso_total DESC, categoria
LIMIT 1"""


def category_lookup_sql(param: str) -> str:
    body = Q_CATEGORY_LOOKUP.format(
        nl=NL, ord=thousands("total_ordenes"), uni=thousands("total_unidades"), ing=money0("ingreso_total"),
        tic=money2("ticket_promedio"), cal=fixed("calificacion_promedio", 2), des=fixed("pct_con_descuento", 1),
        param=param.replace("'", "''"))
    return with_clean(body, report_ctes("category"))


def category_ranking_body(metric: str) -> str:
    integral = metric == "total_ordenes"
    return f"""
SELECT posicion, categoria, metrica, valor, valor_texto,
       '  ' || CAST(posicion AS VARCHAR) || '. ' || categoria || ': ' || valor_texto AS linea
FROM (
  SELECT CAST(row_number() OVER (ORDER BY {metric} DESC, categoria) AS INTEGER) AS posicion,
         categoria, '{metric}' AS metrica, CAST({metric} AS DOUBLE) AS valor,
         {plain_number(metric, integral)} AS valor_texto
  FROM report_category
)"""


def category_ranking_sql(metric: str) -> str:
    return with_clean(category_ranking_body(metric), report_ctes("category"))


def top_cities_body(k: int) -> str:
    return f"""
SELECT posicion, ciudad, departamento, ingreso_total, total_ordenes,
       '  ' || CAST(posicion AS VARCHAR) || '. ' || ciudad || ' (' || departamento || '): '
       || {money0('ingreso_total')} || ' | ' || {thousands('total_ordenes')} || ' ordenes' AS linea
FROM (
  SELECT CAST(row_number() OVER (ORDER BY ingreso_total DESC, ciudad, departamento) AS INTEGER) AS posicion, *
  FROM report_city
)
WHERE posicion <= {k}"""


def top_cities_sql(k: int) -> str:
    return with_clean(top_cities_body(k), report_ctes("city"))


def payment_lines_body() -> str:
    return f"""
SELECT metodo_pago, total_ordenes, ingreso_total,
       '  ' || metodo_pago || ': ' || {thousands('total_ordenes')} || ' ordenes | ' || {money0('ingreso_total')} AS linea
FROM report_payment"""


def payment_lines_sql() -> str:
    return with_clean(payment_lines_body(), report_ctes("payment"))


def monthly_for_year_body(year: int) -> str:
    where = f"WHERE anio = {int(year)}" if year else ""
    var = f"coalesce({signed_pct('variacion_pct')}, 'base')"
    return f"""
SELECT anio, mes, {month_name('mes')} AS mes_nombre, total_ordenes, ingreso_total, variacion_pct,
       {var} AS variacion_texto,
       '  ' || CAST(anio AS VARCHAR) || ' ' || {month_name('mes')} || ': ' || {thousands('total_ordenes')}
       || ' ordenes | ' || {money0('ingreso_total')} || ' | var: ' || {var} AS linea
FROM report_monthly
{where}"""


def monthly_for_year_sql(year: int) -> str:
    return with_clean(monthly_for_year_body(year), report_ctes("monthly"))


def status_lines_body() -> str:
    return f"""
SELECT estado_envio, total_ordenes, calificacion_promedio,
       '  ' || estado_envio || ': ' || {thousands('total_ordenes')} || ' ordenes | calif: '
       || {fixed('calificacion_promedio', 2)} || '/5' AS linea
FROM report_status"""


def status_lines_sql() -> str:
    return with_clean(status_lines_body(), report_ctes("status"))


# The headers of the answers.
def answer_rows(metric: str, k: int, year: int) -> str:
    asked = [
        ("ranking", f"Ranking por {metric}:", category_ranking_body(metric), "posicion"),
        ("ciudades", f"Top {k} ciudades por ingreso:", top_cities_body(k), "posicion"),
        ("pagos", "Metodos de pago:", payment_lines_body(), "total_ordenes DESC, metodo_pago"),
        ("meses", f"Evolucion mensual ({year or 'todos'}):", monthly_for_year_body(year), "anio, mes"),
        ("estados", "Estados de envio:", status_lines_body(), "total_ordenes DESC, estado_envio"),
    ]
    return "\nUNION ALL\n".join(f"""SELECT '{name}' AS pregunta, CASE WHEN count(*) = 0 THEN '{NO_DATA}'
  ELSE '{header}' || {NL} || string_agg(linea, {NL} ORDER BY {order}) || {NL} END AS texto
FROM ({body})""" for name, header, body, order in asked)


ALL_REPORTS = ("category", "city", "payment", "monthly", "status")


def answer_texts_sql(metric: str, k: int, year: int) -> str:
    return with_clean(answer_rows(metric, k, year), report_ctes(*ALL_REPORTS))


def category_not_found_sql(name: str) -> str:
    """The name is in no test table, so the options are the answer."""
    body = f"""
SELECT CASE WHEN count(*) = 0 THEN '{NO_DATA}' WHEN bool_or(lower(categoria) = lower('{name}')) THEN NULL
  ELSE 'Categoria no encontrada. Opciones: [' || string_agg(chr(39) || categoria || chr(39), ', ' ORDER BY categoria) || ']' END AS texto
FROM report_category"""
    return with_clean(body, report_ctes("category"))


def empty_input_sql(metric: str, k: int) -> str:
    none = with_clean(f"SELECT 'categoria' AS pregunta, CASE WHEN count(*) = 0 THEN '{NO_DATA}' END AS texto FROM report_category"
                      + "\nUNION ALL\n" + answer_rows(metric, k, 0), report_ctes(*ALL_REPORTS))
    return none.replace("  FROM ventas\n  WHERE", "  FROM (SELECT * FROM ventas WHERE cantidad < 0)\n  WHERE")


# The raw order columns and their types.
RAW_COLUMNS = [
    ("orden_id", "bigint"), ("fecha", "timestamp_ntz"), ("cliente_id", "bigint"), ("categoria", "string"),
    ("producto", "string"), ("cantidad", "int"), ("precio_unitario", "double"), ("descuento_pct", "double"),
    ("metodo_pago", "string"), ("ciudad", "string"), ("departamento", "string"), ("estado_envio", "string"),
    ("calificacion", "double"),
]


def schema_rows_sql() -> str:
    rows = [f"SELECT CAST({i} AS INTEGER) AS posicion, '{name}' AS columna, '{kind}' AS tipo, "
            f"CAST(count(*) FILTER (WHERE {name} IS NULL) AS BIGINT) AS nulos FROM ventas"
            for i, (name, kind) in enumerate(RAW_COLUMNS, 1)]
    return "WITH " + VENTAS + "\n" + "\nUNION ALL ".join(rows)


def executive_summary_sql() -> str:
    body = f"""
SELECT *,
       'Resumen general:' || {NL}
       || '  Total ordenes:       ' || {thousands('total_ordenes')} || {NL}
       || '  Ingreso total:       ' || {money0('ingreso_total')} || {NL}
       || '  Categoria top:       ' || categoria_top || {NL}
       || '  Ciudad top:          ' || ciudad_top || {NL}
       || '  Metodo de pago top:  ' || metodo_pago_top AS texto
FROM (
  SELECT (SELECT CAST(sum(total_ordenes) AS BIGINT) FROM report_category) AS total_ordenes,
         (SELECT CAST(round(sum(CAST(ingreso_total AS DECIMAL(20,2))), 2) AS DOUBLE) FROM report_category) AS ingreso_total,
         coalesce((SELECT categoria FROM report_category ORDER BY ingreso_total DESC, categoria LIMIT 1), 'N/A') AS categoria_top,
         coalesce((SELECT ciudad FROM report_city ORDER BY ingreso_total DESC, ciudad LIMIT 1), 'N/A') AS ciudad_top,
         coalesce((SELECT metodo_pago FROM report_payment ORDER BY total_ordenes DESC, metodo_pago LIMIT 1), 'N/A')
           AS metodo_pago_top
)"""
    return with_clean(body, report_ctes("category", "city", "payment"))


def kpis_sql() -> str:
    body = f"""
SELECT *,
       round(ingreso_total / CAST(total_ordenes AS DOUBLE), 2) AS ticket_ponderado,
       {thousands('total_ordenes')} AS ordenes_fmt,
       {money0('ingreso_total')} AS ingreso_fmt,
       {money2('ticket_promedio')} AS ticket_fmt,
       {fixed('calificacion_promedio', 2)} || ' / 5' AS calificacion_fmt
FROM (
  SELECT CAST(sum(total_ordenes) AS BIGINT) AS total_ordenes,
         CAST(round(sum(CAST(ingreso_total AS DECIMAL(20,2))), 2) AS DOUBLE) AS ingreso_total,
         round(CAST(sum(CAST(ticket_promedio AS DECIMAL(20,2))) AS DOUBLE) / count(ticket_promedio), 2) AS ticket_promedio,
         round(CAST(sum(CAST(calificacion_promedio AS DECIMAL(20,2))) AS DOUBLE) / count(calificacion_promedio), 2)
           AS calificacion_promedio
  FROM report_category
)"""
    return with_clean(body, report_ctes("category"))


def category_bars_sql() -> str:
    body = """
SELECT CAST(row_number() OVER (ORDER BY ingreso_total, categoria) AS INTEGER) AS orden, categoria, ingreso_total
FROM report_category"""
    return with_clean(body, report_ctes("category"))


def payment_share_sql() -> str:
    body = """
SELECT metodo_pago, total_ordenes,
       round(CAST(total_ordenes AS DOUBLE) / CAST((SELECT sum(total_ordenes) FROM report_payment) AS DOUBLE) * 100, 2)
         AS pct_ordenes
FROM report_payment"""
    return with_clean(body, report_ctes("payment"))


def month_period_sql() -> str:
    body = """
SELECT anio, mes, CAST(anio AS VARCHAR) || '-' || lpad(CAST(mes AS VARCHAR), 2, '0') AS periodo, total_ordenes
FROM report_monthly"""
    return with_clean(body, report_ctes("monthly"))


def city_table_sql() -> str:
    body = f"""
SELECT ciudad AS "Ciudad", departamento AS "Departamento", {thousands('total_ordenes')} AS "Órdenes",
       {money0('ingreso_total')} AS "Ingreso ($)", {money2('ticket_promedio')} AS "Ticket prom ($)",
       {fixed('calificacion_promedio', 2)} AS "Calificación"
FROM report_city"""
    return with_clean(body, report_ctes("city"))


def status_table_sql() -> str:
    body = f"""
SELECT estado_envio AS "Estado", {thousands('total_ordenes')} AS "Órdenes",
       {money0('ingreso_total')} AS "Ingreso ($)", {fixed('calificacion_promedio', 2)} AS "Calificación"
FROM report_status"""
    return with_clean(body, report_ctes("status"))


RELOAD_MEASURES = {
    "category": ("categorias", "categoria", {"total_unidades", "ingreso_total", "ticket_promedio", "calificacion_promedio",
                                             "pct_con_descuento"}),
    "city": ("ciudades", "ciudad || '|' || departamento", {"ingreso_total", "ticket_promedio", "calificacion_promedio"}),
    "payment": ("pagos", "metodo_pago", {"ingreso_total", "pct_of_total_ordenes"}),
    "monthly": ("mensual", "CAST(anio AS VARCHAR) || '|' || CAST(mes AS VARCHAR)",
                {"ingreso_total", "calificacion_promedio", "variacion_pct"}),
    "status": ("estados", "estado_envio", {"ingreso_total", "calificacion_promedio"}),
}


def reports_reload_sql() -> str:
    """Every stored column of the five reports; null for those that a report lacks."""
    doubles = ["ingreso_total", "ticket_promedio", "calificacion_promedio", "pct_con_descuento", "pct_of_total_ordenes",
               "variacion_pct"]
    parts = []
    for table, (name, key, has) in RELOAD_MEASURES.items():
        measures = ", ".join(f"CAST({m if m in has else 'NULL'} AS DOUBLE) AS {m}" for m in doubles)
        units = "total_unidades" if "total_unidades" in has else "NULL"
        parts.append(f"SELECT '{name}' AS reporte, {key} AS clave, CAST(total_ordenes AS BIGINT) AS total_ordenes, "
                     f"CAST({units} AS BIGINT) AS total_unidades, {measures} FROM report_{table}")
    return with_clean("\nUNION ALL ".join(parts), report_ctes(*ALL_REPORTS))


# --- transcripts -------------------------------------------------------------

TRANSCRIPT_TURNS_SQL = """
SELECT conv_id, turn, role, text FROM conversations
WHERE role IN ('user', 'assistant') AND text IS NOT NULL AND text <> ''"""


def _messages(system_message: str) -> str:
    quoted = system_message.replace("'", "''")
    return f"""
WITH listed AS (
  SELECT DISTINCT conv_id, 0 AS kind, CAST(NULL AS BIGINT) AS turn, 'system' AS role, '{quoted}' AS text FROM conversations
  UNION ALL
  SELECT conv_id, 1, CAST(turn AS BIGINT), role, text FROM conversations
  WHERE role IN ('user', 'assistant') AND text IS NOT NULL AND text <> ''
),
messages AS (
  SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY kind, turn, role, text) - 1 AS BIGINT) AS posicion, role, text
  FROM listed
)"""


def transcript_messages_sql(system_message: str) -> str:
    return _messages(system_message) + "\nSELECT conv_id, posicion, role, text FROM messages"


def transcript_text_sql(system_message: str, part: int) -> str:
    return _messages(system_message) + f"""
SELECT conv_id, CAST(posicion // {part} AS BIGINT) AS parte, CAST(count(*) AS BIGINT) AS n_mensajes,
       string_agg(role || ': ' || text, chr(10) ORDER BY posicion) AS transcript
FROM messages
GROUP BY conv_id, posicion // {part}"""


# The rules by which the reject queries spoil lines; a wrong number of fields hides the other reasons.
DIRTY = """
dirty AS (
  SELECT *, orden_id % 101 = 0 OR orden_id % 103 = 0 AS ancho, orden_id % 97 = 0 AS precio_malo,
         orden_id % 89 = 0 AS cantidad_mala, orden_id % 83 = 0 AS fecha_mala
  FROM ventas
),
marked AS (
  SELECT orden_id, CASE WHEN ancho THEN ['columnas'] ELSE list_filter([
           CASE WHEN fecha_mala THEN 'tipo:fecha' END, CASE WHEN cantidad_mala THEN 'tipo:cantidad' END,
           CASE WHEN precio_malo THEN 'tipo:precio_unitario' END], lambda x: x IS NOT NULL) END AS motivos
  FROM dirty
)"""


def csv_rejects_sql() -> str:
    return f"WITH {VENTAS},\n{DIRTY}\nSELECT orden_id, array_to_string(motivos, ',') AS motivos FROM marked WHERE len(motivos) > 0"


def csv_reject_counts_sql() -> str:
    return f"""WITH {VENTAS},
{DIRTY}
SELECT motivo, CAST(count(*) AS BIGINT) AS filas FROM (SELECT unnest(motivos) AS motivo FROM marked) GROUP BY motivo
UNION ALL SELECT 'rechazadas', CAST(count(*) FILTER (WHERE len(motivos) > 0) AS BIGINT) FROM marked
UNION ALL SELECT 'aceptadas', CAST(count(*) FILTER (WHERE len(motivos) = 0) AS BIGINT) FROM marked
UNION ALL SELECT 'total', CAST(count(*) AS BIGINT) FROM marked"""


def csv_accepted_sql() -> str:
    """The category report without the spoiled rows, and without the discounts that were emptied."""
    kept = VENTAS.replace("ventas AS (", "todas AS (") + """,
ventas AS (
  SELECT * REPLACE (CASE WHEN orden_id % 97 = 1 THEN NULL ELSE descuento_pct END AS descuento_pct) FROM todas
  WHERE orden_id % 101 <> 0 AND orden_id % 103 <> 0 AND orden_id % 97 <> 0 AND orden_id % 89 <> 0 AND orden_id % 83 <> 0
)"""
    return "WITH " + ",\n".join([kept, CLEAN, R_CATEGORY]) + "\nSELECT * FROM report_category"


def category_lookup_accents_sql() -> str:
    renamed = category_lookup_sql("pRoMo éLITE").replace("p.p_type AS categoria", "upper(p.p_type) || ' ÉLITE' AS categoria")
    return renamed


def top_keys_sql() -> str:
    def top(kind: str, key: str) -> str:
        return f"""(SELECT '{kind}' AS clave, CAST({key} AS VARCHAR) AS valor, CAST(round(sum(venta_exacta), 2) AS DOUBLE) AS ingreso_total,
  CAST(count(orden_id) AS BIGINT) AS total_ordenes, (SELECT CAST(count(DISTINCT {key}) AS BIGINT) FROM clean) AS claves
  FROM clean GROUP BY {key} ORDER BY 3 DESC, {key} LIMIT 1)"""
    return with_clean(top("cliente_id", "cliente_id") + " UNION ALL " + top("producto", "producto"))
