"""Registered queries: one callable per operator key, plus its SQL oracle.

Every callable reads the driver tables under ``sf_dir`` anew (whole tables, no
row caps) and returns a DataFrame. Cleaning, round trips and transcripts run
jobs while the query is built (they store a table or sort once); the others
are lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderscope.operators import charts, clean, questions, reports, transcripts
from orderscope.plans import batch, incremental
from orderscope.plans import oracle as O
from orderscope.schemas import RAW_ORDERS
from orderscope.session import fresh_path, prepare, saved
from orderscope.sources import bucketed, files, rejects, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return run
    return wrap


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.ventas(spark, sf_dir)


# --- cleaning ---------------------------------------------------------------

@register("rating_mean", O.with_clean("SELECT avg(calificacion) AS calificacion_media FROM ventas"))
def q_rating_mean(spark, sf_dir):
    """Mean of the non-null ratings over all raw rows."""
    return clean.rating_mean(_orders(spark, sf_dir))


@register("clean_orders", O.with_clean(f"SELECT {O.CLEAN_COLUMNS} FROM clean"))
def q_clean_orders(spark, sf_dir):
    """Fill, validity filter, derived columns."""
    return clean.clean_orders(batch.stage_raw(_orders(spark, sf_dir)))


@register("profile_orders", O.with_clean("""
SELECT CAST(count(*) AS BIGINT) AS filas,
       CAST(count(*) FILTER (WHERE precio_unitario > 0 AND cantidad > 0) AS BIGINT) AS filas_validas,
       CAST(count(*) FILTER (WHERE calificacion IS NULL) AS BIGINT) AS nulos_calificacion,
       CAST(count(*) FILTER (WHERE descuento_pct IS NULL) AS BIGINT) AS nulos_descuento,
       avg(calificacion) AS calificacion_media
FROM ventas"""))
def q_profile_orders(spark, sf_dir):
    """Row counts before/after cleaning and null counts, one pass."""
    return clean.profile(_orders(spark, sf_dir))


@register("preview_orders", O.with_clean("""
SELECT * FROM ventas
ORDER BY orden_id, fecha, cliente_id, categoria, producto, cantidad, precio_unitario,
         descuento_pct NULLS FIRST, metodo_pago, ciudad, departamento, estado_envio, calificacion NULLS FIRST
LIMIT 5"""))
def q_preview_orders(spark, sf_dir):
    """First five raw rows in a total order (top-k)."""
    return clean.preview(_orders(spark, sf_dir), 5)


@register("event_hours", """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts,
       CAST(year(ts) AS INTEGER) AS anio, CAST(month(ts) AS INTEGER) AS mes,
       CAST(hour(ts) AS INTEGER) AS hora
FROM events""")
def q_event_hours(spark, sf_dir):
    """year / month / hour of zone-less event stamps."""
    ev = tables.events(spark, sf_dir)
    ts = F.col("ts").cast("timestamp_ntz")
    return ev.select("event_id", ts.alias("ts"), F.year(ts).alias("anio"),
                     F.month(ts).alias("mes"), F.hour(ts).alias("hora"))


# --- reports ----------------------------------------------------------------

@register("report_category", O.with_clean("SELECT * FROM report_category", O.R_CATEGORY))
def q_report_category(spark, sf_dir):
    """R1."""
    return reports.report_category(_orders(spark, sf_dir))


@register("report_city", O.with_clean("SELECT * FROM report_city", O.R_CITY.format(min_orders=500)))
def q_report_city(spark, sf_dir):
    """R2 with the reference threshold (more than 500 orders)."""
    return reports.report_city(_orders(spark, sf_dir))


@register("report_city_having", O.with_clean("SELECT * FROM report_city", O.R_CITY.format(min_orders=O.MEAN_CITY_ORDERS)))
def q_report_city_having(spark, sf_dir):
    """R2 with a threshold from the data: more orders than the mean city."""
    return reports.report_city(_orders(spark, sf_dir), min_orders=None)


@register("report_payment", O.with_clean("SELECT * FROM report_payment", O.R_PAYMENT))
def q_report_payment(spark, sf_dir):
    """R3."""
    return reports.report_payment(_orders(spark, sf_dir))


@register("report_monthly", O.with_clean("SELECT * FROM report_monthly", O.R_MONTHLY))
def q_report_monthly(spark, sf_dir):
    """R4."""
    return reports.report_monthly(_orders(spark, sf_dir))


@register("report_status", O.with_clean("SELECT * FROM report_status", O.R_STATUS))
def q_report_status(spark, sf_dir):
    """R5."""
    return reports.report_status(_orders(spark, sf_dir))


@register("report_huge_values", O.with_clean("SELECT * FROM report_huge", O.R_HUGE))
def q_report_huge_values(spark, sf_dir):
    """A6-A8 where every 40th order's price is 10^14 and every 60th order's rating 10^12 times larger: exact all the same."""
    order = F.col("orden_id")
    huge = _orders(spark, sf_dir).withColumns({
        "precio_unitario": F.when(order % 40 == 0, F.col("precio_unitario") * F.lit(1e14)).otherwise(F.col("precio_unitario")),
        "calificacion": F.when(order % 60 == 0, F.col("calificacion") * F.lit(1e12)).otherwise(F.col("calificacion"))})
    return reports.report_category(huge)


# --- questions ----------------------------------------------------------------

LOOKUP_CATEGORY = "promo"          # lower case on purpose: the match ignores case
RANKING_METRIC = "ticket_promedio"
TOP_CITIES_N = 5
WIDE_CITIES_N = 20
MONTHLY_YEAR = 1996
UNKNOWN_CATEGORY = "sin categoria"


@register("category_lookup", O.category_lookup_sql(LOOKUP_CATEGORY))
def q_category_lookup(spark, sf_dir):
    """T1."""
    return questions.category_lookup(reports.report_category(_orders(spark, sf_dir)), LOOKUP_CATEGORY)


@register("category_lookup_accents", O.category_lookup_accents_sql())
def q_category_lookup_accents(spark, sf_dir):
    """A name with an accent is found in any case."""
    renamed = _orders(spark, sf_dir).withColumn("categoria", F.concat(F.upper("categoria"), F.lit(" ÉLITE")))
    return questions.category_lookup(reports.report_category(renamed), "pRoMo éLITE")


@register("category_ranking", O.category_ranking_sql(RANKING_METRIC))
def q_category_ranking(spark, sf_dir):
    """T2."""
    return questions.category_ranking(reports.report_category(_orders(spark, sf_dir)), RANKING_METRIC)


@register("category_ranking_orders", O.category_ranking_sql("total_ordenes"))
def q_category_ranking_orders(spark, sf_dir):
    """T2 on an integer metric."""
    return questions.category_ranking(reports.report_category(_orders(spark, sf_dir)), "total_ordenes")


@register("top_cities", O.top_cities_sql(TOP_CITIES_N))
def q_top_cities(spark, sf_dir):
    """T3 / O5."""
    return questions.top_cities(reports.report_city(_orders(spark, sf_dir)), TOP_CITIES_N)


@register("top_cities_wide", O.top_cities_sql(WIDE_CITIES_N))
def q_top_cities_wide(spark, sf_dir):
    """T3 / O5 with n above ten: all n rows."""
    return questions.top_cities(reports.report_city(_orders(spark, sf_dir)), WIDE_CITIES_N)


@register("payment_lines", O.payment_lines_sql())
def q_payment_lines(spark, sf_dir):
    """T4."""
    return questions.payment_lines(reports.report_payment(_orders(spark, sf_dir)))


@register("monthly_for_year", O.monthly_for_year_sql(MONTHLY_YEAR))
def q_monthly_for_year(spark, sf_dir):
    """T5 (filter above the window: January keeps its change vs December)."""
    return questions.monthly_for_year(reports.report_monthly(_orders(spark, sf_dir)), MONTHLY_YEAR)


@register("status_lines", O.status_lines_sql())
def q_status_lines(spark, sf_dir):
    """T6."""
    return questions.status_lines(reports.report_status(_orders(spark, sf_dir)))


@register("executive_summary", O.executive_summary_sql())
def q_executive_summary(spark, sf_dir):
    """One scan (grouping sets) and one global aggregate."""
    return questions.executive_summary_of_orders(_orders(spark, sf_dir))


@register("top_keys", O.top_keys_sql())
def q_top_keys(spark, sf_dir):
    """A15 over wide key domains: the product and the customer with the highest revenue."""
    return questions.top_keys(_orders(spark, sf_dir), ["producto", "cliente_id"])


@register("answer_texts", O.answer_texts_sql(RANKING_METRIC, TOP_CITIES_N, MONTHLY_YEAR))
def q_answer_texts(spark, sf_dir):
    """T2-T6 as the reader sees them, headers included, from one scan."""
    done = saved(reports.finished(reports.grouped_measures(_orders(spark, sf_dir))))
    return questions.answers(reports.reports_from_finished(done), RANKING_METRIC, TOP_CITIES_N, MONTHLY_YEAR)


@register("category_not_found", O.category_not_found_sql(UNKNOWN_CATEGORY))
def q_category_not_found(spark, sf_dir):
    """A lookup that finds nothing lists the valid options."""
    return questions.category_answer(reports.report_category(_orders(spark, sf_dir)), UNKNOWN_CATEGORY)


@register("empty_input", O.empty_input_sql(RANKING_METRIC, TOP_CITIES_N))
def q_empty_input(spark, sf_dir):
    """C11: every answer over orders of which none is left (quantity below 0)."""
    none = _orders(spark, sf_dir).filter("cantidad < 0")
    tables_ = reports.reports_from_finished(saved(reports.finished(reports.grouped_measures(none))))
    lookup = questions.category_answer(tables_["categorias"], LOOKUP_CATEGORY).select(F.lit("categoria").alias("pregunta"), "texto")
    return lookup.unionByName(questions.answers(tables_, RANKING_METRIC, TOP_CITIES_N, 0))


@register("schema_rows", O.schema_rows_sql())
def q_schema_rows(spark, sf_dir):
    """The raw order columns with type and number of nulls."""
    return clean.schema_rows(clean.conform(_orders(spark, sf_dir)))


# --- chart tables ---------------------------------------------------------------

@register("kpis", O.kpis_sql())
def q_kpis(spark, sf_dir):
    """V1."""
    return charts.kpis(reports.report_category(_orders(spark, sf_dir)))


@register("category_bars", O.category_bars_sql())
def q_category_bars(spark, sf_dir):
    """V2."""
    return charts.category_bars(reports.report_category(_orders(spark, sf_dir)))


@register("payment_share", O.payment_share_sql())
def q_payment_share(spark, sf_dir):
    """V3."""
    return charts.payment_share(reports.report_payment(_orders(spark, sf_dir)))


@register("month_period", O.month_period_sql())
def q_month_period(spark, sf_dir):
    """V4."""
    return charts.month_period(reports.report_monthly(_orders(spark, sf_dir)))


@register("city_table", O.city_table_sql())
def q_city_table(spark, sf_dir):
    """V5."""
    return charts.city_table(reports.report_city(_orders(spark, sf_dir)))


@register("status_table", O.status_table_sql())
def q_status_table(spark, sf_dir):
    """V6."""
    return charts.status_table(reports.report_status(_orders(spark, sf_dir)))


# --- sources, sinks and round trips --------------------------------------------

@register("parquet_roundtrip", O.with_clean(f"SELECT {O.CLEAN_COLUMNS} FROM clean"))
def q_parquet_roundtrip(spark, sf_dir):
    """Clean orders → partitioned Parquet in the shared folder → read back."""
    path = fresh_path(spark, "clean-orders")
    files.write_clean_parquet(clean.clean_orders(batch.stage_raw(_orders(spark, sf_dir))), path)
    return files.read_clean_parquet(spark, path)


@register("csv_roundtrip", O.with_clean("SELECT * FROM report_category", O.R_CATEGORY))
def q_csv_roundtrip(spark, sf_dir):
    """S7 → S1 → R1 → S6 → S3: raw rows through CSV, the report through CSV."""
    raw_path = fresh_path(spark, "raw-orders-csv")
    files.write_orders_csv(_orders(spark, sf_dir), raw_path)
    raw = files.read_orders_csv(spark, raw_path)
    report_base = fresh_path(spark, "reports-csv")
    files.write_report_csv(reports.report_category(raw), files.report_path(report_base, "categorias"))
    return files.read_report(spark, report_base, "categorias")


@register("report_bucketed", O.with_clean("SELECT * FROM report_category", O.R_CATEGORY))
def q_report_bucketed(spark, sf_dir):
    """A report over order lines and orders stored in buckets of the order key."""
    return reports.report_category(bucketed.ventas(spark, bucketed.store(spark, sf_dir)))


@register("csv_inferred", O.with_clean("SELECT * FROM report_category", O.R_CATEGORY))
def q_csv_inferred(spark, sf_dir):
    """S1 with inferred types: the report does not depend on who decides on them."""
    raw_path = fresh_path(spark, "raw-orders-csv")
    files.write_orders_csv(_orders(spark, sf_dir), raw_path)
    return reports.report_category(files.read_orders_csv(spark, raw_path, infer_schema=True))


def _dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as CSV lines, some with a text for a number or a date, or with a field too many or too few."""
    order = F.col("orden_id")
    texts = {f.name: F.col(f.name).cast("string") for f in RAW_ORDERS.fields}
    texts["precio_unitario"] = F.when(order % 97 == 0, "diez").otherwise(texts["precio_unitario"])
    texts["cantidad"] = F.when(order % 89 == 0, "2 unidades").otherwise(texts["cantidad"])
    texts["fecha"] = F.when(order % 83 == 0, "ayer").otherwise(texts["fecha"])
    texts["descuento_pct"] = F.when(order % 97 == 1, "").otherwise(texts["descuento_pct"])
    line = F.to_csv(F.struct(*[c.alias(n) for n, c in texts.items()]))
    return _orders(spark, sf_dir).select(
        F.when(order % 101 == 0, F.concat(line, F.lit(",de,más"))).when(order % 103 == 0, F.concat(order.cast("string"), F.lit(",corta"))).otherwise(line).alias("value"))


def _checked(spark: SparkSession, sf_dir: str) -> rejects.CheckedOrders:
    path = fresh_path(spark, "dirty-orders-csv")
    rejects.write_lines(_dirty_lines(spark, sf_dir), path)
    return rejects.read_orders_checked(spark, path, header=False)


@register("csv_rejects", O.csv_rejects_sql())
def q_csv_rejects(spark, sf_dir):
    """Every rejected line with its order number and reasons."""
    found = _checked(spark, sf_dir).rejects
    return found.select(F.split_part("linea", F.lit(","), F.lit(1)).cast("bigint").alias("orden_id"), F.array_join("motivos", ",").alias("motivos"))


@register("csv_reject_counts", O.csv_reject_counts_sql())
def q_csv_reject_counts(spark, sf_dir):
    """Rejected rows by reason; accepted and rejected rows are all rows."""
    return rejects.reject_counts(_checked(spark, sf_dir))


@register("csv_accepted", O.csv_accepted_sql())
def q_csv_accepted(spark, sf_dir):
    """The category report over what is left of a file with bad lines."""
    return reports.report_category(_checked(spark, sf_dir).good)


REPORT_MEASURES = ["total_ordenes", "total_unidades", "ingreso_total", "ticket_promedio", "calificacion_promedio",
                   "pct_con_descuento", "pct_of_total_ordenes", "variacion_pct"]


def _report_rows(name: str, df: DataFrame) -> DataFrame:
    """Every stored column of a report: its key as text, its measures, null for those it lacks."""
    keys = reports.KEYS[name]
    key = F.col(keys[0]).cast("string") if len(keys) == 1 else \
        F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    kinds = {"total_ordenes": "bigint", "total_unidades": "bigint"}
    measures = [(F.col(m) if m in df.columns else F.lit(None)).cast(kinds.get(m, "double")).alias(m) for m in REPORT_MEASURES]
    return df.select(F.lit(name).alias("reporte"), key.alias("clave"), *measures)


@register("parquet_rewrite", O.with_clean(f"SELECT {O.CLEAN_COLUMNS} FROM clean"))
def q_parquet_rewrite(spark, sf_dir):
    """A table whose January months hold wrong rows, written again: only those are replaced, and twice is as good as once."""
    path = fresh_path(spark, "clean-orders")
    right = clean.clean_orders(batch.stage_raw(_orders(spark, sf_dir)))
    spoiled = right.withColumn("categoria", F.when(F.col("mes") == 1, "?").otherwise(F.col("categoria")))
    files.write_clean_parquet(spoiled, path)
    for _ in range(2):
        files.rewrite_clean_months(right.filter("mes = 1"), path)
    return files.read_clean_parquet(spark, path)


@register("reports_reload", O.reports_reload_sql())
def q_reports_reload(spark, sf_dir):
    """The batch job writes all five reports; they are reloaded and listed."""
    paths = batch.run_pipeline(spark, _orders(spark, sf_dir))
    return _all_rows(batch.current_reports(spark, paths["base"]))


def _all_rows(stored: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in stored.items():
        rows = _report_rows(name, df)
        out = rows if out is None else out.unionByName(rows)
    return out


@register("reports_incremental", O.reports_reload_sql())
def q_reports_incremental(spark, sf_dir):
    """Three batches of orders, one after the other, one of them first wrong and then replaced; only each batch is read."""
    base = fresh_path(spark, "report-versions")
    orders = _orders(spark, sf_dir)
    third = [orders.filter(F.col("orden_id") % 3 == i) for i in range(3)]
    incremental.apply(spark, base, "lote-0", third[0])
    incremental.apply(spark, base, "lote-1", third[1].filter("cantidad > 10"))
    incremental.apply(spark, base, "lote-2", third[2])
    incremental.apply(spark, base, "lote-1", third[1], replace=True)
    return _all_rows(batch.current_reports(spark, base))


# --- transcripts -----------------------------------------------------------------

@register("transcript_turns", O.TRANSCRIPT_TURNS_SQL)
def q_transcript_turns(spark, sf_dir):
    """H1."""
    return transcripts.transcript_turns(tables.conversations(spark, sf_dir))


@register("transcript_messages", O.transcript_messages_sql(transcripts.SYSTEM_MESSAGE))
def q_transcript_messages(spark, sf_dir):
    """H2 as rows: the system message, then the kept turns."""
    return transcripts.transcript_messages(tables.conversations(spark, sf_dir))


@register("transcript_text", O.transcript_text_sql(transcripts.SYSTEM_MESSAGE, transcripts.PART))
def q_transcript_text(spark, sf_dir):
    """H2 as text, in parts of bounded size."""
    return transcripts.transcript_text(tables.conversations(spark, sf_dir))
