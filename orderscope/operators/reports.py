"""The five grouped sales reports, in one pass over raw or clean orders.

Each report takes an order DataFrame (raw rows or already-clean rows; the
result is the same) and aggregates it **once**. The rating mean fill of the
cleaning step is folded into that aggregate instead of being a second pass:

* per group we sum the non-null ratings and count the missing ones among
  the valid rows, and separately sum / count the ratings of *all* rows;
* the fill value (the mean over all raw rows, invalid ones included) is the
  ratio of the all-rows sums over the group rows, a global window over the
  already aggregated rows (one per group), so the fact data is read once;
* the group's mean rating after the fill is then
  (sum of known ratings + missing × fill) / valid rows.

So a report over the test tables costs one scan and one join of the fact
data rather than two. Grouping is partial (map side) + final, so a key that
holds a third of all rows is reduced inside every map task before the
shuffle. Money and ratings are summed exactly, so no result depends on the
order of rows, on raw and on clean input alike.

``report_tables`` computes all five from one scan in two levels: the measures
are summed once per combination of all grouping keys, and the grouping sets
run over those sums, so a fact row is not multiplied by the number of
reports. The batch job uses it.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderscope.functions import exact
from orderscope.functions.money import (
    combine, is_decimal, is_micro, ratio, remainder_part, revenue_decimal, revenue_double, revenue_micro, round_money, whole_part,
)
from orderscope.operators.clean import conform, is_valid

# Grouping keys of each report, as column expressions over raw orders.
KEYS = {
    "categorias": ["categoria"],
    "ciudades": ["ciudad", "departamento"],
    "pagos": ["metodo_pago"],
    "mensual": ["anio", "mes"],
    "estados": ["estado_envio"],
}

DEFAULT_MIN_CITY_ORDERS = 500


# Bands of the limb sums (functions.exact) of a row's revenue and rating; null for rows of ordinary size.
BANDS = ("_band", "_rating_band")
RATING_LIMIT = 1e11


def _with_keys(orders: DataFrame) -> DataFrame:
    return conform(orders).withColumns(_key_columns())


def _sale() -> tuple[Column, Column, Column]:
    return F.col("precio_unitario"), F.col("cantidad"), F.coalesce(F.col("descuento_pct"), F.lit(0.0))


def _wide_revenue() -> Column:
    """The row's revenue as the clean table shows it; all of an overflowing sale discounted is nothing."""
    return F.nanvl(revenue_double(*_sale()), F.lit(0.0))


@cache
def _key_columns() -> dict[str, Column]:
    ordinary = is_micro(*_sale()) | is_decimal(*_sale())
    rating = F.col("calificacion")
    return {"anio": F.year("fecha"), "mes": F.month("fecha"),
            "_band": F.when(is_valid() & ~ordinary, exact.band(_wide_revenue())),
            "_rating_band": F.when(F.abs(rating) >= RATING_LIMIT, exact.band(rating))}


# The column expressions below depend on constants only. A Column is an
# immutable, name-resolved expression tree, so each list is built once per
# process (a few thousand Py4J calls) and reused by every query.
@cache
def _measure_columns() -> tuple[Column, ...]:
    """The sums of one group and band. Rows of a band put their limbs where ordinary rows put whole, rest and decimal."""
    valid = is_valid()
    rating, band, rating_band = F.col("calificacion"), F.col("_band"), F.col("_rating_band")
    wide, wide_rating = band.isNotNull(), rating_band.isNotNull()
    sale, sold = _sale(), _wide_revenue()
    in_micro = valid & is_micro(*sale)
    micro = revenue_micro(*sale)
    in_whole = (F.rint(rating) == rating) & (F.abs(rating) < 1e6)
    low = F.when(wide_rating, exact.low(rating, rating_band)).when(in_whole, rating.cast("bigint"))
    upper = exact.middle(rating, rating_band) + exact.high(rating, rating_band) * F.lit(exact.BASE)
    rest = F.when(wide_rating, upper.cast("decimal(28,12)")).when(~in_whole, rating.cast("decimal(28,12)"))
    return (
        F.count_if(valid).alias("_n_valid"),
        F.count(F.when(valid, F.col("orden_id"))).alias("_n_ids"),
        F.sum(F.when(valid, F.col("cantidad"))).alias("_units"),
        F.sum(F.when(wide, exact.low(sold, band)).when(in_micro, whole_part(micro))).alias("_rev_whole"),
        F.sum(F.when(wide, exact.middle(sold, band)).when(in_micro, remainder_part(micro))).alias("_rev_frac"),
        F.sum(F.when(wide, exact.high(sold, band).cast("decimal(38,17)"))
              .when(valid & ~is_micro(*sale), revenue_decimal(*sale))).alias("_rev_decimal"),
        F.count_if(valid & (sale[2] > 0)).alias("_n_discount"),
        F.sum(F.when(valid, low)).alias("_rating_whole"),
        F.sum(F.when(valid, rest)).alias("_rating_rest"),
        F.count_if(valid & rating.isNull()).alias("_rating_missing"),
        F.sum(low).alias("_rating_whole_all"),
        F.sum(rest).alias("_rating_rest_all"),
        F.count(rating).alias("_rating_n_all"),
    )


MEASURES = ("_n_valid", "_n_ids", "_units", "_rev_whole", "_rev_frac", "_rev_decimal", "_n_discount", "_rating_whole",
            "_rating_rest", "_rating_missing", "_rating_whole_all", "_rating_rest_all", "_rating_n_all")
COUNTS = ("_n_valid", "_n_ids", "_units", "_n_discount", "_rating_missing", "_rating_n_all")


def _measure_type(name: str) -> str:
    return "decimal(38,17)" if name == "_rev_decimal" else "decimal(38,12)" if "_rest" in name else "bigint"


@cache
def _resum_columns() -> tuple[Column, ...]:
    """The measures summed again from sums (they are counts, exact sums and limbs of one band)."""
    return tuple(F.sum(m).cast(_measure_type(m)).alias(m) for m in MEASURES)


@cache
def _fold_columns() -> tuple[Column, ...]:
    """From the rows of a group's bands: counts, ordinary sums, and the limbs collected (at most one entry for each band)."""
    plain, plain_rating = F.col("_band").isNull(), F.col("_rating_band").isNull()
    none = F.lit(0).cast("bigint")
    rating = {end: (F.col(f"_rating_whole{end}"), F.col(f"_rating_rest{end}")) for end in ("", "_all")}
    return (
        *[F.sum(m).cast("bigint").alias(m) for m in COUNTS],
        combine(*[F.sum(F.when(plain, F.col(m))) for m in ("_rev_whole", "_rev_frac", "_rev_decimal")]).alias("_rev_plain"),
        F.collect_list(exact.entry(F.col("_band"), *[F.coalesce(F.col(m), none) for m in ("_rev_whole", "_rev_frac", "_rev_decimal")])).alias("_rev_wide"),
        *[_rating_sum(*[F.sum(F.when(plain_rating, c)) for c in pair]).alias(f"_rating_plain{end}") for end, pair in rating.items()],
        *[F.collect_list(exact.entry(F.col("_rating_band"), *[F.coalesce(c, none) for c in pair], none)).alias(f"_rating_wide{end}")
          for end, pair in rating.items()],
    )


def _rating_sum(whole: Column, rest: Column) -> Column:
    """Exact rating sum as a decimal."""
    return F.coalesce(whole, F.lit(0)).cast("decimal(25,12)") + F.coalesce(rest, F.lit(0)).cast("decimal(37,12)")


SUMS = {"_revenue": ("_rev_wide", "_rev_plain"), "_known": ("_rating_wide", "_rating_plain"), "_known_all": ("_rating_wide_all", "_rating_plain_all")}


@cache
def _sum_columns() -> dict[str, Column]:
    """The exact sums of a group, all from one expression: arrays of ``exact`` and ``nearest``."""
    parts = F.array(*[F.struct(F.col(wide).alias("wide"), F.col(plain).cast("decimal(38,17)").alias("plain")) for wide, plain in SUMS.values()])
    return {"_sums": F.transform(parts, lambda p: exact.total(p["wide"], p["plain"]))}


@cache
def _sum_fields() -> dict[str, Column]:
    return {name: F.element_at("_sums", i) for i, name in enumerate(SUMS, 1)}


def measures(orders: DataFrame, keys: list[str]) -> DataFrame:
    """Per-group measures with the fill folded in (one aggregate)."""
    return _finish(_with_keys(orders).groupBy(*keys, *BANDS).agg(*_measure_columns()), keys)


def folded(groups: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group from its bands' rows, with counts and exact sums; all rows in one partition."""
    return groups.repartition(1).groupBy(*keys).agg(*_fold_columns()).withColumns(_sum_columns()).withColumns(_sum_fields())


def _finish(groups: DataFrame, keys: list[str]) -> DataFrame:
    """Folded groups with the fill value and the clean-row total.

    The group rows (one per group, a few more where values are huge; bounded by
    the key domain, never by the number of orders) meet in one partition, where
    bands are folded and a window adds the totals of this report. Unlike a
    self-join that lets Spark evaluate the aggregate (or read its cached copy)
    once. Groups holding only invalid rows still count for the fill, so they are
    dropped after the window.
    """
    return (folded(groups, keys).withColumns(_total_columns("_gid" in keys))
            .filter(F.col("_n_valid") > 0).withColumn("_rating_avg", _rating_avg()))


@cache
def _total_columns(by_set: bool) -> dict[str, Column]:
    """The fill is the mean rating over all raw rows (invalid rows included); the total counts clean rows."""
    # sorted, so that a sum beyond the decimals does not depend on the order of rows either
    order = Window.partitionBy("_gid").orderBy("_known_all.nearest") if by_set else Window.orderBy("_known_all.nearest")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    decimals = F.when(F.count_if(F.col("_known_all.exact").isNull()).over(everything) == 0, F.try_sum("_known_all.exact").over(everything))
    known = F.coalesce(decimals.cast("double"), F.sum("_known_all.nearest").over(everything))
    return {
        "_fill": ratio(known, F.sum("_rating_n_all").over(everything)),
        "_total_rows": F.sum("_n_valid").over(everything),
    }


@cache
def _rating_avg() -> Column:
    return ratio(F.col("_known.nearest") + F.col("_rating_missing") * F.col("_fill"), F.col("_n_valid"))


def _common(m: DataFrame) -> dict[str, Column]:
    return _common_columns()


@cache
def _common_columns() -> dict[str, Column]:
    return {
        "total_ordenes": F.col("_n_ids"),
        "total_unidades": F.col("_units"),
        "ingreso_total": F.coalesce(round_money(F.col("_revenue.exact")), F.col("_revenue.nearest")),
        "ticket_promedio": F.round(ratio(F.col("_revenue.nearest"), F.col("_n_valid")), 2),
        "calificacion_promedio": F.round(F.col("_rating_avg"), 2),
        "pct_con_descuento": F.round(ratio(F.col("_n_discount"), F.col("_n_valid")) * 100, 2),
        "pct_of_total_ordenes": F.round(ratio(F.col("_n_ids"), F.col("_total_rows")) * 100, 2),
    }


def _category(m: DataFrame) -> DataFrame:
    c = _common(m)
    return m.select(
        "categoria", c["total_ordenes"].alias("total_ordenes"), c["total_unidades"].alias("total_unidades"),
        c["ingreso_total"].alias("ingreso_total"), c["ticket_promedio"].alias("ticket_promedio"),
        c["calificacion_promedio"].alias("calificacion_promedio"),
        c["pct_con_descuento"].alias("pct_con_descuento"),
    ).orderBy(F.desc("ingreso_total"), F.asc("categoria"))


def _city(m: DataFrame, min_orders: int | None) -> DataFrame:
    c = _common(m)
    rows = m.select(
        "ciudad", "departamento", c["total_ordenes"].alias("total_ordenes"),
        c["ingreso_total"].alias("ingreso_total"), c["ticket_promedio"].alias("ticket_promedio"),
        c["calificacion_promedio"].alias("calificacion_promedio"),
    )
    if min_orders is None:
        rows = rows.withColumn("_mean", F.avg("total_ordenes").over(Window.partitionBy()))
        kept = rows.filter(F.col("total_ordenes") > F.col("_mean")).drop("_mean")
    else:
        kept = rows.filter(F.col("total_ordenes") > F.lit(min_orders))
    return kept.orderBy(F.desc("ingreso_total"), F.asc("ciudad"), F.asc("departamento"))


def _payment(m: DataFrame) -> DataFrame:
    c = _common(m)
    return m.select(
        "metodo_pago", c["total_ordenes"].alias("total_ordenes"), c["ingreso_total"].alias("ingreso_total"),
        c["pct_of_total_ordenes"].alias("pct_of_total_ordenes"),
    ).orderBy(F.desc("total_ordenes"), F.asc("metodo_pago"))


def month_over_month(by_month: DataFrame) -> DataFrame:
    """% change of (rounded) revenue against the previous month; first month null.

    The input has one row per month, so the unpartitioned window moves a
    bounded number of rows (the months in the data), never order rows. The
    previous value is computed once and the ratio is null, not an error,
    when the previous month's revenue is 0.
    """
    w = Window.orderBy("anio", "mes")
    with_prev = by_month.withColumn("_prev", F.lag("ingreso_total").over(w))
    change = F.round(F.try_divide(F.col("ingreso_total") - F.col("_prev"), F.col("_prev")) * 100, 2)
    return with_prev.withColumn("variacion_pct", change).drop("_prev").orderBy("anio", "mes")


def _monthly(m: DataFrame) -> DataFrame:
    c = _common(m)
    by_month = m.select(
        F.col("anio").cast("int").alias("anio"), F.col("mes").cast("int").alias("mes"),
        c["total_ordenes"].alias("total_ordenes"), c["ingreso_total"].alias("ingreso_total"),
        c["calificacion_promedio"].alias("calificacion_promedio"),
    )
    return month_over_month(by_month)


def _status(m: DataFrame) -> DataFrame:
    c = _common(m)
    return m.select(
        "estado_envio", c["total_ordenes"].alias("total_ordenes"), c["ingreso_total"].alias("ingreso_total"),
        c["calificacion_promedio"].alias("calificacion_promedio"),
    ).orderBy(F.desc("total_ordenes"), F.asc("estado_envio"))


def report_category(orders: DataFrame) -> DataFrame:
    """Orders, units, revenue, ticket, rating, % discounted per category; revenue desc."""
    return _category(measures(orders, KEYS["categorias"]))


def report_city(orders: DataFrame, min_orders: int | None = DEFAULT_MIN_CITY_ORDERS) -> DataFrame:
    """R2: per (city, department), only groups with more than ``min_orders`` orders; revenue desc.

    ``None``: more than the mean of all groups.
    """
    return _city(measures(orders, KEYS["ciudades"]), min_orders)


def report_payment(orders: DataFrame) -> DataFrame:
    """Per payment method, with the share of all clean rows; orders desc."""
    return _payment(measures(orders, KEYS["pagos"]))


def report_monthly(orders: DataFrame) -> DataFrame:
    """Per (year, month), with % change of rounded revenue vs the previous month."""
    return _monthly(measures(orders, KEYS["mensual"]))


def report_status(orders: DataFrame) -> DataFrame:
    """Per delivery status; orders desc."""
    return _status(measures(orders, KEYS["estados"]))


ALL_KEYS = ["categoria", "ciudad", "departamento", "metodo_pago", "anio", "mes", "estado_envio"]


def _set_columns(names: list[str]) -> list[str]:
    return [k for k in ALL_KEYS if any(k in KEYS[n] for n in names)]


def grouped_measures(orders: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The measures of several reports' key sets from **one** scan.

    Two levels: sums per combination of all keys (a partial and a final
    aggregate over the facts), then grouping sets over those sums, so the
    rows that Spark repeats once per set are combinations, not facts. One row
    per group of each set (a few dozen rows), tagged by ``_gid``; small enough
    to persist or checkpoint and derive every report from.
    """
    names = list(names or KEYS)
    combinations = _with_keys(orders).groupBy(*_set_columns(names), *BANDS).agg(*_measure_columns())
    return regrouped(combinations, names)


def regrouped(combinations: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The grouping sets over the measures of all key combinations."""
    names = list(names or KEYS)
    sets = [[F.col(k) for k in [*KEYS[name], *BANDS]] for name in names]
    return combinations.groupingSets(sets, *[F.col(k) for k in [*_set_columns(names), *BANDS]]) \
        .agg(*_resum_columns(), F.grouping_id().alias("_gid"))


def value_sums(orders: DataFrame, keys: list[str]) -> DataFrame:
    """Orders and exact revenue (``_n_ids``, ``_revenue``) of the clean rows, by each value of each key column.

    For keys of any number of values: rows stay spread by value. ``_gid`` tells
    the key columns apart, as ``grouping_id`` over ``keys``.
    """
    valid = _with_keys(orders).filter(is_valid())
    sets = [[F.col(k), F.col("_band")] for k in keys]
    needed = ("_n_ids", "_rev_whole", "_rev_frac", "_rev_decimal")
    sums = valid.groupingSets(sets, *[F.col(k) for k in keys], F.col("_band")).agg(
        *[c for m, c in zip(MEASURES, _measure_columns(), strict=True) if m in needed], F.expr("grouping_id() div 2").alias("_gid"))
    plain, none = F.col("_band").isNull(), F.lit(0).cast("bigint")
    revenue = needed[1:]
    return sums.groupBy(*keys, "_gid").agg(
        F.sum("_n_ids").cast("bigint").alias("_n_ids"), combine(*[F.sum(F.when(plain, F.col(m))) for m in revenue]).alias("_plain"),
        F.collect_list(exact.entry(F.col("_band"), *[F.coalesce(F.col(m), none) for m in revenue])).alias("_wide")) \
        .withColumn("_revenue", exact.total(F.col("_wide"), F.col("_plain")))


def summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Measure rows added up by ``keys`` (which must hold the bands)."""
    return rows.groupBy(*keys).agg(*_resum_columns())


def set_id(name: str, names: list[str] | None = None) -> int:
    """``grouping_id`` of a report's key set within ``grouped_measures(names)``.

    grouping_id sets a bit for every grouping column NOT in the set, the
    first column being the highest bit. The bands come last, in every set.
    """
    cols = _set_columns(list(names or KEYS))
    return sum(1 << (len(cols) + len(BANDS) - 1 - i) for i, k in enumerate(cols) if k not in KEYS[name])


def finished(grouped: DataFrame) -> DataFrame:
    """The groups of all sets of ``grouped_measures``, folded and with the totals of their set.

    A few dozen rows from which every report is a filter and a projection: save
    these, and the fold is planned and run once for all reports.
    """
    return _finish(grouped, ["_gid", *ALL_KEYS])


def reports_from_finished(done: DataFrame, min_city_orders: int = DEFAULT_MIN_CITY_ORDERS) -> dict[str, DataFrame]:
    """The five reports from the output of ``finished``."""
    parts = {name: done.filter(F.col("_gid") == F.lit(set_id(name))) for name in KEYS}
    return {
        "categorias": _category(parts["categorias"]),
        "ciudades": _city(parts["ciudades"], min_city_orders),
        "pagos": _payment(parts["pagos"]),
        "mensual": _monthly(parts["mensual"]),
        "estados": _status(parts["estados"]),
    }


def reports_from_grouped(grouped: DataFrame,
                         min_city_orders: int = DEFAULT_MIN_CITY_ORDERS) -> dict[str, DataFrame]:
    """The five reports from the output of ``grouped_measures``."""
    return reports_from_finished(finished(grouped), min_city_orders)


def report_tables(orders: DataFrame, min_city_orders: int = DEFAULT_MIN_CITY_ORDERS) -> dict[str, DataFrame]:
    """All five reports over one grouping-sets aggregate of ``orders``."""
    return reports_from_grouped(grouped_measures(orders), min_city_orders)
