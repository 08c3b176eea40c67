"""Synthetic orders in the original domains, generated as a distributed job.

Row ids come from a table Spark reads (by default the order keys of the
``orders`` table), so the work grows with the data; they are spread over
all cores before hashing, since generation is CPU-bound per row. Every
value is a pure function of (seed, id) and of the column's fixed slot in
one of four md5 digests per row (``DRAWS``, ``functions.hashing``); the
output does not depend on partitioning or task retries, and a SQL engine
with ``md5`` recomputes it exactly.

Lookups that were dictionaries become joins with fixed, tiny tables (10
cities, 35 products) that are broadcast: their size is fixed by the lists
below, not by the data.

Missing values: a fixed share of rows loses its rating and its discount,
chosen *exactly* (k rows, without replacement) as the k smallest hash
draws, by ``operators.selection``.
"""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderscope.functions.hashing import digest, draw, uniform_slot, weighted_pick
from orderscope.operators.selection import threshold, within
from orderscope.schemas import RAW_ORDERS
from orderscope.sources import tables

# The order domain. Weights are per cent and follow the list order.
SEED = "42"
CATEGORIES = ["Electronica", "Ropa", "Hogar", "Deportes", "Libros", "Belleza", "Juguetes"]
CATEGORY_WEIGHTS = [25, 20, 15, 15, 10, 10, 5]
PRODUCTS = {
    "Electronica": ["Celular", "Audifonos", "Tablet", "Smartwatch", "Parlante"],
    "Ropa": ["Camiseta", "Pantalon", "Zapatos", "Chaqueta", "Vestido"],
    "Hogar": ["Lampara", "Cojin", "Olla", "Cuadro", "Tapete"],
    "Deportes": ["Tenis", "Bicicleta", "Pesa", "Colchoneta", "Raqueta"],
    "Libros": ["Novela", "Autoayuda", "Historia", "Ciencia", "Cocina"],
    "Belleza": ["Crema", "Perfume", "Shampoo", "Maquillaje", "Serum"],
    "Juguetes": ["Lego", "Muneca", "Carro", "Puzzle", "Peluche"],
}
PAYMENT_METHODS = ["Tarjeta", "PSE", "Efectivo", "Contraentrega", "Nequi"]
PAYMENT_WEIGHTS = [35, 25, 15, 15, 10]
STATUSES = ["Entregado", "En_camino", "Pendiente", "Cancelado"]
STATUS_WEIGHTS = [72, 15, 8, 5]
CITIES = {
    "Bogota": "Cundinamarca",
    "Medellin": "Antioquia",
    "Cali": "Valle del Cauca",
    "Barranquilla": "Atlantico",
    "Cartagena": "Bolivar",
    "Bucaramanga": "Santander",
    "Pereira": "Risaralda",
    "Manizales": "Caldas",
    "Cucuta": "Norte de Santander",
    "Ibague": "Tolima",
}
CITY_WEIGHTS = [30, 20, 15, 10, 8, 6, 4, 3, 2, 2]
CALENDAR_START = dt.datetime(2022, 1, 1, 0, 0)
CALENDAR_END = dt.datetime(2023, 12, 31, 0, 0)
CUSTOMER_ID_RANGE = (1000, 50000)          # half-open
QUANTITY_RANGE = (1, 6)                    # half-open
PRICE_CENTS_RANGE = (1500, 250000)         # closed: 15.00 .. 2500.00
DISCOUNT_SHARE_PCT = 35
DISCOUNT_VALUES = [5, 10, 15, 20, 25, 30]
HIGH_RATING_SHARE_PCT = 85
HIGH_RATING_RANGE = (3, 6)                 # half-open
LOW_RATING_RANGE = (1, 3)                  # half-open
MISSING_RATINGS_PER_500K = 4000
MISSING_DISCOUNTS_PER_500K = 2000
REFERENCE_ROWS = 500_000

HOURS_IN_CALENDAR = int((CALENDAR_END - CALENDAR_START).total_seconds() // 3600) + 1


def order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One id per row of the ``orders`` table (its unique order key)."""
    return tables.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orden_id"))


def hourly_calendar(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every hour from ``start`` to ``end`` (inclusive) for each bounds row.

    Expanded in two steps, days then hours, so no single row ever holds more
    than one span of days or 24 stamps; the day rows are spread before the
    hourly expansion. Each day starts at the first stamp of the series on or
    after midnight, so a start off the hour keeps its minutes every day.
    """
    s_col, e_col = F.col(start).cast("timestamp_ntz"), F.col(end).cast("timestamp_ntz")
    day = F.explode(F.sequence(F.to_date(s_col), F.to_date(e_col), F.expr("INTERVAL 1 DAY")))
    days = bounds.select(s_col.alias("_s"), e_col.alias("_e"), day.alias("_d"))
    midnight = F.col("_d").cast("timestamp_ntz")
    seconds_in = F.timestamp_diff("SECOND", F.col("_s"), midnight)
    hours_in = F.greatest(F.ceil(seconds_in / F.lit(3600)), F.lit(0)).cast("int")
    day_start = F.timestamp_add("HOUR", hours_in, F.col("_s"))
    day_end = F.least(F.timestamp_add("MICROSECOND", F.lit(86_400_000_000 - 1), midnight), F.col("_e"))
    hours = F.explode(F.sequence(day_start, day_end, F.expr("INTERVAL 1 HOUR")))
    spread_days = days.repartition("_d").filter(day_start <= day_end)
    return spread_days.select(hours.alias("fecha"))


# Which digest and which of its four draws feeds each random choice.
DRAWS = {
    "fecha": ("a", 0), "cliente": ("a", 1), "categoria": ("a", 2), "producto": ("a", 3),
    "cantidad": ("b", 0), "precio": ("b", 1), "descuento": ("b", 2), "descuento_valor": ("b", 3),
    "pago": ("c", 0), "ciudad": ("c", 1), "estado": ("c", 2), "calificacion": ("c", 3),
    "calificacion_alta": ("d", 0), "calificacion_baja": ("d", 1),
    "nulo_calificacion": ("d", 2), "nulo_descuento": ("d", 3),
}
DIGESTS = ("a", "b", "c", "d")


def with_digests(ids: DataFrame, seed: str = SEED, groups: tuple[str, ...] = DIGESTS) -> DataFrame:
    """Add one md5 digest column per group; each is computed once per row.

    The values are derived in a later projection that references each
    digest several times; Spark does not inline a non-trivial expression
    referenced more than once, so every md5 runs once.
    """
    return ids.withColumns({f"_d{g}": digest(seed, g, F.col("orden_id")) for g in groups})


def _draw(name: str) -> F.Column:
    group, index = DRAWS[name]
    return draw(F.col(f"_d{group}"), index)


def _uniform(name: str, lo: int, hi: int) -> F.Column:
    """Uniform integer in [lo, hi)."""
    return F.lit(lo).cast("bigint") + uniform_slot(_draw(name), hi - lo)


def spread(ids: DataFrame) -> DataFrame:
    """Spread the ids over all cores before the per-row hashing.

    Generation is CPU-bound per row while the id source may be few large
    files; an explicit repartition (8 bytes per row) is kept as is by
    adaptive execution, unlike a size-based rebalance that would merge a
    small id shuffle into one task.
    """
    spark = ids.sparkSession
    try:
        parts = spark.sparkContext.defaultParallelism
    except Exception:  # a session without a local context (Spark Connect)
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ids.repartition(parts, "orden_id")


def _lookup_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    cities = spark.createDataFrame(list(CITIES.items()), "ciudad string, departamento string")
    products = spark.createDataFrame(
        [(c, i, p) for c, names in PRODUCTS.items() for i, p in enumerate(names)],
        "categoria string, _slot long, producto string")
    return cities, products


def base_orders(ids: DataFrame, seed: str = SEED) -> DataFrame:
    """One complete order per id.

    When ``ids`` carries the boolean columns ``sin_calificacion`` /
    ``sin_descuento`` (see ``missing_flags``) those values are blanked.
    """
    spark = ids.sparkSession
    cities, products = _lookup_tables(spark)
    rows = ids if "_da" in ids.columns else with_digests(ids, seed)
    stamp = F.timestamp_add("HOUR", uniform_slot(_draw("fecha"), HOURS_IN_CALENDAR),
                            F.lit(CALENDAR_START.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz"))
    discount = F.when(uniform_slot(_draw("descuento"), 100) < DISCOUNT_SHARE_PCT,
                      F.element_at(F.array(*[F.lit(float(v)) for v in DISCOUNT_VALUES]),
                                   (uniform_slot(_draw("descuento_valor"), len(DISCOUNT_VALUES)) + 1).cast("int"))
                      ).otherwise(F.lit(0.0))
    rating = F.when(uniform_slot(_draw("calificacion"), 100) < HIGH_RATING_SHARE_PCT,
                    _uniform("calificacion_alta", *HIGH_RATING_RANGE)) \
        .otherwise(_uniform("calificacion_baja", *LOW_RATING_RANGE)).cast("double")
    if "sin_calificacion" in ids.columns:
        rating = F.when(F.col("sin_calificacion"), F.lit(None).cast("double")).otherwise(rating)
    if "sin_descuento" in ids.columns:
        discount = F.when(F.col("sin_descuento"), F.lit(None).cast("double")).otherwise(discount)
    cents = _uniform("precio", PRICE_CENTS_RANGE[0], PRICE_CENTS_RANGE[1] + 1)
    out = rows.select(
        F.col("orden_id").cast("bigint").alias("orden_id"),
        stamp.alias("fecha"),
        _uniform("cliente", *CUSTOMER_ID_RANGE).alias("cliente_id"),
        weighted_pick(_draw("categoria"), CATEGORIES, CATEGORY_WEIGHTS).alias("categoria"),
        uniform_slot(_draw("producto"), 5).alias("_slot"),
        _uniform("cantidad", *QUANTITY_RANGE).cast("int").alias("cantidad"),
        (cents / F.lit(100.0)).alias("precio_unitario"),
        discount.alias("descuento_pct"),
        weighted_pick(_draw("pago"), PAYMENT_METHODS, PAYMENT_WEIGHTS).alias("metodo_pago"),
        weighted_pick(_draw("ciudad"), list(CITIES), CITY_WEIGHTS).alias("ciudad"),
        weighted_pick(_draw("estado"), STATUSES, STATUS_WEIGHTS).alias("estado_envio"),
        rating.alias("calificacion"),
    )
    out = out.join(F.broadcast(products), ["categoria", "_slot"]).join(F.broadcast(cities), "ciudad")
    return out.select(*[F.col(f.name).cast(f.dataType) for f in RAW_ORDERS.fields])


def missing_count(n_rows: int, per_500k: int) -> int:
    """How many of ``n_rows`` rows lose a value, at the original rate (floor)."""
    return n_rows * per_500k // REFERENCE_ROWS


def missing_flags(ids: DataFrame, seed: str = SEED) -> DataFrame:
    """Ids with two flags, rating missing / discount missing (exactly k each).

    The two thresholds are found by distributed radix selection; only the
    row count and two pairs of numbers reach the driver. All digests are
    kept so that ``base_orders`` does not hash again.
    """
    keyed = with_digests(ids.select(F.col("orden_id").cast("bigint").alias("orden_id")), seed)
    # The search makes seven small passes over (id, two draws): keep those
    # 24 bytes per row for its duration (memory, spilling to disk; a lost
    # executor's blocks are recomputed from lineage), then release them.
    draws = keyed.select("orden_id", _draw("nulo_calificacion").alias("_h_rating"),
                         _draw("nulo_descuento").alias("_h_discount")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_rows = draws.count()
        rating_cut = threshold(draws, "_h_rating", "orden_id", missing_count(n_rows, MISSING_RATINGS_PER_500K))
        discount_cut = threshold(draws, "_h_discount", "orden_id",
                                 missing_count(n_rows, MISSING_DISCOUNTS_PER_500K))
    finally:
        draws.unpersist()
    return keyed.withColumns({
        "sin_calificacion": within(_draw("nulo_calificacion"), F.col("orden_id"), rating_cut),
        "sin_descuento": within(_draw("nulo_descuento"), F.col("orden_id"), discount_cut),
    })


def generate_orders(ids: DataFrame, seed: str = SEED) -> DataFrame:
    """Complete synthetic raw orders (schema ``RAW_ORDERS``) with missing values injected.

    The missing-value flags are pure predicates on the same row's draws, so
    they are applied in the same projection: no join back to the ids.
    """
    return base_orders(missing_flags(spread(ids), seed), seed)


def weighted_counts(ids: DataFrame, seed: str = SEED) -> DataFrame:
    """Counts of each value of the four weighted columns, from one pass (unpivot + group)."""
    rows = with_digests(spread(ids), seed, ("a", "c"))
    picks = rows.select(
        weighted_pick(_draw("categoria"), CATEGORIES, CATEGORY_WEIGHTS).alias("categoria"),
        weighted_pick(_draw("pago"), PAYMENT_METHODS, PAYMENT_WEIGHTS).alias("metodo_pago"),
        weighted_pick(_draw("ciudad"), list(CITIES), CITY_WEIGHTS).alias("ciudad"),
        weighted_pick(_draw("estado"), STATUSES, STATUS_WEIGHTS).alias("estado_envio"),
    )
    long = picks.unpivot([], ["categoria", "metodo_pago", "ciudad", "estado_envio"], "columna", "valor")
    return long.groupBy("columna", "valor").agg(F.count(F.lit(1)).alias("n"))


def null_injection_rows(ids: DataFrame, seed: str = SEED) -> DataFrame:
    """The ids that lose a value, as rows (column name, id)."""
    flags = missing_flags(spread(ids), seed)
    rating = flags.filter("sin_calificacion").select(F.lit("calificacion").alias("columna"), "orden_id")
    discount = flags.filter("sin_descuento").select(F.lit("descuento_pct").alias("columna"), "orden_id")
    return rating.unionByName(discount)


def calendar_of_orders(orders: DataFrame) -> DataFrame:
    """The hourly calendar spanning the order dates of a table."""
    bounds = orders.agg(F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"))
    return hourly_calendar(bounds)
