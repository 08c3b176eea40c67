"""Order rows over the driver's star-schema test tables.

The analytics work on one flat order table. The test data is a
lineitem / orders / part / customer / nation / region star, so ``ventas``
joins it into that shape: one order line becomes one order row. No test
table has a null, so two columns get nulls by a fixed rule (a discount on
every 250th part key, a rating on every 125th order key) to exercise the
null fill.

Join plan, written for a large cluster:

* the order side is enriched first at orders scale —
  ``orders ⋈ (customer ⋈ nation ⋈ region)`` — so the fact table is never
  shuffled by customer key; nation and region are fixed 25- and 5-row
  dimensions that Spark's size-checked auto-broadcast takes;
* ``lineitem ⋈ order side`` on the order key is a **sort-merge join**
  (hint): both sides are hash-partitioned by order key and sorted, which
  spills to disk instead of holding a hash table of orders per task (a
  shuffled hash join measured ~25 % faster at sf0.1 but cannot spill, and
  its memory per task would depend on the cluster's partition count). The
  hint also keeps the planner from picking the fact table as a broadcast
  build side, which it would otherwise do on small inputs because, without
  statistics, the size estimate of a join is the product of its inputs. A
  hot order key on the fact side is split by adaptive skew-join handling;
* ``⋈ part`` on the part key: a sort-merge join when both sides are large,
  a broadcast join only when part is under ``autoBroadcastJoinThreshold``
  (checked from file statistics, and again from measured sizes by adaptive
  execution).

Only the columns the order schema needs are read, and Catalyst prunes them
further for each query (``ReadSchema`` in the plans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderscope.schemas import RAW_ORDERS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# The columns that order rows are made of.
STAR_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_discount double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string, o_orderstatus string",
    "part": "p_partkey bigint, p_type string, p_name string, p_retailprice double",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}

# Fixed values of the null rule on the test tables.
DISCOUNT_NULL_EVERY_PARTKEY = 250
RATING_NULL_EVERY_ORDERKEY = 125


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table, read as Parquet."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ventas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order rows (schema ``RAW_ORDERS``) built from the star tables, listed anew on every call."""
    return order_rows(star(spark, sf_dir, "lineitem"), order_side(spark, sf_dir).hint("merge"), star(spark, sf_dir, "part"))


def order_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the city and region of their customers."""
    orders, customer, nation, region = (star(spark, sf_dir, name) for name in ("orders", "customer", "nation", "region"))
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customer_geo = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    return orders.join(customer_geo, orders.o_custkey == customer_geo.c_custkey)


def order_rows(lineitem: DataFrame, side: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines with their orders and parts, in the shape of ``RAW_ORDERS``."""
    lines = lineitem.join(side, lineitem.l_orderkey == side.o_orderkey)
    rows = lines.join(part, lines.l_partkey == part.p_partkey)

    discount = F.when(F.col("l_partkey") % DISCOUNT_NULL_EVERY_PARTKEY == 0, F.lit(None)) \
        .otherwise(F.round(F.col("l_discount") * 100))
    rating = F.when(F.col("l_orderkey") % RATING_NULL_EVERY_ORDERKEY == 0, F.lit(None)) \
        .otherwise((F.lit(1) + F.col("l_linenumber") % 5).cast("double"))
    out = rows.select(
        F.col("l_orderkey").alias("orden_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("fecha"),
        F.col("o_custkey").alias("cliente_id"),
        F.col("p_type").alias("categoria"),
        F.col("p_name").alias("producto"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("p_retailprice").alias("precio_unitario"),
        discount.cast("double").alias("descuento_pct"),
        F.col("o_orderpriority").alias("metodo_pago"),
        F.col("n_name").alias("ciudad"),
        F.col("r_name").alias("departamento"),
        F.col("o_orderstatus").alias("estado_envio"),
        rating.alias("calificacion"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in RAW_ORDERS.fields])


def star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The columns of a star table that orders are made of, under their fixed
    schema: Spark lists the files anew but needs no job to infer types."""
    return spark.read.schema(STAR_COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")
