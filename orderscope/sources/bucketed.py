"""Order lines and orders stored in buckets of the order key.

``tables.ventas`` shuffles the fact table by order key in every query that does
not start from stored rows. Here both sides are stored once in as many buckets
of that key, each bucket one file, so that any later query joins bucket with
bucket: no exchange of the order lines, only a sort within each bucket (which
spills). The order side is stored with its customer columns, at orders scale,
so that no join in between loses the buckets. A part table below Spark's
broadcast threshold is broadcast; a larger one costs the joined rows a shuffle
by part key, as before.

Tables are external, under the shared folder, and known to the session's
catalog under names of their own until :func:`drop`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderscope.session import fresh_path
from orderscope.sources import tables

# The columns of the order side that order rows are made of.
SIDE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "n_name", "r_name"]


@dataclass(frozen=True)
class Buckets:
    """Names of the two bucketed tables, the source folder of the others, and the number of buckets."""

    lines: str
    orders: str
    sf_dir: str
    number: int


def store(spark: SparkSession, sf_dir: str, number: int | None = None) -> Buckets:
    """Store both sides in ``number`` buckets (by default the session's shuffle partitions)."""
    number = number or int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = uuid.uuid4().hex
    buckets = Buckets(f"order_lines_{made}", f"order_side_{made}", sf_dir, number)
    _write(tables.star(spark, sf_dir, "lineitem"), "l_orderkey", buckets.lines, number)
    _write(tables.order_side(spark, sf_dir).select(SIDE_COLUMNS), "o_orderkey", buckets.orders, number)
    return buckets


def _write(df: DataFrame, key: str, name: str, number: int) -> None:
    # dealt out by the buckets' own hash, so each bucket is written by one task into one file
    df.repartition(number, key).write.bucketBy(number, key).sortBy(key) \
        .option("path", fresh_path(df.sparkSession, name)).saveAsTable(name, format="parquet")


def ventas(spark: SparkSession, buckets: Buckets) -> DataFrame:
    """Raw order rows (schema ``RAW_ORDERS``), equal to ``tables.ventas``."""
    return tables.order_rows(spark.table(buckets.lines), spark.table(buckets.orders).hint("merge"), tables.star(spark, buckets.sf_dir, "part"))


def drop(spark: SparkSession, buckets: Buckets) -> None:
    """Take the tables out of the catalog (the files go when the driver ends)."""
    for name in (buckets.lines, buckets.orders):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
