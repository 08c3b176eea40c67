"""CSV scan that loses no row: typed orders on one side, rejected rows with their reasons on the other.

The file is parsed once. Every field is read as text beside Spark's corrupt
record column (a line with too many or too few fields lands there whole), and
each text is cast to its column's type with ``try_cast``: a text that is no
value of its type is a reason, not an error and not a silent null. Typed rows
and reasons are stored together in one write, in two folders, so that good
rows and rejects are read without parsing again, and good plus rejected rows
are the input rows.

Reasons are ``columnas`` (wrong number of fields; the fields are not trusted
then) and ``tipo:<column>``, one for each column that does not parse. An empty
field is a null and no reason. Whether a value makes sense (a price below 0)
is not decided here but by the validity filter of the cleaning step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderscope.schemas import RAW_ORDERS
from orderscope.session import fresh_path
from orderscope.sources.files import READ_NULL_MARKER, STAMP_FORMAT

CORRUPT = "_linea_mala"
WIDTH = "columnas"
WRONG_TYPE = "tipo:"

REJECTS = T.StructType([
    T.StructField("linea", T.StringType()),
    T.StructField("motivos", T.ArrayType(T.StringType())),
    T.StructField("archivo", T.StringType()),
])


@dataclass(frozen=True)
class CheckedOrders:
    """The two sides of a scan. ``path`` holds them as Parquet, ``aceptada=true`` and ``aceptada=false``."""

    good: DataFrame
    rejects: DataFrame
    path: str


def _typed(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        return F.try_to_timestamp(text, F.lit(STAMP_FORMAT)).cast("timestamp_ntz")
    if isinstance(field.dataType, T.StringType):
        return text
    return F.trim(text).try_cast(field.dataType)


def read_orders_checked(spark: SparkSession, path: str, header: bool = True) -> CheckedOrders:
    """S1 with rejects: parse ``path`` once, store both sides, read them back."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_ORDERS.fields] + [T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.schema(texts).option("header", header).option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", CORRUPT).option("nullValue", READ_NULL_MARKER).csv(path)
    typed = {f.name: _typed(f) for f in RAW_ORDERS.fields}
    wrong = [F.when(F.col(n).isNotNull() & (F.col(n) != "") & c.isNull(), F.lit(WRONG_TYPE + n))
             for n, c in typed.items() if not isinstance(RAW_ORDERS[n].dataType, T.StringType)]
    reasons = F.when(F.col(CORRUPT).isNotNull(), F.array(F.lit(WIDTH))).otherwise(F.array_compact(F.array(*wrong)))
    line = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[F.col(n) for n in typed])))
    checked = lines.select(
        *[c.alias(n) for n, c in typed.items()], F.when(F.size(reasons) > 0, line).alias("linea"), reasons.alias("motivos"),
        F.col("_metadata.file_path").alias("archivo"), (F.size(reasons) == 0).alias("aceptada"))
    stored = fresh_path(spark, "checked-orders")
    checked.write.partitionBy("aceptada").parquet(stored)
    kinds = T.StructType([*RAW_ORDERS.fields, *REJECTS.fields, T.StructField("aceptada", T.BooleanType())])
    both = spark.read.schema(kinds).parquet(stored)
    return CheckedOrders(both.filter("aceptada").select(RAW_ORDERS.names), both.filter("NOT aceptada").select(REJECTS.names), stored)


def reject_counts(checked: CheckedOrders) -> DataFrame:
    """Rows ``motivo, filas``: each reason, then ``rechazadas``, ``aceptadas`` and ``total`` rows."""
    by_reason = checked.rejects.select(F.explode("motivos").alias("motivo")).groupBy("motivo").agg(F.count(F.lit(1)).alias("filas"))
    sides = checked.good.select(F.lit(True).alias("buena")).unionByName(checked.rejects.select(F.lit(False).alias("buena")))
    totals = sides.agg(F.count_if(~F.col("buena")).alias("rechazadas"), F.count_if("buena").alias("aceptadas"), F.count(F.lit(1)).alias("total"))
    listed = totals.unpivot([], ["rechazadas", "aceptadas", "total"], "motivo", "filas")
    return by_reason.unionByName(listed)


def write_lines(lines: DataFrame, path: str) -> None:
    """One text column as a CSV file's lines (for data that is already CSV text)."""
    lines.write.text(path)
