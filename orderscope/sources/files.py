"""File sources and sinks with explicit schemas.

* raw orders as CSV (header line, ``yyyy-MM-dd HH:mm:ss[.ffffff]`` stamps,
  empty field = null), read under ``RAW_ORDERS`` — inference only on request;
* clean orders as Parquet, partitioned by ``anio`` / ``mes`` so that a year
  or month filter prunes whole folders; the write is rebalanced by the
  partition columns first (adaptive execution splits a hot month over
  several tasks and merges small ones), so each month lands in a few
  large files instead of one file per task and month;
* report tables as small CSV files, one folder per report; a missing report
  reads as an empty table with the full schema.

All writes go through Spark's commit protocol: a task lost with its executor
is retried and only committed output becomes visible. Callers pass fresh
paths (``session.fresh_path``), never a machine-local folder.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from orderscope.schemas import CLEAN_ORDERS, RAW_ORDERS, REPORT_FILES, REPORTS

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# A null is written as an empty field and an empty string as a quoted "" (the
# writer's defaults). Spark's reader maps both to null when its null marker
# is the empty string, so it reads with a marker no text contains: an
# unquoted empty field still becomes null, a quoted "" stays an empty string.
READ_NULL_MARKER = "\u0000"
STAMP_WRITE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"   # lossless; the reader takes both


def read_orders_csv(spark: SparkSession, path: str, infer_schema: bool = False) -> DataFrame:
    """Raw orders from CSV with a header; explicit schema unless asked to infer."""
    reader = spark.read.option("header", True).option("timestampNTZFormat", STAMP_FORMAT) \
        .option("nullValue", READ_NULL_MARKER)
    if infer_schema:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(RAW_ORDERS).csv(path)


def write_orders_csv(orders: DataFrame, path: str) -> None:
    """Raw orders to CSV, written by the executors (one file per task)."""
    orders.write.option("header", True).option("timestampNTZFormat", STAMP_WRITE_FORMAT).csv(path)


def write_clean_parquet(clean: DataFrame, path: str) -> None:
    """Clean orders to Parquet partitioned by year and month."""
    clean.hint("rebalance", "anio", "mes").write.partitionBy("anio", "mes").parquet(path)


def rewrite_clean_months(clean: DataFrame, path: str) -> None:
    """S5 again: replace the months that ``clean`` holds, and no others.

    Spark overwrites only the partitions it writes (dynamic overwrite), after
    all tasks are done: writing a month twice leaves what writing it once does,
    and the files of other months are not touched. A month without rows in
    ``clean`` stays as it was.
    """
    clean.hint("rebalance", "anio", "mes").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("anio", "mes").parquet(path)


def read_clean_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Clean orders back from the partitioned Parquet folder, columns in schema order."""
    df = spark.read.schema(CLEAN_ORDERS).parquet(path)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in CLEAN_ORDERS.fields])


def write_report_csv(report: DataFrame, path: str) -> None:
    """One report table (one row per group) as a single CSV file with a header.

    Report measures are rounded to cents / hundredths when computed, so the
    double columns are written as ``decimal(38,2)``: plain digits
    (``43662572.28``, not ``4.366257228E7``) that read back to the same double.
    Doubles too large for that keep their exponent.
    """
    def text(column: Column) -> Column:
        return F.when(F.abs(column) < 1e36, F.when(F.abs(column) < 1e36, column).cast("decimal(38,2)").cast("string")).otherwise(column.cast("string"))
    cols = [text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name) for f in report.schema.fields]
    report.select(*cols).coalesce(1).write.option("header", True).csv(path)


def report_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{REPORT_FILES[name]}"


def read_report(spark: SparkSession, base: str, name: str) -> DataFrame:
    """S3: one stored report under its schema; missing → empty table, same schema."""
    schema = REPORTS[name]
    try:
        return spark.read.schema(schema).option("header", True).option("nullValue", READ_NULL_MARKER) \
            .csv(report_path(base, name))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc.getCondition() or exc):
            raise
        return spark.createDataFrame([], schema)


def load_reports(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The five stored reports, read lazily."""
    return {name: read_report(spark, base, name) for name in REPORTS}


def write_reports(reports: dict[str, DataFrame], base: str) -> None:
    for name, df in reports.items():
        write_report_csv(df, report_path(base, name))
