"""The batch job: clean once, store, and write all five reports.

Stages and what each costs on a large cluster:

1. The raw rows are stored once as Parquet in the shared folder, so the join
   (or CSV parse) that makes them runs once. The same write observes the row
   counts and the rating mean (``DataFrame.observe``), so the statistics need no
   scan. Everything after reads those files, with pushed filters and only the
   columns it needs.
2. One pass over them filters, fills, derives and writes the clean table
   partitioned by year and month.
3. The clean table is read back from storage. One scan of it computes the
   measures of all five reports, a few dozen rows, which are checkpointed;
   the five reports are derived from those and each written as one small CSV.
4. Clean table and reports are published together as a version of the output
   folder (``sources.versions``): a reader sees all of a run or nothing of it.

A lost executor costs a re-read of committed files, not a re-run of earlier
stages. Intermediate tables are released when the driver ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderscope.operators.clean import clean_orders, conform, profile_columns
from orderscope.operators.reports import DEFAULT_MIN_CITY_ORDERS, finished, grouped_measures, reports_from_finished
from orderscope.schemas import RAW_ORDERS
from orderscope.session import fresh_path, saved
from orderscope.sources import versions
from orderscope.sources.files import load_reports, read_clean_parquet, write_clean_parquet, write_reports


def stage_raw(raw: DataFrame) -> DataFrame:
    """The raw rows, stored once and read back."""
    path = fresh_path(raw.sparkSession, "raw-orders")
    conform(raw).write.parquet(path)
    return raw.sparkSession.read.schema(RAW_ORDERS).parquet(path)


def stage_profiled(raw: DataFrame) -> tuple[DataFrame, dict[str, float | int | None]]:
    """The raw rows, stored once, and their profile, observed by the write that stores them."""
    path = fresh_path(raw.sparkSession, "raw-orders")
    seen = Observation()
    conform(raw).observe(seen, *profile_columns()).write.parquet(path)
    return raw.sparkSession.read.schema(RAW_ORDERS).parquet(path), seen.get


def clean_to_parquet(raw: DataFrame, path: str) -> dict[str, float | int | None]:
    """Store and profile the raw input in one pass, then write the clean table with the profiled mean as fill."""
    staged, stats = stage_profiled(raw)
    fill = F.lit(stats["calificacion_media"]).cast("double")
    write_clean_parquet(clean_orders(staged, rating_fill=fill), path)
    return stats


def run_pipeline(spark: SparkSession, raw: DataFrame, out_base: str | None = None,
                 min_city_orders: int = DEFAULT_MIN_CITY_ORDERS) -> dict[str, str]:
    """Run cleaning and reporting as the next version of ``out_base``; return the folders written."""
    base = (out_base or fresh_path(spark, "pipeline")).rstrip("/")
    before = versions.current(spark, base)
    folder = versions.new_folder(base)
    clean_path = f"{base}/{folder}/clean"
    stats = clean_to_parquet(raw, clean_path)
    clean = read_clean_parquet(spark, clean_path)
    done = saved(finished(grouped_measures(clean)))
    write_reports(reports_from_finished(done, min_city_orders), f"{base}/{folder}")
    published = versions.publish(spark, base, folder, before, {"perfil": stats})
    return {"clean": clean_path, "reports": published.path, "base": base}


def stored_reports(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The reports a pipeline run wrote, read back under their schemas."""
    return load_reports(spark, paths["reports"])


def current_reports(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The five reports of the newest published run, all of one run; empty tables before the first."""
    version = versions.current(spark, base)
    return load_reports(spark, version.path if version else base)


def generate_raw_csv(spark: SparkSession, ids: DataFrame, path: str) -> str:
    """Generate synthetic orders for ``ids`` and store them as raw CSV (executors write)."""
    from orderscope.operators.generate import generate_orders
    from orderscope.sources.files import write_orders_csv
    write_orders_csv(generate_orders(ids), path)
    return path


def main(argv: list[str] | None = None) -> None:
    """Command line: generate orders, store them as CSV, clean, report.

    ``python -m orderscope.plans.batch --rows 500000`` or
    ``--ids-from /root/testdata/sf0.1`` (one order per row of its ``orders``
    table); ``--csv PATH`` skips generation and cleans an existing CSV.
    """
    import argparse
    import json

    from orderscope.operators.generate import order_ids
    from orderscope.session import get_session
    from orderscope.sources.files import read_orders_csv

    parser = argparse.ArgumentParser(prog="python -m orderscope.plans.batch")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--rows", type=int, help="generate orders with ids 1..N")
    source.add_argument("--ids-from", help="generate one order per row of <dir>/orders.parquet")
    source.add_argument("--csv", help="clean and report an existing raw-order CSV")
    parser.add_argument("--out", help="output folder (default: a fresh folder under spark.checkpoint.dir)")
    parser.add_argument("--min-city-orders", type=int, default=DEFAULT_MIN_CITY_ORDERS)
    args = parser.parse_args(argv)

    spark = get_session(app_name="orderscope-batch")
    base = (args.out or fresh_path(spark, "batch", keep=True)).rstrip("/")
    if args.csv:
        raw_path = args.csv
    else:
        if args.rows is not None:
            ids = spark.range(1, args.rows + 1).withColumnRenamed("id", "orden_id")
        else:
            ids = order_ids(spark, args.ids_from)
        raw_path = generate_raw_csv(spark, ids, f"{base}/raw")
    paths = run_pipeline(spark, read_orders_csv(spark, raw_path), base, args.min_city_orders)
    summary = {"raw": raw_path, **paths}
    for name, df in stored_reports(spark, paths).items():
        summary[f"rows_{name}"] = df.count()
    print(json.dumps(summary))


if __name__ == "__main__":
    main()
