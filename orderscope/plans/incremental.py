"""Reports kept up to date: a stored table of mergeable measures, and only new orders read.

Every measure of the reports is a count, an exact sum or a limb of one
(``operators.reports.MEASURES``), so the measures of two sets of orders add up
to those of both. A store holds them by group of each report (some hundred
rows), as versions (:mod:`~orderscope.sources.versions`). :func:`apply` reads
one batch of orders, aggregates it in one scan, adds the stored rows, and
publishes measures and all five report files as the next version. Orders that
were counted before are never read again.

A batch has a name. Applying a name that the store holds is refused or, with
``replace=True``, takes the batch's old measures off first: they are kept by
batch, so a corrected batch is replaced without reading any other. Two writers
at a time are told apart by the version number; the later one fails with
``Conflict`` and may apply its batch again.

Stored by batch, measures grow with the number of batches (some hundred rows
each), not with orders; :func:`compact` folds old batches into one row set
that can no longer be replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderscope.operators import reports
from orderscope.session import saved
from orderscope.sources import files, versions

FOLDED = "_folded"          # the name of batches that were folded together

def _rows(grouped: DataFrame, batch: str) -> DataFrame:
    return grouped.select(F.lit(batch).alias("lote"), F.col("_gid").cast("bigint").alias("_gid"), *reports.ALL_KEYS, *reports.BANDS, *reports.MEASURES)


def stored_measures(spark: SparkSession, version: versions.Version) -> DataFrame:
    """Measure rows of a version, by batch."""
    return spark.read.parquet(f"{version.path}/medidas")


def merged(measures: DataFrame) -> DataFrame:
    """Measure rows of all batches added up: what ``reports.grouped_measures`` gives for all their orders."""
    return reports.summed(measures, ["_gid", *reports.ALL_KEYS, *reports.BANDS])


def apply(spark: SparkSession, base: str, batch: str, orders: DataFrame, replace: bool = False,
          min_city_orders: int = reports.DEFAULT_MIN_CITY_ORDERS) -> versions.Version:
    """Add (or replace) one batch of raw orders and publish measures and reports as the next version."""
    if batch == FOLDED:
        raise ValueError(f"{FOLDED} is no batch name")
    before = versions.current(spark, base)
    known = before.notes["lotes"] if before else []
    if batch in known and not replace:
        raise ValueError(f"batch {batch!r} is in version {before.number}")
    new = _rows(reports.grouped_measures(orders), batch)
    if before:
        new = new.unionByName(stored_measures(spark, before).filter(F.col("lote") != batch))
    return _publish(spark, base, new, before, [*[k for k in known if k != batch], batch], min_city_orders)


def compact(spark: SparkSession, base: str, keep: int = 0, min_city_orders: int = reports.DEFAULT_MIN_CITY_ORDERS) -> versions.Version:
    """Fold all batches but the newest ``keep`` into one set of rows; folded batches cannot be replaced any more."""
    before = versions.current(spark, base)
    if before is None:
        raise ValueError(f"nothing stored in {base}")
    names = [k for k in before.notes["lotes"] if k != FOLDED]
    kept = names[max(len(names) - keep, 0):]
    rows = stored_measures(spark, before)
    old = rows.filter(~F.col("lote").isin(kept)) if kept else rows
    new = _rows(merged(old), FOLDED)
    if kept:
        new = new.unionByName(rows.filter(F.col("lote").isin(kept)))
    return _publish(spark, base, new, before, [FOLDED, *kept], min_city_orders)


def _publish(spark: SparkSession, base: str, measures: DataFrame, before: versions.Version | None, names: list[str],
             min_city_orders: int) -> versions.Version:
    folder = versions.new_folder(base)
    path = f"{base.rstrip('/')}/{folder}"
    measures.coalesce(1).write.parquet(f"{path}/medidas")
    done = saved(reports.finished(merged(spark.read.parquet(f"{path}/medidas"))))
    files.write_reports(reports.reports_from_finished(done, min_city_orders), path)
    return versions.publish(spark, base, folder, before, {"lotes": names})
