"""Places in a total order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderscope.session import saved


def numbered(df: DataFrame, *order: Column | str, label: str = "rank") -> DataFrame:
    """Add each row's place (from 0) in a total order.

    A range-partitioned sort, its partition and row-in-partition numbers
    (saved, so that both uses see the same rows), and the running sum of the
    per-partition counts: as many rows as there are partitions.
    """
    ordered = saved(df.sort(*order).withColumn("at_", F.monotonically_increasing_id()))
    part = F.shiftright("at_", 33)
    counts = ordered.groupBy(part.alias("part_")).agg(F.count(F.lit(1)).alias("n_"))
    earlier = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part_", F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("before_"))
    return ordered.withColumn("part_", part).join(F.broadcast(starts), "part_") \
        .withColumn(label, F.col("before_") + F.col("at_").bitwiseAND((1 << 33) - 1)) \
        .drop("at_", "part_", "before_")


def numbered_in_groups(df: DataFrame, is_first: Column, *order: Column | str, label: str = "rank") -> DataFrame:
    """Add each row's place (from 0) in its group, for rows that ``order`` puts group after group.

    ``is_first`` marks the first row of each group in that order. A group may
    reach over many of the range partitions of the sort: within a partition a
    row's group begins at the last first row at or before it, and where there is
    none, at the last one of the partitions before, which is carried over with
    the counts (a row for each partition). So no join or shuffle goes by group,
    and a group with half of all rows is spread like any others.
    """
    ordered = saved(df.withColumn("first_", is_first).sort(*order).withColumn("at_", F.monotonically_increasing_id()))
    part, row = F.shiftright("at_", 33), F.col("at_").bitwiseAND((1 << 33) - 1)
    counts = ordered.groupBy(part.alias("part_")).agg(F.count(F.lit(1)).alias("n_"), F.max(F.when(F.col("first_"), row)).alias("last_"))
    earlier = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part_", F.coalesce(F.sum("n_").over(earlier), F.lit(0)).alias("before_"), "last_") \
        .select("part_", "before_", F.max(F.col("before_") + F.col("last_")).over(earlier).alias("carried_"))
    so_far = Window.partitionBy("part_").orderBy("at_").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ordered.withColumns({"part_": part, "row_": row}) \
        .withColumn("start_", F.max(F.when(F.col("first_"), F.col("row_"))).over(so_far)) \
        .join(F.broadcast(starts), "part_") \
        .withColumn(label, F.col("before_") + F.col("row_") - F.coalesce(F.col("before_") + F.col("start_"), F.col("carried_"))) \
        .drop("first_", "at_", "part_", "row_", "start_", "before_", "carried_")
