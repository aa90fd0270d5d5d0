"""Ranges, ranks and prefix sums over tables too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barograph.session import WorkArea


def ranged(area: WorkArea, df: DataFrame, order: list[Column], name: str, rows_per_range: int = 200_000) -> DataFrame:
    """``df`` cut into ranges of ``order``, numbered by ``_range`` in rising order and written to the shared folder.

    Ranges are cut by Spark's sampled range partitioning, so no value of a leading column gathers its rows in
    one range as long as a later column tells them apart.
    """
    df = area.stage(df, f"{name}-rows")
    ranges = max(8, -(-df.count() // rows_per_range))
    return area.stage(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), name)


def prefix_sums(area: WorkArea, df: DataFrame, group: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """Adds ``_before``, the sum of ``value`` over the rows of the group that stand before the row in ``order``.

    Each task sums one range of one group; what carries over between ranges is one row per group and range.
    """
    groups = [F.col(g) for g in group]
    rows = ranged(area, df, [*[g.asc_nulls_last() for g in groups], *order], name)
    totals = rows.groupBy(*groups, "_range").agg(F.sum(value).alias("_sum"))
    so_far = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[g.alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_sum").over(so_far), F.lit(0)).alias("_carry"),
    )
    within = Window.partitionBy("_range", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = [g.eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    return (
        rows.withColumn("_inside", F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(carried, [F.col("_range") == F.col("_r"), *same])
        .withColumn("_before", F.col("_carry") + F.col("_inside"))
        .drop("_carry", "_inside", "_range", "_r", *[f"_g{i}" for i in range(len(groups))])
    )
