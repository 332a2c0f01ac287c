"""Running sums over a whole table without one task for all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlab.operators.staging import stage


def running_sums(df: DataFrame, order_by: list[Column], sums: dict[str, str]) -> DataFrame:
    """The table with the sum of each column (new name: column) over all rows up to and with this one.

    The order must be unique. Rows are dealt by range and added up inside their range; what the ranges
    before it hold is one row per range.
    """
    ranges = stage(df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id()), "sum_ranges")
    totals = ranges.groupBy("_range").agg(*[F.sum(c).alias(f"_{name}") for name, c in sums.items()])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums])
    inside = Window.partitionBy("_range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranges.join(F.broadcast(offsets), "_range")
    return joined.select(*df.columns, *[(F.sum(c).over(inside) + F.col(f"_{n}")).alias(n) for n, c in sums.items()])
