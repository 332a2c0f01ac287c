"""Dense surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlab.operators.staging import stage


def assign_keys(df: DataFrame, key: str, order_by: list[str], start: int = 1) -> DataFrame:
    """Number rows from ``start`` in the order of ``order_by``, which must be unique.

    Rows are range-partitioned and numbered inside their range; one offset per range
    makes the numbers dense. No task sees more than its range.
    """
    ranges = df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id())
    ranges = stage(ranges, "key_ranges")
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per shuffle partition, so this window and the broadcast stay small.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order_by))
    return (
        ranges.join(F.broadcast(offsets), "_range")
        .withColumn(key, (inside + F.col("_before") + (start - 1)).cast("long"))
        .select(key, *df.columns)
    )
