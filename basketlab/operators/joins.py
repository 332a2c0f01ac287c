"""Joins that choose their strategy from measured sizes and split hot keys."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlab.operators.staging import measured_bytes

MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 0.25
HOT_SAMPLE = 0.02
HOT_MIN_ROWS = 20
MIN_SALTS = 8
#: Rows of the large table that one task of a shuffle join sorts.
JOIN_ROWS = 1_000_000


class HotKeys(list):
    """Hot keys, and about how many rows the table has that they were looked for in."""

    rows = 0


def spread(df: DataFrame, on: list[str], parts: int) -> DataFrame:
    """The table shuffled by ``on`` into so many parts; few parts are left to Spark, which keeps its cores busy.

    Left alone, Spark merges shuffled partitions by their compressed bytes or keeps a given number of them, so a task's
    rows would grow with the table.
    """
    return df.repartition(parts, *on) if parts > df.sparkSession.sparkContext.defaultParallelism else df


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    return measured_bytes(df) <= (MAX_BROADCAST_BYTES if max_bytes is None else max_bytes)


def _bounded_join(big: DataFrame, other: DataFrame, on: list[str], how: str, rows: int) -> DataFrame:
    """Shuffle join of which a task takes about ``JOIN_ROWS`` of the large table's ``rows`` at most."""
    parts = math.ceil(rows / JOIN_ROWS)
    usual = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if parts > big.sparkSession.sparkContext.defaultParallelism:
        # As many parts as usual fit a table that is placed by the key already, without another shuffle.
        big, other = spread(big, on, max(parts, usual)), spread(other, on, parts if parts > usual else 0)
    return big.join(other, on, how)


def hot_keys(
    df: DataFrame, on: list[str], fraction: float | None = None,
    sample: float = HOT_SAMPLE, min_rows: int = HOT_MIN_ROWS,
) -> HotKeys:
    """Keys that hold more than ``fraction`` of the sampled rows, and at least ``min_rows`` of them.

    The default fraction is a quarter of an even share per shuffle partition: one such key more or
    less does not unbalance a task. At most ``1 / fraction`` keys can pass, so the list is
    safe on the driver. One scan gives the keys and the total. The sample only steers
    which rows are salted; join results do not depend on it.
    """
    if fraction is None:
        fraction = HOT_SHARE / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(*on) if sample >= 1 else df.select(*on).sample(False, sample, 17)
    counts = rows.groupingSets([[F.col(c) for c in on], []], *on).agg(
        F.count(F.lit(1)).alias("_rows"), F.grouping_id().alias("_total"))
    # The row of the total holds the most rows and comes first.
    listed = counts.orderBy(F.desc("_rows"), F.desc("_total")).limit(math.ceil(1 / fraction) + 1).collect()
    found = HotKeys(Row(**{c: r[c] for c in on}) for r in listed[1:] if r["_rows"] >= min_rows and r["_rows"] > listed[0]["_rows"] * fraction)
    found.rows = int(listed[0]["_rows"] / min(sample, 1)) if listed else 0  # an empty sample has no row of the total
    return found


def salted_join(
    big: DataFrame, other: DataFrame, on: list[str], how: str = "inner",
    hot: list | None = None, salts: int | None = None,
) -> DataFrame:
    """Shuffle join of two large tables whose hot keys are spread over many tasks.

    Rows of ``big`` under a hot key get a salt from their place in their partition, so equal
    rows spread as well; the few rows of ``other`` under that key are repeated once per
    salt. The partition is sorted first: a task that runs again gives its rows the same
    salts. Works for inner, left, left_semi and left_anti joins. ``hot`` passes on keys found
    before, for example on the base table when ``big`` is itself the result of a join. Without them the search
    also tells about how many rows there are, and with that how many parts keep a task's share bounded.
    """
    keys = hot_keys(big, on) if hot is None else hot
    rows = keys.rows if hot is None else 0
    if not keys:
        return _bounded_join(big, other, on, how, rows)
    spark = big.sparkSession
    if salts is None:
        salts = max(MIN_SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    schema = T.StructType([f for c in on for f in big.schema.fields if f.name == c])
    marks = F.broadcast(spark.createDataFrame(keys, schema).withColumn("_hot", F.lit(True)))
    sortable = [f.name for f in big.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    placed = big.sortWithinPartitions(*sortable).withColumn("_row", F.monotonically_increasing_id())
    salted = placed.join(marks, on, "left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod("_row", F.lit(salts))).otherwise(F.lit(0).cast("long")),
    )
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    copies = other.join(marks, on, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0).cast("long"))))
    )
    joined = _bounded_join(salted.drop("_hot", "_row"), copies.drop("_hot"), [*on, "_salt"], how, rows)
    return joined.drop("_salt")


def lookup_join(
    big: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner",
    max_bytes: int | None = None, small: bool | None = None, hot: list | None = None,
) -> DataFrame:
    """Join a large table with a lookup table.

    The lookup is broadcast when its measured size allows it; beyond that the join
    shuffles, with hot keys salted. ``small`` passes on a size check already made.
    """
    if small is None:
        small = fits_broadcast(lookup, max_bytes)
    if small:
        return big.join(F.broadcast(lookup), on, how)
    return salted_join(big, lookup, on, how, hot)
