"""References checked by bitmaps of whole-number keys, so that only buckets with a missing key are looked at row by row.

Keys of both tables become bitmaps before anything is shuffled: a task sends one row per 32,768
neighbouring keys, not one per line. A bucket lacks a parent exactly where the union of both sides
has more bits than the parents alone. Only child rows of such buckets enter the exact anti join,
usually none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.operators.joins import fits_broadcast, lookup_join
from basketlab.operators.quality import missing_parents
from basketlab.operators.staging import stage

#: Parents per bucket below which bitmaps cost more than the keys themselves.
LEAST_KEYS = 64


def key_bitmaps(df: DataFrame, key: str) -> DataFrame:
    """(bucket, keys): a bitmap of the keys in each bucket of 32,768; NULL is no key."""
    value = F.col(key).cast("long")
    return df.filter(value.isNotNull()).groupBy(F.bitmap_bucket_number(value).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("keys"))


def dense_enough(parents: DataFrame) -> bool:
    """Whether the parents' bitmaps hold enough keys each; one row per bucket is counted."""
    row = parents.agg(F.count(F.lit(1)).alias("buckets"), F.coalesce(F.sum(F.bitmap_count("keys")), F.lit(0)).alias("keys")).first()
    return row["keys"] >= LEAST_KEYS * row["buckets"]


def incomplete_buckets(children: DataFrame, parents: DataFrame) -> DataFrame:
    """(bucket, n_missing): buckets of two tables of bitmaps where children have keys that parents lack, and how many."""
    known = parents.select("bucket", "keys", F.bitmap_count("keys").alias("n"))
    both = known.unionByName(children.select("bucket", "keys", F.lit(0).cast("long").alias("n")))
    merged = both.groupBy("bucket").agg(F.bitmap_or_agg("keys").alias("keys"), F.sum("n").alias("n"))
    return merged.select("bucket", (F.bitmap_count("keys") - F.col("n")).alias("n_missing")).filter("n_missing > 0")


def missing_by_bitmaps(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent table does not hold, as ``missing_parents`` gives them; a NULL key is held by none.

    ``key`` is a column of whole numbers. Sparse parent keys take the plain way.
    """
    parents = stage(key_bitmaps(parent, key), "parent_bitmaps")
    if not dense_enough(parents):
        return missing_parents(child, parent, [key], large=True)
    suspects = stage(incomplete_buckets(key_bitmaps(child, key), parents).select("bucket"), "incomplete_buckets")
    small = fits_broadcast(suspects)
    in_suspects = [
        lookup_join(df.withColumn("bucket", F.bitmap_bucket_number(F.col(key).cast("long"))), suspects, ["bucket"], "left_semi", small=small, hot=[])
        for df in (child, parent)
    ]
    possible, known = (df.select(*columns) for df, columns in zip(in_suspects, (child.columns, [key])))
    return missing_parents(possible, known, [key], large=True).unionByName(child.filter(F.col(key).isNull()))


def count_missing(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """One row: the number of such child rows, and of the different keys they have (NULL not counted)."""
    bad = missing_by_bitmaps(child, parent, key)
    return bad.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys"))
