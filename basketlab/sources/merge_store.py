"""Stored tables that take upserts: rows lie in folders by a hash of their key, and a merge rewrites only those it touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.operators.staging import stage
from basketlab.operators.upserts import insert_ignore, unique_rows, upsert

PART = "key_part"


def key_part(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def create_store(df: DataFrame, path: str, keys: list[str], parts: int) -> None:
    """Write a table below ``parts`` folders. Every later merge must use the same keys and number."""
    placed = df.withColumn(PART, key_part(keys, parts))
    placed.repartition(parts, PART).write.mode("overwrite").partitionBy(PART).parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


def store_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def create_or_merge(new: DataFrame, path: str, keys: list[str], parts: int, columns: list[str] | None = None) -> None:
    """The first version of a store, or its next one."""
    if store_exists(new.sparkSession, path):
        merge_store(new, path, keys, parts, columns)
    else:
        create_store(unique_rows(new, keys), path, keys, parts)


def merge_store(
    new: DataFrame, path: str, keys: list[str], parts: int, columns: list[str] | None = None, ignore_known: bool = False
) -> int:
    """Upsert ``new`` into the table at ``path``; gives the number of folders that were rewritten.

    Only folders that a new key falls into are read and rewritten. Their next version
    is written down first and then replaces them folder by folder, so a merge that failed is repaired
    by the same merge again, and one that is repeated changes nothing. A key that occurs twice in
    ``new`` stops the merge before the table is touched. With ``ignore_known`` known rows stay as they are.
    One merge at a time: there is no lock.
    """
    spark = new.sparkSession
    fresh = stage(new.withColumn(PART, key_part(keys, parts)), "merge_rows")
    touched = [r[PART] for r in fresh.select(PART).distinct().collect()]  # at most ``parts`` numbers
    if not touched:
        return 0
    # An IN list of folder names, so other folders are not even listed as files to read.
    old = spark.read.parquet(path).filter(F.col(PART).isin(touched))
    if ignore_known:
        merged = insert_ignore(old, fresh.select(*old.columns), keys)
    else:
        # The folder follows from the key, so it is the same on both sides.
        merged = upsert(old, fresh.select(*old.columns), keys, columns)
    merged = stage(merged, "merged_rows")
    merged.repartition(len(touched), PART).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    return len(touched)
