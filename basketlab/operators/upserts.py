"""Key-matched table changes; each returns the next version of the table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def absent_rows(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key ``old`` does not hold."""
    return new.join(old.select(*keys), keys, "left_anti")


def unique_rows(new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows themselves; reading them fails when a key occurs twice."""
    grouped = new.groupBy(*keys).agg(F.max(F.struct(*[c for c in new.columns if c not in keys] or keys)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    message = F.concat(F.lit(f"repeated key {keys}: "), F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    checked = grouped.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    return checked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in new.columns])


def update_rows(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``old`` with ``columns`` replaced where ``new`` holds the key."""
    fresh = new.select(*keys, F.struct(*columns).alias("_new"))
    joined = old.join(fresh, keys, "left")
    replaced = {
        c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in columns
    }
    return joined.select(*[replaced.get(c, F.col(c)) for c in old.columns])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Insert new keys; for known keys replace ``columns`` (default: the whole row).

    Reading the result fails when ``new`` holds a key twice.
    """
    new = unique_rows(new, keys)
    if columns is None:
        kept = old.join(new.select(*keys), keys, "left_anti").select(*old.columns)
        return kept.unionByName(new.select(*old.columns))
    return update_rows(old, new, keys, columns).unionByName(absent_rows(new, old, keys).select(*old.columns))


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert only rows whose key is unknown; known rows stay untouched."""
    return old.unionByName(absent_rows(new, old, keys).dropDuplicates(keys).select(*old.columns))
