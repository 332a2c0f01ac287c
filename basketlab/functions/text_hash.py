"""Hash columns: stable itemset keys and seeded pseudo-random numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def itemset_text(items: Column) -> Column:
    """Ascending compact JSON list of an item array, e.g. ``[3,7,12]``."""
    return F.to_json(F.array_sort(items))


def itemset_hash(items: Column) -> Column:
    """MD5 of the itemset text."""
    return F.md5(itemset_text(items))


def item_hash(item: Column) -> Column:
    """MD5 of the one-item set that holds ``item``."""
    return F.md5(F.concat(F.lit("["), item.cast("string"), F.lit("]")))


def seeded_hash(key: Column, seed: int) -> Column:
    """Repeatable hex digest of a key: a random order that survives task retries."""
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def hex_prefix(digest: Column, digits: int) -> Column:
    """First hex digits of a digest as a whole number."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def seeded_fraction(key: Column, seed: int) -> Column:
    """Repeatable number in [0, 1) per key."""
    return hex_prefix(seeded_hash(key, seed), 8) / F.lit(float(16**8))
