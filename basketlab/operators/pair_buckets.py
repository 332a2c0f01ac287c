"""Pair counting in two passes: hashed buckets first, then only pairs from buckets that are full enough.

Every occurrence of a pair falls into one bucket, so a bucket holds at least as many
occurrences as any of its pairs. Pairs whose bucket stays below the minimum support cannot
reach it and never enter the exact count; all others are counted exactly. What the second pass
needs of the first is one bit per bucket, so the table to broadcast has a fixed largest
size, whatever the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlab.operators.baskets import (
    BasketGroups,
    count_sets,
    counting_parts,
    frequent_only,
    listing_parts,
    pair_support,
    sizing,
    ticket_pairs,
    ticket_pairs_by_block,
)
from basketlab.operators.staging import stage

#: One bit each, in words of 64: at most 2^20 rows of a bucket table are broadcast, 32 MiB as rows.
MAX_BUCKETS = 1 << 26
LEAST_BUCKETS = 1 << 10
#: Buckets are planned so that unrelated pairs fill one to this part of the minimum.
LOAD = 4


def bucket_number(n_listed: int, min_support: int) -> int | None:
    """Buckets for this many listed pairs, a power of two; None where even the most buckets would all be full."""
    wanted = max(LEAST_BUCKETS, -(-LOAD * n_listed // max(min_support, 1)))
    number = 1 << (wanted - 1).bit_length()
    return number if number <= MAX_BUCKETS else (MAX_BUCKETS if n_listed // MAX_BUCKETS < min_support // 2 else None)


def listed_pairs(baskets: DataFrame) -> int:
    """Number of pairs that the baskets hold, each occurrence counted."""
    sizes = baskets.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = (F.col("n") * (F.col("n") - 1) / 2).cast("decimal(38,0)")
    with sizing(baskets, listing_parts(baskets)):
        return int(sizes.agg(F.coalesce(F.sum(pairs), F.lit(0))).first()[0])


def _bucket(buckets: int) -> Column:
    return F.xxhash64("a", "b").bitwiseAND(F.lit(buckets - 1))


def full_buckets(pairs: DataFrame, buckets: int, least: int) -> DataFrame:
    """(word, bits): a set bit for every bucket that holds at least ``least`` of the listed pairs."""
    counts = pairs.select(_bucket(buckets).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    full = counts.filter(F.col("n") >= least)
    bit = F.expr("shiftleft(1L, cast(bucket & 63 as int))")
    return full.select(F.shiftright("bucket", 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))


def in_full_buckets(pairs: DataFrame, words: DataFrame, buckets: int) -> DataFrame:
    """The listed pairs whose bucket has its bit set."""
    placed = pairs.withColumn("_bucket", _bucket(buckets)).withColumn("word", F.shiftright("_bucket", 6))
    met = placed.join(F.broadcast(words), "word")
    return met.filter(F.getbit("bits", F.col("_bucket").bitwiseAND(F.lit(63))) == 1).select(*pairs.columns)


class Prefilter:
    """The two passes over one set of baskets; ``listed`` and ``kept`` give their pair rows."""

    def __init__(self, baskets: DataFrame, min_support: int, supports: DataFrame | None = None, big_basket: int | None = None):
        self.min_support = min_support
        self.groups = BasketGroups(frequent_only(baskets, min_support, supports), min_support, big_basket, listing_parts(baskets))
        # A pair may hide as many occurrences in baskets set aside as there are such baskets.
        self.least = min_support - self.groups.n_set_aside
        together = self.groups.normal if self.groups.big is None else self.groups.normal.unionByName(
            self.groups.big.select("ticket_id", "item"))
        self.n_listed = listed_pairs(together)
        self.buckets = bucket_number(self.n_listed, self.least) if self.least > 1 else None
        self.words = None
        if self.buckets is not None:
            self.words = stage(full_buckets(self.listed(), self.buckets, self.least), "full_buckets")

    def _keep(self, listing: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        if self.words is None:
            return listing
        return lambda rows: in_full_buckets(listing(rows), self.words, self.buckets)

    def listed(self) -> DataFrame:
        """Every pair of the counted baskets, as the plain count would shuffle it."""
        pairs = ticket_pairs(self.groups.normal).select("a", "b")
        if self.groups.big is not None:
            pairs = pairs.unionByName(ticket_pairs_by_block(self.groups.big).select("a", "b"))
        return pairs

    def kept(self) -> DataFrame:
        """Those of them that enter the exact count."""
        return self._keep(lambda rows: rows)(self.listed())

    def support(self) -> DataFrame:
        return count_sets(
            self.groups, ["a", "b"], self.min_support, self._keep(ticket_pairs), self._keep(ticket_pairs_by_block),
            counting_parts(self.groups))


def prefiltered_pair_support(
    baskets: DataFrame, min_support: int, supports: DataFrame | None = None, big_basket: int | None = None
) -> DataFrame:
    """The result of ``pair_support``, with pairs of buckets below the minimum left out before the shuffle.

    ``baskets`` should be a stored table: its pairs are listed twice. A minimum of 1 keeps every pair, so
    the plain count is used.
    """
    if min_support <= 1:
        return pair_support(baskets, min_support, supports, big_basket)
    return Prefilter(baskets, min_support, supports, big_basket).support()
