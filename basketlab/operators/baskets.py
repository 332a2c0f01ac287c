"""Baskets (distinct items per ticket) and exact support counts of items and pairs.

A basket of n items holds n(n-1)/2 pairs, so huge baskets need care. Counting splits
the baskets into three groups, and every group is counted exactly:

* normal baskets (up to ``big_basket`` items) pair their items in a join on the ticket;
* with a minimum support of m, up to m-1 of the largest baskets are set aside. A pair
  that reaches m must then also occur outside them, so these baskets never list their
  pairs: they only confirm pairs counted elsewhere that can still reach m;
* other big baskets are cut into blocks of items, and each pair of blocks is a join key
  of its own, so one basket spreads over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from decimal import Decimal

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from basketlab.operators.joins import fits_broadcast, hot_keys, lookup_join, spread
from basketlab.operators.staging import scanned_by, shuffled_into, stage

BIG_BASKET = 1_000
MAX_SET_ASIDE = 1_000
#: Measured bytes of baskets whose pairs one task lists: 250,000 (ticket, item) rows of whole numbers.
LISTED_BYTES = 8 << 20
ROW_BYTES = 32
#: Listed pairs that one task counts, about 130 bytes each.
COUNTED_PAIRS = 2_000_000
#: Different triples that one task counts.
COUNTED_TRIPLES = 2_000_000
#: Lines that one task makes distinct, or rows of baskets whose tickets it counts, about 100 bytes each.
GROUPED_ROWS = 2_000_000
#: Bytes of files whose rows one task aggregates before the shuffle: by ticket there are nearly as many groups as rows.
SCANNED_BYTES = 16 << 20


def basket_items(lines: DataFrame, ticket: str = "ticket_id", item: str = "product_id") -> DataFrame:
    """Distinct (ticket, item) pairs of the lines."""
    pairs = lines.select(F.col(ticket).alias("ticket_id"), F.col(item).alias("item"))
    baskets = pairs.filter(F.col("ticket_id").isNotNull() & F.col("item").isNotNull()).distinct()
    baskets.lines = lines
    return baskets


def stage_baskets(baskets: DataFrame, name: str = "baskets", lines: DataFrame | None = None) -> DataFrame:
    """Baskets written once; those of ``basket_items`` are made distinct in parts that follow the number of lines.

    ``lines`` is a table with at least as many rows, where the lines themselves take long to count.
    """
    lines = getattr(baskets, "lines", None) if lines is None else lines
    with scanned_by(baskets.sparkSession, SCANNED_BYTES):
        return stage(baskets, name, 0 if lines is None else math.ceil(lines.count() / GROUPED_ROWS))


def stage_supports(baskets: DataFrame, name: str = "item_support") -> DataFrame:
    """The item supports of staged baskets, written once."""
    with scanned_by(baskets.sparkSession, SCANNED_BYTES):
        return stage(item_support(baskets), name)


def item_support(baskets: DataFrame) -> DataFrame:
    """Number of tickets that hold each item."""
    return baskets.groupBy("item").agg(F.count(F.lit(1)).alias("support"))


def min_pair_support(n_tickets: int, min_rel_support: Decimal | float | str) -> int:
    """Absolute minimum support: the relative one times all tickets, rounded up, at least 1."""
    return max(math.ceil(Decimal(n_tickets) * Decimal(str(min_rel_support))), 1)


def frequent_only(baskets: DataFrame, min_support: int, supports: DataFrame | None = None) -> DataFrame:
    """Baskets without items below the minimum support.

    No pair or larger set with such an item can reach the minimum, so counts of what
    remains do not change. A list too large to broadcast is joined by a shuffle.
    """
    if min_support <= 1:
        return baskets
    counted = item_support(baskets) if supports is None else supports
    frequent = counted.filter(F.col("support") >= min_support).select("item")
    return lookup_join(baskets, frequent, ["item"], "left_semi")


def listing_parts(baskets: DataFrame) -> int:
    """Parts into which staged baskets are shuffled by ticket before sets are listed; 0 leaves other tables where they lie."""
    return math.ceil((getattr(baskets, "measured", None) or 0) / LISTED_BYTES)


@contextmanager
def sizing(baskets: DataFrame, parts: int) -> Iterator[None]:
    """Jobs that run meanwhile count the rows of tickets; of baskets listed in so many parts, a task groups a bounded number."""
    spark = baskets.sparkSession
    rows = parts * LISTED_BYTES // ROW_BYTES
    with scanned_by(spark, SCANNED_BYTES), shuffled_into(spark, math.ceil(rows / GROUPED_ROWS)):
        yield


def counting_parts(groups: BasketGroups) -> int:
    """Parts into which listed pairs are shuffled to be counted."""
    return math.ceil(groups.n_pairs / COUNTED_PAIRS)


class BasketGroups:
    """Baskets split by size for one minimum support (see the module text).

    Normal baskets are shuffled by ticket into ``parts`` (see ``listing_parts``), so that the items a task joins do not grow
    with the table; ``n_pairs`` and ``n_triples`` are the numbers of pairs and triples that normal and big baskets hold.
    """

    def __init__(self, baskets: DataFrame, min_support: int, big_basket: int | None = None, parts: int = 0):
        big_basket = big_basket or BIG_BASKET
        sizes = baskets.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n_items"))
        seen, pairs = Observation(), F.col("n_items").cast("decimal(20,0)") * (F.col("n_items") - 1) / 2
        # Only a number of parts follows from the triples, so a double will do; no basket size overflows it.
        triples = pairs.cast("double") * (F.col("n_items") - 2) / 3
        sizes = sizes.observe(
            seen, F.coalesce(F.sum(pairs), F.lit(0)).cast("decimal(38,0)").alias("pairs"), F.coalesce(F.sum(triples), F.lit(0.0)).alias("triples"))
        large = sizes.filter(F.col("n_items") > big_basket)
        room = min(min_support - 1, MAX_SET_ASIDE)
        with sizing(baskets, parts):
            largest = large.orderBy(F.desc("n_items"), "ticket_id").limit(room + 1).collect()
        aside = largest[:room]
        self.set_aside: DataFrame | None = None
        self.n_set_aside = len(aside)
        self.n_pairs = int(seen.get["pairs"]) - sum(r["n_items"] * (r["n_items"] - 1) // 2 for r in aside)
        self.n_triples = int(seen.get["triples"] - sum(r["n_items"] * (r["n_items"] - 1) * (r["n_items"] - 2) / 6 for r in aside))
        self.big: DataFrame | None = None
        self.normal = baskets
        if aside:
            schema = baskets.select("ticket_id").schema
            ids = baskets.sparkSession.createDataFrame([(r["ticket_id"],) for r in aside], schema)
            self.set_aside = stage(baskets.join(F.broadcast(ids), "ticket_id", "left_semi"), "set_aside")
            self.normal = baskets.join(F.broadcast(ids), "ticket_id", "left_anti")
        if len(largest) > room:
            # Every row stands for more than ``big_basket`` rows of the baskets.
            with sizing(baskets, parts):
                large = stage(large, "large_baskets")
            small = fits_broadcast(large)
            sized = lookup_join(self.normal, large, ["ticket_id"], small=small)
            self.normal = lookup_join(self.normal, large.select("ticket_id"), ["ticket_id"], "left_anti", small=small)
            blocks = F.ceil(F.col("n_items") / big_basket)
            self.big = sized.select(
                "ticket_id", "item", blocks.alias("blocks"), F.pmod(F.xxhash64("item"), blocks).alias("block")
            )
        self.normal = spread(self.normal, ["ticket_id"], parts)


def ticket_pairs(baskets: DataFrame) -> DataFrame:
    """(ticket, a, b) for the items a < b of each basket."""
    left = baskets.select("ticket_id", F.col("item").alias("a"))
    right = baskets.select("ticket_id", F.col("item").alias("b"))
    return left.join(right, "ticket_id").filter(F.col("a") < F.col("b"))


def ticket_pairs_by_block(big: DataFrame) -> DataFrame:
    """The same for big baskets, with every pair of item blocks as a join key of its own."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    placed = big.select("ticket_id", "item", "block", other).select(
        "ticket_id", "item", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    cell = ["ticket_id", "low", "high"]
    left = placed.select(*cell, F.col("item").alias("a"), F.col("block").alias("block_a"))
    right = placed.select(*cell, F.col("item").alias("b"), F.col("block").alias("block_b"))
    # In the cell of two different blocks, pairs inside one block belong to that block's own cell.
    once = (F.col("low") == F.col("high")) | (F.col("block_a") != F.col("block_b"))
    return left.join(right, cell).filter((F.col("a") < F.col("b")) & once).select("ticket_id", "a", "b")


def count_sets(
    groups: BasketGroups, columns: list[str], min_support: int,
    list_normal: Callable[[DataFrame], DataFrame], list_big: Callable[[DataFrame], DataFrame], parts: int = 0,
) -> DataFrame:
    """Sets (item columns) with their exact support, from ``min_support`` up.

    The two functions list the sets of each ticket; partial counts are built before
    the shuffle. Where the counts need more ``parts`` than shuffles have, they are written by a job of that many.
    """
    listed = list_normal(groups.normal).select(*columns)
    if groups.big is not None:
        listed = listed.unionByName(list_big(groups.big).select(*columns))
    counts = listed.groupBy(*columns).agg(F.count(F.lit(1)).alias("support"))
    if parts > int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        counts = stage(counts.filter(F.col("support") >= min_support - groups.n_set_aside), "counted_sets", parts)
    if groups.set_aside is not None:
        counts = _add_set_aside(counts, groups.set_aside, columns, min_support)
    return counts.filter(F.col("support") >= min_support)


def _add_set_aside(counts: DataFrame, set_aside: DataFrame, columns: list[str], min_support: int) -> DataFrame:
    """Add the occurrences in the set-aside baskets to sets that may still reach the minimum."""
    reach = set_aside.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    bounded = counts
    small = fits_broadcast(reach)
    if not small:
        bounded = stage(counts, "set_counts")  # hot items are looked for on a stored table
    hot = {c: None if small else hot_keys(bounded, [c]) for c in columns}
    for c in columns:
        here = reach.select(F.col("item").alias(c), F.col("n").alias(f"reach_{c}"))
        bounded = lookup_join(bounded, here, [c], "left", small=small, hot=hot[c])
    possible = F.least(*[F.coalesce(F.col(f"reach_{c}"), F.lit(0)) for c in columns])
    candidates = bounded.withColumn("possible", possible)
    candidates = candidates.filter(F.col("support") + F.col("possible") >= min_support)
    candidates = stage(candidates.select(*columns, "support", "possible"), "set_candidates")
    hits = candidates.filter(F.col("possible") > 0).select(*columns)
    for i, c in enumerate(columns):
        members = set_aside.select("ticket_id", F.col("item").alias(c))
        hits = lookup_join(hits, members, [c], hot=hot_keys(candidates, [c])) if i == 0 else hits.join(members, ["ticket_id", c])
    extra = hits.groupBy(*columns).agg(F.count(F.lit(1)).alias("extra"))
    total = F.col("support") + F.coalesce(F.col("extra"), F.lit(0))
    return candidates.join(extra, columns, "left").select(*columns, total.alias("support"))


def pair_support(
    baskets: DataFrame, min_support: int = 1, supports: DataFrame | None = None, big_basket: int | None = None
) -> DataFrame:
    """Item pairs a < b with the number of tickets that hold both, from ``min_support`` up.

    ``supports`` are the item supports of ``baskets`` where both are stored tables
    already. Without them the baskets are written first, since they are read three
    times: for item supports, for basket sizes and for the pairs.
    """
    if supports is None:
        baskets = stage_baskets(baskets)
    groups = BasketGroups(frequent_only(baskets, min_support, supports), min_support, big_basket, listing_parts(baskets))
    return count_sets(groups, ["a", "b"], min_support, ticket_pairs, ticket_pairs_by_block, counting_parts(groups))


def contains_all(sets: DataFrame, baskets: DataFrame) -> DataFrame:
    """Support of given item sets (array column ``items``, distinct rows) of any size.

    Each set starts from the tickets of its rarest item, and those tickets are then
    tested for the remaining items. Sets that no ticket holds have support 0. ``sets``
    and ``baskets`` should be stored tables: both are read several times.
    """
    keyed = sets.select("items").withColumn("size", F.size("items"))
    members = keyed.select("items", "size", F.explode("items").alias("item"))
    small = fits_broadcast(members)
    used = lookup_join(baskets, members.select("item").distinct(), ["item"], "left_semi", small=small)
    counted = lookup_join(members, item_support(used), ["item"], "left")
    rarest = counted.groupBy("items", "size").agg(
        F.min_by("item", F.coalesce(F.col("support"), F.lit(0))).alias("item")
    )
    started = lookup_join(used, rarest, ["item"], small=small)
    others = F.explode(F.array_except("items", F.array("item"))).alias("item")
    tests = started.filter(F.col("size") > 1).select("items", "size", "ticket_id", others)
    found = tests.join(used, ["ticket_id", "item"]).groupBy("items", "size", "ticket_id").agg(
        F.count(F.lit(1)).alias("n_found")
    )
    holders = found.filter(F.col("n_found") == F.col("size") - 1).select("items")
    holders = holders.unionByName(started.filter(F.col("size") == 1).select("items"))
    support = holders.groupBy("items").agg(F.count(F.lit(1)).alias("support"))
    return keyed.select("items").join(support, "items", "left").select(
        "items", F.coalesce(F.col("support"), F.lit(0)).alias("support")
    )
