"""Frequent item sets up to size three."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from basketlab.functions.money import metric, ratio
from basketlab.functions.text_hash import itemset_hash, itemset_text
from basketlab.operators.baskets import (
    COUNTED_TRIPLES,
    BasketGroups,
    count_sets,
    item_support,
    listing_parts,
    pair_support,
    ticket_pairs,
    ticket_pairs_by_block,
)
from basketlab.operators.joins import HOT_MIN_ROWS, HOT_SHARE, fits_broadcast, hot_keys, lookup_join
from basketlab.operators.running import running_sums


# A basket of n items holds n(n-1)(n-2)/6 triples, so fewer items than for pairs make it big.
BIG_TRIPLE_BASKET = 150
TRIPLE_PARTS = 16


@dataclass(frozen=True)
class LevelLimits:
    """When to go on to sets of three; a limit that is None does not exist."""

    max_size: int = 3
    max_pairs: int | None = None
    max_candidates: int | None = None
    triples_enabled: bool = True


def count_tickets(baskets: DataFrame) -> int:
    """Tickets with at least one item."""
    return baskets.select(F.count_distinct("ticket_id")).first()[0]


def frequent_1(baskets: DataFrame, min_support: int, supports: DataFrame | None = None) -> DataFrame:
    """Single items (a) with their support."""
    counted = item_support(baskets) if supports is None else supports
    return counted.filter(F.col("support") >= min_support).select(F.col("item").alias("a"), "support")


def scaled_support(min_support: int, rate: float) -> int:
    """Minimum support for a sample of the tickets."""
    return min_support if rate >= 1 else max(1, int(min_support * rate))


def frequent_2(baskets: DataFrame, min_support: int, supports: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) with their support."""
    return pair_support(baskets, min_support, supports)


def candidate_count(pairs: DataFrame) -> int:
    """Number of triples that join two pairs on their first item, without building them."""
    fanout = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("d"))
    triples = F.col("d") * (F.col("d") - 1) / 2
    return int(fanout.agg(F.coalesce(F.sum(triples), F.lit(0))).first()[0])


def candidates_3(pairs: DataFrame) -> DataFrame:
    """Triples a < b < c whose three pairs are all frequent.

    Every pair is directed from its item with fewer partners to the other one, and
    triples start from the item both their pairs leave from. An item that pairs with
    everything then starts almost none, and no item starts more than about twice as many
    as there are pairs. ``pairs`` should be a stored table.
    """
    known = pairs.select("a", "b")
    small = fits_broadcast(pairs)
    partners = known.select(F.explode(F.array("a", "b")).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    hot = {side: None if small else hot_keys(known, [side]) for side in ("a", "b")}
    ranked = known
    for side in ("a", "b"):
        ranked = lookup_join(ranked, partners.toDF(side, f"n_{side}"), [side], small=small, hot=hot[side])
    first = F.struct("n_a", "a") < F.struct("n_b", "b")
    directed = ranked.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("start"),
        F.when(first, F.col("b")).otherwise(F.col("a")).alias("end"),
    )
    open_triples = directed.toDF("start", "a").join(directed.toDF("start", "b"), "start").filter(F.col("a") < F.col("b"))
    closed = open_triples.join(F.broadcast(known), ["a", "b"], "left_semi") if small else _closed(open_triples, known, directed)
    items = F.array_sort(F.array("start", "a", "b"))
    return closed.select(*[F.element_at(items, i + 1).alias(c) for i, c in enumerate("abc")])


def _closed(open_triples: DataFrame, known: DataFrame, directed: DataFrame) -> DataFrame:
    """Open triples whose ends are a known pair. Two frequent ends meet many triples, so they are spread by the start.

    Hot ends come from the directed pairs, not from the exploded triples: a pair of ends
    cannot have more triples than either end has pairs directed to it.
    """
    ends = hot_keys(directed, ["end"])
    salts = max(8, int(known.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    if not ends:
        return open_triples.join(known, ["a", "b"], "left_semi")
    listed = F.broadcast(known.sparkSession.createDataFrame(ends, directed.select("end").schema).withColumn("hot", F.lit(True)))

    def marked(rows: DataFrame) -> DataFrame:
        for side in ("a", "b"):
            rows = rows.join(listed.select(F.col("end").alias(side), F.col("hot").alias(f"hot_{side}")), side, "left")
        return rows

    both = F.col("hot_a") & F.col("hot_b")
    zero = F.lit(0).cast("long")
    spread = marked(open_triples).withColumn("_salt", F.when(both, F.pmod(F.xxhash64("start"), F.lit(salts))).otherwise(zero))
    every = F.sequence(zero, F.lit(salts - 1).cast("long"))
    copies = marked(known).select("a", "b", F.explode(F.when(both, every).otherwise(F.array(zero))).alias("_salt"))
    return spread.join(copies, ["a", "b", "_salt"], "left_semi").select("start", "a", "b")


def level_counts(pairs: DataFrame) -> DataFrame:
    """For every support that occurs as a minimum: number of pairs and of candidate triples, in one pass.

    Going down to a support, an item's d pairs become more, and its triples grow from one
    binomial number to the next. These steps are added up by support and then over the supports from the
    largest down.
    """
    steps = pairs.groupBy("a", "support").agg(F.count(F.lit(1)).alias("n"))
    # An item has as many rows here as different supports among its pairs.
    so_far = Window.partitionBy("a").orderBy(F.desc("support"))
    d = F.sum("n").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    grown = steps.withColumn("d", d).withColumn("before", F.col("d") - F.col("n"))
    triples = ((F.col("d") * (F.col("d") - 1) - F.col("before") * (F.col("before") - 1)) / 2).cast("long")
    levels = grown.groupBy("support").agg(F.sum("n").alias("n"), F.sum(triples).alias("triples"))
    summed = running_sums(levels, [F.desc("support")], {"n_pairs": "n", "n_candidates": "triples"})
    return summed.select(F.col("support").alias("min_support"), "n_pairs", "n_candidates")


def decision_of(n_pairs: Column, n_candidates: Column, limits: LevelLimits = LevelLimits()) -> Column:
    """``level_decision`` as an expression over counted pairs and candidates."""
    if limits.max_size < 3 or not limits.triples_enabled:
        return F.lit("triples disabled")
    choice = F.when(n_pairs == 0, "no frequent pairs")
    if limits.max_pairs is not None:
        choice = choice.when(n_pairs > limits.max_pairs, "too many pairs")
    choice = choice.when(n_candidates == 0, "no candidates")
    if limits.max_candidates is not None:
        choice = choice.when(n_candidates > limits.max_candidates, "too many candidates")
    return choice.otherwise("count triples")


def level_decision(pairs: DataFrame, limits: LevelLimits = LevelLimits()) -> str:
    """'count triples', or why sets of three are left out."""
    if limits.max_size < 3 or not limits.triples_enabled:
        return "triples disabled"
    n_pairs = pairs.count()
    if n_pairs == 0:
        return "no frequent pairs"
    if limits.max_pairs is not None and n_pairs > limits.max_pairs:
        return "too many pairs"
    n_candidates = candidate_count(pairs)
    if n_candidates == 0:
        return "no candidates"
    over = limits.max_candidates is not None and n_candidates > limits.max_candidates
    return "too many candidates" if over else "count triples"


def hot_pairs(pairs: DataFrame) -> list[tuple]:
    """Pairs that many tickets hold, by their known support: those that listed rows will heap up on.

    Supports add up to the rows that the pairs list, so a share of them is a share of the rows; no
    join has to be run to find it. At most ``1 / fraction`` pairs can pass.
    """
    fraction = HOT_SHARE / int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = pairs.agg(F.coalesce(F.sum("support"), F.lit(0))).first()[0]
    found = pairs.filter((F.col("support") > total * fraction) & (F.col("support") >= HOT_MIN_ROWS))
    return [(r["a"], r["b"]) for r in found.select("a", "b").collect()]


def frequent_3(baskets: DataFrame, pairs: DataFrame, min_support: int, big_basket: int | None = None) -> DataFrame:
    """Triples (a, b, c) with their support, from ``min_support`` up.

    ``pairs`` are the frequent pairs; both inputs should be stored tables. Triples are built inside each ticket from its
    frequent pairs, so the baskets shuffle once, on the ticket.
    """
    ab = pairs.select("a", "b")
    used = ab.select(F.explode(F.array("a", "b")).alias("item")).distinct()
    small = fits_broadcast(pairs)
    reduced = baskets.join(F.broadcast(used), "item", "left_semi") if small else baskets
    groups = BasketGroups(reduced, min_support, big_basket or BIG_TRIPLE_BASKET, listing_parts(baskets))
    ac = ab.withColumnRenamed("b", "c")
    bc = ab.select(F.col("a").alias("b"), F.col("b").alias("c"))

    hot = [] if small else hot_pairs(pairs)

    def keep(rows: DataFrame, known: DataFrame) -> DataFrame:
        on = known.columns
        return lookup_join(rows, known, on, "left_semi", small=small, hot=[Row(**dict(zip(on, pair))) for pair in hot])

    def list_normal(normal: DataFrame) -> DataFrame:
        held = keep(ticket_pairs(normal), ab)
        third = normal.select("ticket_id", F.col("item").alias("c"))
        triples = held.join(third, "ticket_id").filter(F.col("b") < F.col("c"))
        return keep(keep(triples, ac), bc)

    def list_big(big: DataFrame) -> DataFrame:
        # The second join has the first item in its key, which spreads a big basket, and a
        # part of the second item, which spreads a first item with many partners.
        held = keep(ticket_pairs_by_block(big), ab)
        parts = F.lit(TRIPLE_PARTS)
        left = held.withColumn("_part", F.pmod(F.xxhash64("b"), parts))
        every = F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))
        third = held.select("ticket_id", "a", F.col("b").alias("c"), every.alias("_part"))
        return keep(left.join(third, ["ticket_id", "a", "_part"]).filter(F.col("b") < F.col("c")), bc)

    # Different triples are no more than those listed, nor than two pairs with one first item make.
    parts = math.ceil(min(groups.n_triples, candidate_count(pairs)) / COUNTED_TRIPLES)
    return count_sets(groups, ["a", "b", "c"], min_support, list_normal, list_big, parts)


def frequent_itemsets(levels: list[DataFrame], n_tickets: int) -> DataFrame:
    """All levels as one table of item arrays with text key, hash, size and supports."""
    sets = reduce(
        DataFrame.unionByName,
        [
            level.select(F.array(*[c for c in level.columns if c != "support"]).alias("items"), "support")
            for level in levels
        ],
    )
    return sets.select(
        F.array_sort("items").alias("items"),
        itemset_text(F.col("items")).alias("itemset_text"),
        itemset_hash(F.col("items")).alias("itemset_hash"),
        F.size("items").alias("size"),
        "support",
        metric(ratio(F.col("support"), F.lit(n_tickets))).alias("relative_support"),
    )

