"""Items as bitmaps over tickets: counts of any set of items by intersection, and counts that grow by increments.

One row stands for an item and a word of 64 neighbouring tickets, with a bit for each ticket that holds
the item; words without a bit have no row. So there are never more rows than (ticket, item) pairs, and an
item of most tickets has one row per 64 of them. Bitmaps of several loads merge by OR, so a ticket that
comes again counts once and only the new lines are read after a load. A set's support is the number of
bits left after AND over its items, for sets of any size. The tickets' ids must be whole numbers, dense
ones where possible (``assign_keys`` gives them).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.operators.joins import fits_broadcast, hot_keys, lookup_join
from basketlab.operators.staging import measured_bytes, stage

PLACE = ["item", "word"]
#: Words of a bucket: 32,768 tickets, as many as ``bitmap_and_agg`` takes at once.
BUCKET_WORDS = 512
#: Words with a bit per item and bucket from which whole buckets are intersected.
DENSE_WORDS = 64
#: Sets that meet a bucket's bitmaps together, and meetings per task: each member of a set is a row of 4 KB.
SETS_AT_ONCE = 500
MEETINGS_PER_TASK = 16
#: Members of sets that one broadcast may hold, in bytes.
MEMBER_BYTES = 64 << 20


def ticket_bitmaps(lines: DataFrame, ticket: str = "ticket_id", item: str = "product_id") -> DataFrame:
    """(item, word, bits): the tickets of each item in the lines; repeated lines count once."""
    rows = lines.select(F.col(ticket).cast("long").alias("ticket"), F.col(item).alias("item"))
    rows = rows.filter(F.col("ticket").isNotNull() & F.col("item").isNotNull())
    bit = F.expr("shiftleft(1L, cast(ticket & 63 as int))")
    # Bits are set before the shuffle, so an item on every line sends one row per task and 64 tickets.
    return rows.groupBy("item", F.shiftright("ticket", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def merge_bitmaps(*parts: DataFrame) -> DataFrame:
    """Bitmaps of several loads as those of all their lines."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy(*PLACE).agg(F.bit_or("bits").alias("bits"))


def bitmap_supports(bitmaps: DataFrame) -> DataFrame:
    """Number of tickets that hold each item."""
    return bitmaps.groupBy("item").agg(F.sum(F.bit_count("bits")).alias("support"))


def bitmap_basket_counts(bitmaps: DataFrame) -> DataFrame:
    """One row: tickets with an item, (ticket, item) pairs and items per ticket (0 without tickets)."""
    tickets = bitmaps.groupBy("word").agg(F.bit_or("bits").alias("bits"), F.sum(F.bit_count("bits")).alias("pairs"))
    counted = tickets.agg(
        F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("n_tickets"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("n_pairs"))
    mean = F.when(F.col("n_tickets") > 0, F.col("n_pairs") / F.nullif("n_tickets", F.lit(0))).otherwise(0.0)
    return counted.withColumn("avg_items", mean)


def bucket_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """(item, bucket, tickets): the words of a bucket side by side as one binary value, absent ones as zeros."""
    place = F.col("word").bitwiseAND(F.lit(BUCKET_WORDS - 1))
    placed = bitmaps.select(
        "item", F.shiftright("word", BUCKET_WORDS.bit_length() - 1).alias("bucket"), F.struct(place.alias("place"), F.hex("bits").alias("digits")).alias("word"))
    gathered = placed.groupBy("item", "bucket").agg(F.map_from_entries(F.collect_list("word")).alias("words"))
    digits = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(BUCKET_WORDS - 1).cast("long")),
        lambda i: F.lpad(F.coalesce(F.element_at("words", i), F.lit("0")), 16, "0"))
    return gathered.select("item", "bucket", F.unhex(F.array_join(digits, "")).alias("tickets"))


def _by_words(members: DataFrame, used: DataFrame, small: bool) -> DataFrame:
    """(items, support) of sets that a ticket holds: each set meets the words of its items."""
    # An item may belong to most sets: without a broadcast its members are spread over salts.
    met = used.join(F.broadcast(members), "item") if small else lookup_join(
        members, used, ["item"], small=False, hot=hot_keys(stage(members, "set_members"), ["item"]))
    common = met.groupBy("items", "size", "word").agg(F.bit_and("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
    whole = common.filter(F.col("n") == F.col("size"))
    return whole.groupBy("items").agg(F.sum(F.bit_count("bits")).alias("support"))


def _by_buckets(members: DataFrame, used: DataFrame, n_sets: int) -> DataFrame:
    """The same by whole buckets: a slice of the sets meets a bucket in one task, so only counts are shuffled afterwards."""
    n_slices = max(1, math.ceil(n_sets / SETS_AT_ONCE))
    members = stage(members.withColumn("slice", F.pmod(F.xxhash64("items"), F.lit(n_slices))), "set_members")
    passes = max(1, math.ceil(measured_bytes(members) / MEMBER_BYTES))
    wide = stage(bucket_bitmaps(used), "bucket_bitmaps")
    n_meetings = wide.agg(F.count_distinct("bucket")).first()[0] * math.ceil(n_slices / passes)
    parts = max(1, math.ceil(n_meetings / MEETINGS_PER_TASK))
    supports = []
    for k in range(passes):
        here = members.filter(F.pmod("slice", F.lit(passes)) == k)
        slices = here.select("item", "slice").distinct()
        placed = lookup_join(wide, slices, ["item"], small=True).repartition(parts, "bucket", "slice")
        met = placed.join(F.broadcast(here), ["item", "slice"])
        common = met.groupBy("bucket", "slice", "items", "size").agg(
            F.bitmap_and_agg("tickets").alias("tickets"), F.count(F.lit(1)).alias("n"))
        whole = common.filter(F.col("n") == F.col("size"))
        supports.append(whole.groupBy("items").agg(F.sum(F.bitmap_count("tickets")).alias("support")))
    found = supports[0]
    for more in supports[1:]:
        found = found.unionByName(more)
    return found


def contains_all_by_bitmaps(sets: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Support of given item sets (array column ``items``, distinct rows) of any size, from one item up.

    Sets that no ticket holds have support 0. Both inputs should be stored tables. Bitmaps of items in no
    set are dropped first. Items that many tickets hold are then put together to whole buckets of tickets,
    which the sets meet in slices; rarer ones meet word by word.
    """
    keyed = sets.select("items", F.size("items").alias("size"))
    members = keyed.select("items", "size", F.explode("items").alias("item"))
    small = fits_broadcast(members)
    used = stage(lookup_join(bitmaps, members.select("item").distinct(), ["item"], "left_semi", small=small), "used_bitmaps")
    bucket = F.shiftright("word", BUCKET_WORDS.bit_length() - 1)
    n_places = used.select("item", bucket.alias("bucket")).distinct().count()
    dense = used.count() >= DENSE_WORDS * n_places > 0
    support = _by_buckets(members, used, keyed.count()) if dense else _by_words(members, used, small)
    return keyed.select("items").join(support, "items", "left").select(
        "items", F.coalesce(F.col("support"), F.lit(0)).alias("support"))
