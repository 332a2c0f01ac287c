"""Lines, tickets and baskets kept in buckets of the ticket, so that later runs join and group them without a shuffle.

A bucket holds whole tickets. A ticket with a large share of all lines would fill one bucket
alone, so the lines of such tickets stay in a plain table of their own; their few headers are
broadcast to them. A basket is at most as long as the list of products and stays in its bucket.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.operators.baskets import basket_items
from basketlab.operators.joins import fits_broadcast, hot_keys, lookup_join
from basketlab.operators.staging import measured_bytes, stage
from basketlab.operators.star import fact_sales
from basketlab.sources.tables import save_bucketed

KEY = "ticket_id"
BUCKET_BYTES = 256 << 20
PARTS = ("lines", "tickets", "baskets")


@dataclass(frozen=True)
class TicketStore:
    """``lines`` are those of all tickets but the hot ones, whose lines are ``hot_lines`` and headers ``hot_tickets``."""

    lines: DataFrame
    tickets: DataFrame
    baskets: DataFrame
    hot_lines: DataFrame
    hot_tickets: DataFrame
    prefix: str
    buckets: int


def bucket_count(lines: DataFrame) -> int:
    """Buckets of a bounded size for the measured lines, at least one per shuffle partition."""
    partitions = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, math.ceil(measured_bytes(lines) / BUCKET_BYTES))


def _save(df: DataFrame, name: str, path: str, buckets: int) -> None:
    # One writer per bucket: a single file each, which keeps its rows together and sorted.
    save_bucketed(df.repartition(buckets, KEY), name, path, [KEY], buckets)


def store_by_ticket(
    lines: DataFrame, tickets: DataFrame, folder: str, prefix: str, buckets: int | None = None
) -> TicketStore:
    """Write the tables ``prefix_lines``, ``prefix_tickets`` and ``prefix_baskets``, and the hot lines, below ``folder``.

    ``lines`` should be a stored table. A second call with the same names replaces them.
    """
    spark = lines.sparkSession
    buckets = buckets or bucket_count(lines)
    hot = hot_keys(lines, [KEY], fraction=1 / buckets)
    marked = F.broadcast(spark.createDataFrame(hot, lines.select(KEY).schema))
    plain = lines.join(marked, KEY, "left_anti") if hot else lines
    _save(plain.select(*lines.columns), f"{prefix}_lines", f"{folder}/{prefix}_lines", buckets)
    _save(tickets, f"{prefix}_tickets", f"{folder}/{prefix}_tickets", buckets)
    for name, df in (("hot_lines", lines), ("hot_tickets", tickets)):
        aside = df.join(marked, KEY, "left_semi") if hot else df.filter(F.lit(False))
        aside.select(*df.columns).write.mode("overwrite").parquet(f"{folder}/{prefix}_{name}")
    store = open_store(spark, folder, prefix, buckets, baskets=False)
    _save(basket_items(store.lines).unionByName(basket_items(store.hot_lines)), f"{prefix}_baskets", f"{folder}/{prefix}_baskets", buckets)
    return open_store(spark, folder, prefix, buckets)


def open_store(spark: SparkSession, folder: str, prefix: str, buckets: int, baskets: bool = True) -> TicketStore:
    """A store written before, in this session or an earlier one of the same catalog."""
    lines, tickets = spark.table(f"{prefix}_lines"), spark.table(f"{prefix}_tickets")
    aside = [spark.read.schema(df.schema).parquet(f"{folder}/{prefix}_{n}") for n, df in (("hot_lines", lines), ("hot_tickets", tickets))]
    listed = spark.table(f"{prefix}_baskets") if baskets else lines
    return TicketStore(lines, tickets, listed, *aside, prefix, buckets)


def forget_store(spark: SparkSession, prefix: str) -> None:
    """Take the store's names out of the catalog; frames read from it before go on working, its files stay."""
    for part in PARTS:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{part}")


def stored_facts(store: TicketStore, products: DataFrame) -> DataFrame:
    """Facts of all lines of the store; lines and tickets meet inside their buckets."""
    facts = fact_sales(store.lines, store.tickets, products, hot=[])
    # There are at most as many hot tickets as buckets, so their headers are few.
    return facts.unionByName(fact_sales(store.hot_lines, F.broadcast(store.hot_tickets), products, hot=[]))


def stored_baskets(store: TicketStore, products: DataFrame) -> DataFrame:
    """Baskets of the lines that become facts: known tickets and products only, still in their buckets."""
    known = stage(products.select(F.col("product_id").alias("item")).distinct(), "known_products")
    listed = store.baskets.join(store.tickets.select(KEY), KEY, "left_semi")
    small = fits_broadcast(known)
    hot = None if small else hot_keys(store.baskets, ["item"])
    return lookup_join(listed, known, ["item"], "left_semi", small=small, hot=hot).select(KEY, "item")
