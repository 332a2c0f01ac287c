"""Repeatable ticket samples."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlab.functions import calendar as cal
from basketlab.functions.text_hash import hex_prefix, seeded_fraction, seeded_hash
from basketlab.operators.joins import lookup_join
from basketlab.operators.staging import stage

PREFIX_DIGITS = 4


def tickets_with_season(tickets: DataFrame) -> DataFrame:
    return tickets.select("ticket_id", cal.season(F.to_date("sold_at")).alias("season"))


def stratified_sample(
    tickets: DataFrame, rate: float, seed: int = 42, stratum: str = "season", digits: int = PREFIX_DIGITS
) -> DataFrame:
    """Ticket ids: of each stratum exactly the ``floor(n * rate)`` with the smallest seeded hash.

    Strata are few and huge, so they are not sorted whole. A histogram over hash
    prefixes finds the prefix in which the quota of a stratum is filled; smaller
    prefixes are taken whole, and only the tickets of that one prefix are ranked.
    """
    if rate >= 1:
        return tickets.select("ticket_id")
    digest = seeded_hash(F.col("ticket_id"), seed)
    hashed = tickets.select(stratum, "ticket_id", digest.alias("digest")).withColumn(
        "prefix", hex_prefix(F.col("digest"), digits)
    )
    histogram = hashed.groupBy(stratum, "prefix").agg(F.count(F.lit(1)).alias("n"))
    inside = Window.partitionBy(stratum)
    upto = F.sum("n").over(inside.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    quota = F.floor(F.sum("n").over(inside).cast("decimal(18,0)") * F.lit(Decimal(str(rate))).cast("decimal(12,10)"))
    reached = histogram.select(stratum, "prefix", "n", upto.alias("upto"), quota.cast("long").alias("quota"))
    cut = reached.filter(F.col("upto") > F.col("quota")).groupBy(stratum).agg(
        F.min(F.struct("prefix", (F.col("quota") - F.col("upto") + F.col("n")).alias("take"))).alias("cut")
    )
    # One row per stratum; how many strata there are, the written table knows.
    placed = lookup_join(hashed, stage(cut, "strata_cut"), [stratum])
    whole = placed.filter(F.col("prefix") < F.col("cut.prefix")).select("ticket_id")
    edge = placed.filter(F.col("prefix") == F.col("cut.prefix")).withColumn(
        "rank", F.row_number().over(inside.orderBy("digest", "ticket_id"))
    )
    return whole.unionByName(edge.filter(F.col("rank") <= F.col("cut.take")).select("ticket_id"))


def simple_sample(tickets: DataFrame, rate: float, seed: int = 42) -> DataFrame:
    """Ticket ids whose seeded hash falls below ``rate``; whole tickets, never single lines."""
    return tickets.filter(seeded_fraction(F.col("ticket_id"), seed) < rate).select("ticket_id")
