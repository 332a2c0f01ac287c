"""Frequent item sets and rules in one run."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame

from basketlab.operators.baskets import basket_items, min_pair_support, stage_baskets, stage_supports
from basketlab.operators.itemsets import (
    LevelLimits,
    count_tickets,
    frequent_1,
    frequent_2,
    frequent_3,
    frequent_itemsets,
    level_decision,
    scaled_support,
)
from basketlab.operators.joins import salted_join
from basketlab.operators.rules import MIN_CONFIDENCE, association_rules
from basketlab.operators.sampling import simple_sample, stratified_sample, tickets_with_season
from basketlab.operators.staging import stage

# Fixed value: default relative support.
MIN_REL_SUPPORT = Decimal("0.000025")


@dataclass
class MiningResult:
    itemsets: DataFrame
    rules: DataFrame
    n_tickets: int
    min_support: int
    decision: str


def sampled_lines(
    tickets: DataFrame, lines: DataFrame, rate: float, seed: int = 42, by_season: bool = True
) -> DataFrame:
    """Lines of the sampled tickets."""
    if rate >= 1:
        return lines
    chosen = stratified_sample(tickets_with_season(tickets), rate, seed) if by_season else simple_sample(tickets, rate, seed)
    return salted_join(lines, chosen, ["ticket_id"], "left_semi")


def mine(
    tickets: DataFrame, lines: DataFrame, min_rel_support: Decimal | float = MIN_REL_SUPPORT,
    sample_rate: float = 1.0, seed: int = 42, min_confidence: float = MIN_CONFIDENCE,
    limits: LevelLimits = LevelLimits(), baskets: DataFrame | None = None,
) -> MiningResult | None:
    """Frequent sets of one to three products and their rules; None without tickets.

    All tickets are mined unless a ``sample_rate`` below 1 asks for a sample. A limit set in
    ``limits`` that is passed leaves out sets of three; ``decision`` says so. All sizes are counted on the same baskets with the same minimum. Baskets, item
    supports and pairs are read by several later steps, so they are written once. ``baskets`` are those of all
    lines where they are stored already, in buckets of the ticket for example; a sample does not use them.
    """
    n_all = tickets.count()
    if n_all == 0:
        return None
    minimum = scaled_support(min_pair_support(n_all, min_rel_support), sample_rate)
    if baskets is None or sample_rate < 1:
        baskets = stage_baskets(basket_items(sampled_lines(tickets, lines, sample_rate, seed)), lines=lines)
    n_tickets = count_tickets(baskets)
    if n_tickets == 0:
        return None
    supports = stage_supports(baskets)
    pairs = stage(frequent_2(baskets, minimum, supports), "frequent_pairs")
    levels = [frequent_1(baskets, minimum, supports), pairs]
    decision = level_decision(pairs, limits)
    if decision == "count triples":
        levels.append(frequent_3(baskets, pairs, minimum))
    itemsets = stage(frequent_itemsets(levels, n_tickets), "itemsets")
    rules = stage(association_rules(itemsets, n_tickets, min_confidence, sample_rate), "rules")
    return MiningResult(itemsets, rules, n_tickets, minimum, decision)

