"""Association rules from frequent item sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlab.functions.money import metric, ratio
from basketlab.functions.text_hash import itemset_text
from basketlab.operators.joins import fits_broadcast, hot_keys, lookup_join
from basketlab.schemas import RULE_DEFAULTS

# Default minimum confidence, and where a confidence counts as certain.
MIN_CONFIDENCE = 0.005
CERTAIN = 0.999999


def proper_subsets(items: Column) -> Column:
    """Every non-empty proper subset of an item array, as an array of arrays."""
    def members(mask: Column) -> Column:
        return F.filter(items, lambda _, i: F.getbit(mask, i) == 1)

    last = (F.pow(F.lit(2), F.size(items)) - 2).cast("int")
    return F.transform(F.sequence(F.lit(1), last), lambda m: members(m.cast("long")))


def enumerate_rules(itemsets: DataFrame) -> DataFrame:
    """One row per split of a set of two or more items into antecedent and consequent."""
    sets = itemsets.filter(F.size("items") >= 2).select("items", "support")
    split = sets.withColumn("antecedent", F.explode(proper_subsets(F.col("items"))))
    return split.select("antecedent", F.array_except("items", "antecedent").alias("consequent"), "support")


def extrapolate_support(support: Column, rate: float) -> Column:
    """Support in the whole population, estimated from a sample."""
    return F.ceil(support / F.lit(rate)).cast("long") if 0 < rate < 1 else support


def rule_metrics(rules: DataFrame, n_tickets: int) -> DataFrame:
    """Add confidence, lift, leverage and conviction, not yet rounded.

    Needs ``support``, ``antecedent_support`` and ``consequent_support``.
    """
    share_a = ratio(F.col("antecedent_support"), F.lit(n_tickets))
    share_c = ratio(F.col("consequent_support"), F.lit(n_tickets))
    share_both = ratio(F.col("support"), F.lit(n_tickets))
    confidence = ratio(F.col("support"), F.col("antecedent_support"))
    uncertain = F.nullif(1 - F.col("confidence"), F.lit(0.0))
    return (
        rules.withColumn("relative_support", share_both)
        .withColumn("confidence", confidence)
        .withColumn("lift", F.coalesce(F.col("confidence") / F.nullif(share_c, F.lit(0.0)), F.lit(0.0)))
        .withColumn("leverage", share_both - share_a * share_c)
        .withColumn(
            "conviction",
            F.when(F.col("confidence") < CERTAIN, (1 - share_c) / uncertain).otherwise(RULE_DEFAULTS["conviction"]),
        )
    )


def association_rules(
    itemsets: DataFrame, n_tickets: int, min_confidence: float = MIN_CONFIDENCE, sample_rate: float = 1.0
) -> DataFrame:
    """Rules of all frequent sets whose two sides have a known support.

    ``itemsets`` should be a stored table, as it is read for its sets and its supports.
    """
    rules = (
        enumerate_rules(itemsets)
        .withColumn("antecedent_text", itemset_text(F.col("antecedent")))
        .withColumn("consequent_text", itemset_text(F.col("consequent")))
    )
    known = itemsets.select("itemset_text", "itemset_hash", "support")
    small = fits_broadcast(itemsets)
    sides = ("antecedent", "consequent")
    # Hot sides are looked for on the listed rules, which only unfold the stored sets, before any join.
    hot = {side: None if small else hot_keys(rules, [f"{side}_text"]) for side in sides}
    for side in sides:
        supports = known.toDF(f"{side}_text", f"{side}_hash", f"{side}_support")
        rules = lookup_join(rules, supports, [f"{side}_text"], small=small, hot=hot[side])
        if side == "antecedent":
            # The confidence is known here; weak rules need not reach the second join.
            rules = rules.filter(ratio(F.col("support"), F.col("antecedent_support")) >= min_confidence)
    scored = rule_metrics(rules, n_tickets)
    rounded = ["relative_support", "confidence", "lift", "conviction", "leverage"]
    return scored.select(
        "antecedent", "consequent", "antecedent_text", "consequent_text", "antecedent_hash", "consequent_hash",
        extrapolate_support(F.col("support"), sample_rate).alias("support"),
        *[metric(F.col(c)).alias(c) for c in rounded],
        F.lit(RULE_DEFAULTS["source"]).alias("source"),
    )


RULE_KEYS = ["antecedent_hash", "consequent_hash"]
RULE_UPDATES = ["support", "relative_support", "confidence", "lift", "conviction", "leverage"]
