"""Pair metrics and the insights derived from them."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal, localcontext
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlab.functions.money import buyers_message, metric, ratio, ticket_message
from basketlab.functions.text_hash import item_hash
from basketlab.operators.baskets import pair_support
from basketlab.operators.joins import fits_broadcast, hot_keys, lookup_join
from basketlab.operators.staging import stage

# Thresholds, limits and labels of the analyses.
MIN_CATEGORY_SUPPORT = 5
FEW_CATEGORIES = 100  # a ticket of all of them lists 4,950 pairs
HIGH_SHARE, HIGH_LABEL = Decimal("0.01"), "Alta"
MEDIUM_SHARE, MEDIUM_LABEL = Decimal("0.005"), "Media"
LOW_LABEL = "Baja"
PEAK_SEASON = "General"
MIN_CONFIDENCE = 0.20
MIN_LIFT = 1.5
RECOMMENDATION_KIND, RECOMMENDATION_SOURCE = "Market Basket", "MBA"
ANOMALY_KIND, ANOMALY_SIGMAS = "Valor_Extremo", 2.5
BUNDLE_KIND, BUNDLE_PREFIX, BUNDLE_LIMIT = "Producto_Cross", "Bundle_", 100
BASKET_WINS, RULES_WIN = "MBA", "APRIORI"

# Exact decimal forms of stored metrics; lift x price sum x confidence still fits 38 digits.
_CONFIDENCE = "decimal(7,6)"
_LIFT = "decimal(18,6)"
_TOTAL = "decimal(20,2)"
# Cents of a total are cut here into two parts of at most ten digits.
HALF = 10**10


def pair_limit_guard(pairs: DataFrame, limit: int | None = None) -> str:
    """'ok', 'no pairs', or, with a limit of the caller's, 'too many pairs'. The pairs stay as they are."""
    if pairs.isEmpty():
        return "no pairs"
    return "too many pairs" if limit is not None and pairs.limit(limit + 1).count() > limit else "ok"


def limit_status(n_pairs: Column, limit: int | None = None) -> Column:
    """``pair_limit_guard`` as an expression over counted pairs."""
    status = F.when(n_pairs == 0, "no pairs")
    return (status if limit is None else status.when(n_pairs > limit, "too many pairs")).otherwise("ok")


def _join_sides(
    pairs: DataFrame, sides: tuple[str, str], lookup: DataFrame, side_of: Callable[[str], DataFrame]
) -> DataFrame:
    """Join a lookup table to both sides of pairs; ``side_of`` renames it for one side.

    Size and hot keys are measured on the inputs, before the first join.
    """
    small = fits_broadcast(lookup)
    hot = {side: None if small else hot_keys(pairs, [side]) for side in sides}
    for side in sides:
        pairs = lookup_join(pairs, side_of(side), [side], small=small, hot=hot[side])
    return pairs


def pair_metrics(pairs: DataFrame, supports: DataFrame, products: DataFrame, n_tickets: int) -> DataFrame:
    """Confidence in both directions, lift and jaccard of item pairs.

    ``supports`` are ticket counts per item, ``products`` give the category of an item
    (``product_id``, ``category``).
    """
    item = stage(products.select(F.col("product_id").alias("item"), "category").join(supports, "item"), "item_facts")
    joined = _join_sides(
        pairs.withColumnRenamed("support", "n"), ("a", "b"), item,
        lambda side: item.toDF(side, f"category_{side}", f"support_{side}"),
    )
    n, sa, sb = F.col("n"), F.col("support_a"), F.col("support_b")
    together = n.cast("double") * F.lit(float(n_tickets))
    apart = F.nullif(sa.cast("double") * sb.cast("double"), F.lit(0.0))
    return joined.select(
        F.col("a").alias("product_a"),
        F.col("b").alias("product_b"),
        item_hash(F.col("a")).alias("hash_a"),
        item_hash(F.col("b")).alias("hash_b"),
        n.alias("support"),
        "support_a",
        "support_b",
        metric(ratio(n, sa)).alias("confidence_ab"),
        metric(ratio(n, sb)).alias("confidence_ba"),
        metric(together / apart).alias("lift"),
        metric(ratio(n, sa + sb - n)).alias("jaccard"),
        "category_a",
        "category_b",
    )


def priority_band(support: Column, n_tickets: int) -> Column:
    """Band of a count by its share of all tickets."""
    high, medium = Decimal(n_tickets) * HIGH_SHARE, Decimal(n_tickets) * MEDIUM_SHARE
    return F.when(support >= F.lit(high), HIGH_LABEL).when(support >= F.lit(medium), MEDIUM_LABEL).otherwise(LOW_LABEL)


def ticket_categories(lines: DataFrame, products: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Distinct categories per ticket, as baskets.

    ``ignore_case`` also ignores accents: spellings of a category that differ only in
    these count as one, shown in its smallest spelling.
    """
    named = products.select("product_id", "category")
    if ignore_case:
        folded = F.collate("category", "UNICODE_CI_AI")
        shown = named.groupBy(folded.alias("_folded")).agg(F.min("category").alias("_shown"))
        named = named.withColumn("_folded", folded).join(shown, "_folded").select(
            "product_id", F.col("_shown").alias("category")
        )
    joined = lookup_join(lines.select("ticket_id", "product_id"), named, ["product_id"])
    return joined.select("ticket_id", F.col("category").alias("item")).filter(
        F.col("ticket_id").isNotNull() & F.col("item").isNotNull()).distinct()


def _pairs_of_few(categories: DataFrame, min_support: int) -> DataFrame:
    """Pair counts where a ticket can hold few categories: listed per ticket, with one shuffle before the counts."""
    held = categories.groupBy("ticket_id").agg(F.array_sort(F.collect_set("item")).alias("items"))
    listed = F.transform("items", lambda a, i: F.transform(
        F.slice("items", i + 2, F.size("items")), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    pairs = held.select(F.explode(F.flatten(listed)).alias("pair")).select("pair.a", "pair.b")
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("support")).filter(F.col("support") >= min_support)


def category_pairs(
    lines: DataFrame, products: DataFrame, n_tickets: int,
    min_support: int = MIN_CATEGORY_SUPPORT, ignore_case: bool = False,
) -> DataFrame:
    """Category pairs bought together, with their share of all tickets and a priority."""
    categories = ticket_categories(lines, products, ignore_case)
    few = products.select("category").distinct().limit(FEW_CATEGORIES + 1).count() <= FEW_CATEGORIES
    pairs = _pairs_of_few(categories, min_support) if few else pair_support(categories, min_support)
    return pairs.select(
        F.col("a").alias("category_a"),
        F.col("b").alias("category_b"),
        "support",
        F.lit(n_tickets).cast("long").alias("n_tickets"),
        metric(ratio(F.col("support"), F.lit(n_tickets))).alias("score"),
        priority_band(F.col("support"), n_tickets).alias("priority"),
        F.lit(PEAK_SEASON).alias("peak_season"),
    )


def strong_pairs(pairs: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """Pairs whose first item leads to the second often enough."""
    return pairs.filter((F.col("confidence_ab") >= min_confidence) & (F.col("lift") >= min_lift))


def _with_products(pairs: DataFrame, products: DataFrame) -> DataFrame:
    """Add name and price of both products of a pair."""
    known = products.select("product_id", "product_name", "price")
    return _join_sides(
        pairs, ("product_a", "product_b"), known,
        lambda side: known.toDF(side, f"name_{side[-1]}", f"price_{side[-1]}"),
    )


def recommendations(
    pairs: DataFrame, products: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT
) -> DataFrame:
    """For strong pairs: recommend the second product to buyers of the first."""
    named = _with_products(strong_pairs(pairs, min_confidence, min_lift), products)
    confidence, lift = F.col("confidence_ab").cast(_CONFIDENCE), F.col("lift").cast(_LIFT)
    score = F.round(confidence * lift * F.lit(Decimal("0.5")), 6)
    return named.select(
        F.col("product_a").alias("trigger_product"),
        F.col("product_b").alias("recommended_product"),
        F.lit(RECOMMENDATION_KIND).alias("kind"),
        score.cast("double").alias("score"),
        F.col("confidence_ab").alias("probability"),
        F.round(F.col("price_b") * confidence, 2).cast("decimal(10,2)").alias("uplift"),
        buyers_message(F.col("name_a"), F.col("name_b")).alias("message"),
        F.lit(RECOMMENDATION_SOURCE).alias("source"),
    )


def exact_moments(values: DataFrame, column: str) -> tuple[int, Fraction, Fraction] | None:
    """Number, mean and population variance of amounts in cents, without rounding; None without values.

    Cents are cut into two halves, whose products fit exact decimals for any number of
    rows; the single row of sums is put together in whole numbers of any size. Large means
    with small deviations lose nothing, and the order of partitions cannot change a digit.
    """
    cents = (F.col(column).cast(_TOTAL) * 100).cast("decimal(21,0)")
    high = (cents / F.lit(HALF)).cast("decimal(21,0)")
    halves = values.select(cents.alias("cents"), high.alias("high")).select(
        "cents", F.col("high").cast("decimal(12,0)").alias("high"),
        (F.col("cents") - F.col("high") * F.lit(HALF)).cast("decimal(12,0)").alias("low"))
    products = {"hh": ("high", "high"), "hl": ("high", "low"), "ll": ("low", "low")}
    sums = [F.sum((F.col(x) * F.col(y)).cast("decimal(24,0)")).alias(name) for name, (x, y) in products.items()]
    row = halves.agg(F.count("cents").alias("n"), F.sum("cents").alias("s"), *sums).first()
    if not row["n"]:
        return None
    squares = int(row["hh"]) * HALF**2 + 2 * int(row["hl"]) * HALF + int(row["ll"])
    n, total = row["n"], int(row["s"])
    return n, Fraction(total, n), Fraction(n * squares - total * total, n * n)


def ticket_anomalies(tickets: DataFrame, sigmas: float = ANOMALY_SIGMAS) -> DataFrame:
    """Tickets whose total lies more than ``sigmas`` population deviations off the mean.

    Mean and deviation come from exact sums, and a total is compared with the mean as a
    decimal before anything becomes a double.
    """
    moments = exact_moments(tickets, "total_amount")
    compared = tickets.select("ticket_id", "total_amount")
    if moments is None:
        moments, compared = (0, Fraction(0), Fraction(0)), compared.filter(F.lit(False))
    _, mean, variance = moments
    with localcontext() as context:
        context.prec = 60
        deviation = float((Decimal(variance.numerator) / Decimal(variance.denominator)).sqrt() / 100)
        centre = (Decimal(mean.numerator) / Decimal(mean.denominator) / 100).quantize(Decimal("1e-14"))
    off = (F.col("total_amount").cast(_TOTAL) - F.lit(centre)).cast("double")
    far = compared.filter(F.abs(off) > F.lit(float(sigmas)) * F.lit(deviation))
    return far.select(
        "ticket_id",
        F.lit(ANOMALY_KIND).alias("kind"),
        metric(off / F.nullif(F.lit(deviation), F.lit(0.0))).alias("score"),
        ticket_message(F.col("total_amount"), F.lit(float(centre))).alias("message"),
    )


def bundles(
    pairs: DataFrame, products: DataFrame, min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT, limit: int = BUNDLE_LIMIT,
) -> DataFrame:
    """The ``limit`` strong pairs with the highest potential as product bundles."""
    named = _with_products(strong_pairs(pairs, min_confidence, min_lift), products)
    both_prices = F.col("price_a") + F.col("price_b")
    exact = F.col("lift").cast(_LIFT) * both_prices * F.col("confidence_ab").cast(_CONFIDENCE)
    potential = F.round(exact, 4).cast("decimal(38,4)")
    top = named.withColumn("potential", potential)
    top = top.orderBy(F.desc("potential"), "product_a", "product_b").limit(limit)
    names = [F.replace(F.col(c), F.lit(" "), F.lit("_")) for c in ("name_a", "name_b")]
    return top.select(
        "product_a",
        "product_b",
        F.concat(F.lit(BUNDLE_PREFIX), names[0], F.lit("_"), names[1]).alias("bundle_name"),
        F.concat("name_a", F.lit(" + "), "name_b").alias("products"),
        F.lit(BUNDLE_KIND).alias("kind"),
        "potential",
    )


def rule_pair_lookup(rules: DataFrame) -> DataFrame:
    """Rules between two single items as one row per direction, the higher confidence winning."""
    listed = rules.filter(
        (F.col("source") == RULES_WIN) & F.col("antecedent_text").like("[%]") & F.col("consequent_text").like("[%]")
    )
    # Longer sides can never equal a single item, so they are left out here.
    single = listed.filter(~F.col("antecedent_text").contains(",") & ~F.col("consequent_text").contains(","))
    return single.groupBy("antecedent_hash", "consequent_hash").agg(
        F.max("confidence").alias("confidence"), F.max("lift").alias("lift")
    )


def compare_methods(pairs: DataFrame, rules: DataFrame) -> DataFrame:
    """Pair metrics next to the metrics of the rules between the same two items.

    Both directions of a rule get one key first (the two item hashes in order), so the
    comparison is a plain equi-join. Pairs without a rule compare with 0.
    """
    lookup = rule_pair_lookup(rules)
    by_pair = lookup.groupBy(
        F.least("antecedent_hash", "consequent_hash").alias("_low"),
        F.greatest("antecedent_hash", "consequent_hash").alias("_high"),
    ).agg(F.max("confidence").alias("_confidence"), F.max("lift").alias("_lift"))
    keyed = pairs.withColumn("_low", F.least("hash_a", "hash_b")).withColumn("_high", F.greatest("hash_a", "hash_b"))
    joined = keyed.join(by_pair, ["_low", "_high"], "left")
    zero = F.lit(0.0)
    best = F.greatest("confidence_ab", "confidence_ba")
    other, other_lift = F.coalesce("_confidence", zero), F.coalesce("_lift", zero)
    return joined.select(
        "product_a",
        "product_b",
        best.alias("confidence_basket"),
        other.alias("confidence_rules"),
        F.col("lift").alias("lift_basket"),
        other_lift.alias("lift_rules"),
        metric(best - other).alias("delta_confidence"),
        metric(F.col("lift") - other_lift).alias("delta_lift"),
        F.when(F.col("lift") >= other_lift, BASKET_WINS).otherwise(RULES_WIN).alias("winner"),
    )


def rules_present(rules: DataFrame | None) -> bool:
    """Whether there are rules to compare with."""
    return rules is not None and not rules.isEmpty()
