"""The sorted, limited reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default row limits.
LIMITS = {
    "basket": 50, "category": 50, "recommendations": 50, "anomalies": 30,
    "bundles": 30, "rules": 50, "comparison": 50,
}

BROADCAST_ROWS = 10_000


def _top(df: DataFrame, order: list, limit: int) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def _named(top: DataFrame, products: DataFrame, columns: dict[str, str], order: list, limit: int) -> DataFrame:
    """Add product names to an already limited report.

    A report of up to ``BROADCAST_ROWS`` rows is broadcast, whatever the size of the product
    table. The joins lose the order, so the few rows are sorted again.
    """
    names = products.select("product_id", "product_name")
    for key, name in columns.items():
        top = names.toDF(key, name).join(F.broadcast(top) if limit <= BROADCAST_ROWS else top, key)
    return top.orderBy(*order)


def report_basket(pairs: DataFrame, products: DataFrame, limit: int = LIMITS["basket"]) -> DataFrame:
    """Pairs with the highest lift."""
    order = [F.desc("lift"), "product_a", "product_b"]
    top = _top(pairs.select("product_a", "product_b", "lift", "confidence_ab"), order, limit)
    return _named(top, products, {"product_a": "name_a", "product_b": "name_b"}, order, limit)


def report_category(category_pairs: DataFrame, limit: int = LIMITS["category"]) -> DataFrame:
    """Category pairs with the highest score."""
    return _top(category_pairs, [F.desc("score"), "category_a", "category_b"], limit)


def report_recommendations(
    recommendations: DataFrame, products: DataFrame, limit: int = LIMITS["recommendations"]
) -> DataFrame:
    """Recommendations with the highest score."""
    order = [F.desc("score"), "trigger_product", "recommended_product", "source"]
    names = {"trigger_product": "trigger_name", "recommended_product": "recommended_name"}
    return _named(_top(recommendations, order, limit), products, names, order, limit)


def report_anomalies(anomalies: DataFrame, limit: int = LIMITS["anomalies"]) -> DataFrame:
    """Tickets with the highest score; unusually small tickets come last."""
    return _top(anomalies, [F.desc("score"), "ticket_id"], limit)


def report_bundles(bundles: DataFrame, limit: int = LIMITS["bundles"]) -> DataFrame:
    """Bundles with the highest potential."""
    return _top(bundles, [F.desc("potential"), "bundle_name", "product_a", "product_b"], limit)


def report_rules(rules: DataFrame, limit: int = LIMITS["rules"]) -> DataFrame:
    """Rules with the highest lift."""
    order = [F.desc("lift"), F.desc("confidence"), "antecedent_text", "consequent_text"]
    return _top(rules, order, limit)


def report_comparison(comparison: DataFrame, products: DataFrame, limit: int = LIMITS["comparison"]) -> DataFrame:
    """Pairs on which the two methods differ most in lift."""
    order = [F.desc(F.abs("delta_lift")), "product_a", "product_b"]
    names = {"product_a": "name_a", "product_b": "name_b"}
    return _named(_top(comparison, order, limit), products, names, order, limit)


def all_reports(
    tables: dict[str, DataFrame], products: DataFrame, limits: dict[str, int] | None = None
) -> dict[str, DataFrame]:
    """All seven reports over the result tables of a run."""
    n = {**LIMITS, **(limits or {})}
    return {
        "basket": report_basket(tables["basket"], products, n["basket"]),
        "category": report_category(tables["category"], n["category"]),
        "recommendations": report_recommendations(tables["recommendations"], products, n["recommendations"]),
        "anomalies": report_anomalies(tables["anomalies"], n["anomalies"]),
        "bundles": report_bundles(tables["bundles"], n["bundles"]),
        "rules": report_rules(tables["rules"], n["rules"]),
        "comparison": report_comparison(tables["comparison"], products, n["comparison"]),
    }
