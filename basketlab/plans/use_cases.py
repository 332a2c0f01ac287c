"""The six analyses over one set of products, tickets and lines."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import DataFrame

from basketlab import schemas
from basketlab.operators.baskets import basket_items, min_pair_support, pair_support, stage_baskets, stage_supports
from basketlab.operators.insights import (
    BUNDLE_LIMIT,
    MIN_CATEGORY_SUPPORT,
    MIN_CONFIDENCE,
    MIN_LIFT,
    ANOMALY_SIGMAS,
    bundles,
    category_pairs,
    compare_methods,
    pair_limit_guard,
    pair_metrics,
    recommendations,
    rules_present,
    ticket_anomalies,
)
from basketlab.operators.quality import AUDIT_EMPTY, audit_counts, has_rows, refresh_statistics
from basketlab.operators.staging import new_path, stage
from basketlab.operators.star import dim_customer, dim_product, fact_sales
from basketlab.sources.fact_store import store_facts
from basketlab.sources.tables import save_table
from basketlab.sources.ticket_store import TicketStore, stored_baskets, stored_facts

# Fixed value: relative support of the simple run.
SIMPLE_REL_SUPPORT = Decimal("0.01")


@dataclass
class UseCaseResult:
    status: str
    pair_status: str = ""
    tables: dict[str, DataFrame] = field(default_factory=dict)
    audit: DataFrame | None = None


@dataclass(frozen=True)
class Thresholds:
    """Cuts of the analyses; the defaults are the fixed ones."""

    min_confidence: float = MIN_CONFIDENCE
    min_lift: float = MIN_LIFT
    min_category_support: int = MIN_CATEGORY_SUPPORT
    anomaly_sigmas: float = ANOMALY_SIGMAS
    bundle_limit: int = BUNDLE_LIMIT
    pair_limit: int | None = None


def run_use_cases(
    products: DataFrame, tickets: DataFrame, lines: DataFrame, min_rel_support: Decimal | float,
    rules: DataFrame | None = None, existing_products: DataFrame | None = None,
    analyze: bool = False, cuts: Thresholds = Thresholds(), prefix: str = "basketlab",
    store: TicketStore | None = None, facts_path: str | None = None,
) -> UseCaseResult:
    """Build dimensions and facts, then all six analyses and the audit row.

    ``rules`` come from a mining run before; without them the comparison is empty.
    Every table that several steps read is written once. With ``analyze`` the four
    main tables are also saved in the catalog, under names with ``prefix``, with fresh
    statistics. More pairs than a ``pair_limit`` set by the caller end the run with that status.
    With a ``store`` of the same lines and tickets, facts and baskets are built inside its buckets.
    With ``facts_path`` the facts are kept there by month.
    """
    spark = products.sparkSession
    if not has_rows(lines):
        return UseCaseResult(AUDIT_EMPTY)
    products_dim = stage(dim_product(products, existing_products), "dim_product")
    customers = dim_customer(spark)
    joined = stored_facts(store, products_dim) if store else fact_sales(lines, tickets, products_dim)
    facts = stage(joined, "fact_sales")
    if not has_rows(facts):
        return UseCaseResult(AUDIT_EMPTY)
    if facts_path:
        store_facts(facts, facts_path)
    n_tickets = tickets.count()

    minimum = min_pair_support(n_tickets, min_rel_support)
    baskets = stored_baskets(store, products_dim) if store else stage_baskets(basket_items(facts))
    supports = stage_supports(baskets)
    counted = stage(pair_support(baskets, minimum, supports), "pairs")
    pair_status = pair_limit_guard(counted, cuts.pair_limit)
    if pair_status == "too many pairs":
        return UseCaseResult(pair_status, pair_status)
    basket = stage(pair_metrics(counted, supports, products_dim, n_tickets), "basket")

    category = stage(category_pairs(facts, products_dim, n_tickets, cuts.min_category_support), "category")
    recommended = stage(recommendations(basket, products_dim, cuts.min_confidence, cuts.min_lift), "recommendations")
    anomalies = stage(ticket_anomalies(tickets, cuts.anomaly_sigmas), "anomalies")
    bundled = stage(bundles(basket, products_dim, cuts.min_confidence, cuts.min_lift, cuts.bundle_limit), "bundles")
    if rules_present(rules):
        comparison = stage(compare_methods(basket, rules), "comparison")
    else:
        comparison = spark.createDataFrame([], schemas.COMPARISON)

    tables = {
        "basket": basket, "category": category, "recommendations": recommended,
        "anomalies": anomalies, "bundles": bundled, "comparison": comparison,
    }
    audit = audit_counts(facts, tables, Decimal(str(min_rel_support)))
    if rules is not None:
        tables["rules"] = rules
    tables.update(dim_product=products_dim, dim_customer=customers, fact_sales=facts)
    if analyze:
        saved = ["fact_sales", "basket", "category", "recommendations"]
        for name in saved:
            save_table(tables[name], f"{prefix}_{name}", new_path(spark, name))
        refresh_statistics(spark, [f"{prefix}_{name}" for name in saved])
    return UseCaseResult("ok", pair_status, tables, audit)


def run_use_cases_simple(
    products: DataFrame, tickets: DataFrame, lines: DataFrame, rules: DataFrame | None = None, prefix: str = "basketlab"
) -> UseCaseResult:
    """The run with its standard support and fresh statistics."""
    return run_use_cases(products, tickets, lines, SIMPLE_REL_SUPPORT, rules, analyze=True, prefix=prefix)
