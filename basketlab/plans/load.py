"""The whole order of work: load, calendar, mining, analyses, stored results and reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab import schemas
from basketlab.operators import quality
from basketlab.operators.cleanse import priced_lines, resolve_ticket_ids, ticket_totals
from basketlab.operators.rules import RULE_KEYS, RULE_UPDATES
from basketlab.operators.staging import stage
from basketlab.operators.star import dim_time
from basketlab.plans.mining import mine
from basketlab.plans.reports import all_reports
from basketlab.plans.use_cases import Thresholds, run_use_cases
from basketlab.sources.merge_store import create_or_merge
from basketlab.sources.product_csv import read_products_csv
from basketlab.sources.report_json import write_report_json
from basketlab.sources.tables import save_table
from basketlab.sources.ticket_store import TicketStore, store_by_ticket

RESULTS = ("basket", "category", "recommendations", "anomalies", "bundles", "comparison", "rules")
#: Folders of the kept rules: a rule table is small beside the lines, and a merge rewrites whole folders.
RULE_PARTS = 64


@dataclass
class Loaded:
    products: DataFrame
    rejected: DataFrame
    tickets: DataFrame
    lines: DataFrame
    calendar: DataFrame
    checks: dict[str, DataFrame]
    store: TicketStore | None = None


def load(
    spark: SparkSession, product_files: str, headers: DataFrame, lines: DataFrame, prefix: str | None = None, folder: str | None = None,
) -> Loaded:
    """Products from CSV, lines (external_uuid, product_id, quantity) with amounts and ticket ids, ticket totals.

    ``headers`` are tickets without totals; two with one external id stop the load. Lines of
    unknown products or tickets drop; tickets without lines keep a total of 0. With ``prefix`` and ``folder``
    lines, tickets and baskets are also kept in buckets of the ticket, for this run and later ones.
    """
    repeated = quality.duplicate_keys(headers, ["external_uuid"])
    if quality.has_rows(repeated):
        raise ValueError(f"repeated ticket: {repeated.first()['external_uuid']}")
    products, rejected = read_products_csv(spark, product_files)
    products = stage(products, "products")
    resolved = stage(resolve_ticket_ids(priced_lines(lines, products), headers), "lines")
    tickets = headers.join(ticket_totals(resolved), "ticket_id", "left").select(
        "ticket_id", "sold_at", "external_uuid",
        F.coalesce("total_amount", F.lit(0)).cast("decimal(20,2)").alias("total_amount"),
        F.coalesce("total_quantity", F.lit(0)).cast("long").alias("total_quantity"),
    )
    tickets = stage(tickets, "tickets")
    checks = {
        "counts": quality.load_counts(tickets, resolved),
        "items": quality.avg_distinct_items(resolved),
        "zero_quantity": quality.zero_quantity_tickets(tickets),
        "orphans": quality.orphan_lines(resolved, tickets),
    }
    store = store_by_ticket(resolved, tickets, folder, prefix) if prefix and folder else None
    return Loaded(products, rejected, tickets, resolved, stage(dim_time(tickets), "dim_time"), checks, store)


def store_results(tables: dict[str, DataFrame], prefix: str, folder: str, run_date: date) -> None:
    """Save the result tables as ``prefix_name`` in the catalog, each row with the date of the run."""
    for name in RESULTS:
        if name in tables:
            save_table(tables[name].withColumn("run_date", F.lit(run_date)), f"{prefix}_{name}", f"{folder}/{prefix}_{name}")


def stored_reports(spark: SparkSession, prefix: str, products: DataFrame, limits: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """The reports over result tables stored before, in this session or an earlier one."""
    return all_reports({name: spark.table(f"{prefix}_{name}") for name in RESULTS}, products, limits)


def run_all(
    spark: SparkSession, product_files: str, headers: DataFrame, lines: DataFrame, min_rel_support: Decimal | float | str,
    prefix: str, folder: str, run_date: date, min_confidence: float = 0.5, cuts: Thresholds = Thresholds(),
) -> Loaded:
    """Load, mine, analyse, store all results under ``prefix`` in ``folder`` and write the reports there.

    Lines, tickets and baskets are kept in buckets, facts by month (``prefix_facts``). The rules of all runs so
    far are merged in ``prefix_rules_kept``: a later run replaces the figures of a rule that it finds again.
    """
    loaded = load(spark, product_files, headers, lines, prefix, folder)
    mined = mine(loaded.tickets, loaded.lines, min_rel_support, min_confidence=min_confidence, baskets=loaded.store.baskets)
    if mined is None:
        raise ValueError("no tickets to mine")
    run = run_use_cases(loaded.products, loaded.tickets, loaded.lines, min_rel_support, rules=mined.rules, cuts=cuts,
                        store=loaded.store, facts_path=f"{folder}/{prefix}_facts")
    if run.status != "ok":
        raise ValueError(f"no results: {run.status}")
    store_results(run.tables, prefix, folder, run_date)
    kept = mined.rules.select(*[f.name for f in schemas.RULES.fields])
    create_or_merge(kept, f"{folder}/{prefix}_rules_kept", RULE_KEYS, RULE_PARTS, RULE_UPDATES)
    write_report_json(spark, stored_reports(spark, prefix, loaded.products), f"{folder}/{prefix}_reports")
    return loaded
