"""Checks and counts over loaded tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.operators.joins import lookup_join, salted_join


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def missing_parents(child: DataFrame, parent: DataFrame, keys: list[str], large: bool = False) -> DataFrame:
    """Child rows whose key the parent table does not hold."""
    wanted = parent.select(*keys)
    return salted_join(child, wanted, keys, "left_anti") if large else lookup_join(child, wanted, keys, "left_anti")


def check_keys(
    tickets: DataFrame, lines: DataFrame, products: DataFrame,
    facts: DataFrame | None = None, calendar: DataFrame | None = None,
    dim_product: DataFrame | None = None, dim_customer: DataFrame | None = None,
) -> DataFrame:
    """Number of violations of every key and reference of the data model."""
    found = {
        "ticket id unique": duplicate_keys(tickets, ["ticket_id"]),
        "ticket uuid unique": duplicate_keys(tickets, ["external_uuid"]),
        "product id unique": duplicate_keys(products, ["product_id"]),
        "line ticket exists": missing_parents(lines, tickets, ["ticket_id"], large=True),
        "line product exists": missing_parents(lines, products, ["product_id"]),
    }
    if facts is not None:
        found["fact ticket and product unique"] = duplicate_keys(facts, ["ticket_id", "product_key"])
        if calendar is not None:
            found["fact date exists"] = missing_parents(facts, calendar, ["date_key"])
        if dim_product is not None:
            found["fact product exists"] = missing_parents(facts, dim_product, ["product_key"])
        if dim_customer is not None:
            found["fact customer exists"] = missing_parents(facts, dim_customer, ["customer_key"])
    rows = [
        bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, bad in found.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def load_counts(tickets: DataFrame, lines: DataFrame) -> DataFrame:
    """Ticket and line counts and lines per ticket (0 without tickets)."""
    n_tickets = tickets.agg(F.count(F.lit(1))).scalar()
    counted = lines.agg(F.count(F.lit(1)).alias("n_lines")).withColumn("n_tickets", n_tickets)
    per_ticket = F.when(F.col("n_tickets") > 0, F.col("n_lines") / F.nullif("n_tickets", F.lit(0))).otherwise(0.0)
    return counted.select("n_tickets", "n_lines", per_ticket.alias("lines_per_ticket"))


def avg_distinct_items(lines: DataFrame, low: float = 8, high: float = 20) -> DataFrame:
    """Mean number of distinct products per ticket, and whether it lies in the expected range."""
    pairs = lines.select("ticket_id", "product_id").distinct()
    # Every distinct pair is one item of one ticket, so two sums give the mean.
    per_ticket = pairs.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n"))
    mean = per_ticket.agg(F.avg("n").alias("avg_items"))
    return mean.withColumn("in_range", F.col("avg_items").between(low, high))


def zero_quantity_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.filter(F.col("total_quantity") == 0).agg(F.count(F.lit(1)).alias("n_tickets"))


def orphan_lines(lines: DataFrame, tickets: DataFrame) -> DataFrame:
    """Number of lines whose ticket does not exist."""
    return missing_parents(lines, tickets, ["ticket_id"], large=True).agg(F.count(F.lit(1)).alias("n_lines"))


def has_rows(df: DataFrame) -> bool:
    """Guard for steps that make no sense on an empty input."""
    return not df.isEmpty()


# Audit texts, and the order in which the analyses are listed.
AUDIT_STATUS = "COMPLETADO"
AUDIT_EMPTY = "SIN DATOS"
AUDIT_COMMENT = "Soporte Relativo: "
AUDIT_LABELS = {
    "basket": "MBA", "category": "Cat", "recommendations": "Rec",
    "anomalies": "Anom", "bundles": "Bnd", "comparison": "Cmp",
}


def audit_counts(facts: DataFrame, outputs: dict[str, DataFrame], min_rel_support: Decimal) -> DataFrame:
    """One row: input rows, rows of each analysis, status and the support used."""
    counted = facts.agg(F.count(F.lit(1)).alias("input_rows"))
    for name in AUDIT_LABELS:
        counted = counted.withColumn(f"n_{name}", outputs[name].agg(F.count(F.lit(1))).scalar())
    parts = [F.concat(F.lit(f"{label}:"), F.col(f"n_{name}")) for name, label in AUDIT_LABELS.items()]
    support = Decimal(str(min_rel_support)).quantize(Decimal("0.00000001"))
    return (
        counted.withColumn("status", F.lit(AUDIT_STATUS))
        .withColumn("message", F.concat_ws(", ", *parts))
        .withColumn("comment", F.lit(f"{AUDIT_COMMENT}{support:f}"))
    )


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Spark settings (dots as double underscores) for the time of a block."""
    names = {k: k.replace("__", ".") for k in values}
    before = {k: spark.conf.get(names[k], None) for k in values}
    for k, v in values.items():
        spark.conf.set(names[k], v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(names[k]) if v is None else spark.conf.set(names[k], v)


def refresh_statistics(spark: SparkSession, tables: list[str], columns: dict[str, list[str]] | None = None, bins: int = 64) -> None:
    """Recompute optimizer statistics of saved tables, and of those of their columns that are listed.

    A listed column gets its range, nulls, distinct values and, for numbers and dates, a histogram of equal-height bins.
    """
    for name in tables:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
        listed = (columns or {}).get(name)
        if listed:
            with _settings(spark, spark__sql__statistics__histogram__enabled="true", spark__sql__statistics__histogram__numBins=str(bins)):
                spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(listed)}")


def column_statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """Stored statistics, one row per column: least and largest value as text, nulls, distinct values, bins of the histogram."""
    rows = []
    for column in columns:  # as many commands as the caller names columns; they read the catalog only
        found: dict[str, str] = {}
        bins = 0
        for r in spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect():
            bins += r["info_name"].startswith("bin_")
            found[r["info_name"]] = r["info_value"]
        number = {k: int(found[k]) if found.get(k, "NULL") != "NULL" else None for k in ("num_nulls", "distinct_count")}
        text = {k: None if found.get(k, "NULL") == "NULL" else found[k] for k in ("min", "max")}
        rows.append((column, text["min"], text["max"], number["num_nulls"], number["distinct_count"], bins))
    return spark.createDataFrame(rows, "column_name string, min string, max string, num_nulls long, distinct_count long, bins int")


@contextmanager
def cost_based_plans(spark: SparkSession) -> Iterator[None]:
    """Plans made in this block estimate filters by column statistics and order joins by the estimates."""
    with _settings(
        spark, spark__sql__cbo__enabled="true", spark__sql__cbo__joinReorder__enabled="true",
        spark__sql__cbo__planStats__enabled="true", spark__sql__statistics__histogram__enabled="true",
    ):
        yield
