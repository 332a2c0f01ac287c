"""Cleaning of products, tickets and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlab.functions.money import AMOUNT, line_total, parse_price
from basketlab.functions.text_hash import hex_prefix, seeded_hash
from basketlab.operators.joins import lookup_join, salted_join

# Purchase-frequency labels with their shares, and the share of an unknown label.
FREQUENCY_SHARES = {"Muy Frecuente": 0.40, "Frecuente": 0.25, "Regular": 0.20, "Esporádicamente": 0.15}
UNKNOWN_SHARE = 0.15
# Default anchor categories.
ANCHOR_CATEGORIES = ["Electrónica", "Juguetes", "Hogar"]


def normalize_headers(df: DataFrame) -> DataFrame:
    """Column names trimmed, lower case, with blanks as underscores."""
    return df.toDF(*["_".join(name.lower().split()) for name in df.columns])


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """The table itself, or ValueError when a column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def reject_bad_rows(df: DataFrame, raw_price: str, price: str = "price") -> tuple[DataFrame, DataFrame]:
    """Split into rows with a readable price (added as ``price``) and the others."""
    parsed = parse_price(F.col(raw_price))
    good = df.withColumn(price, parsed).filter(F.col(price).isNotNull())
    return good, df.filter(parsed.isNull())


def fill_frequency(df: DataFrame, key: str = "product_id", column: str = "frequency", seed: int = 42) -> DataFrame:
    """Add a frequency label where the column is absent, by the fixed shares.

    The label comes from a hash of the key, so a rerun gives the same one.
    """
    if column in df.columns:
        return df
    percent = F.pmod(hex_prefix(seeded_hash(F.col(key), seed), 8), F.lit(100))
    label, reached = None, 0
    for name, share in FREQUENCY_SHARES.items():
        reached += round(share * 100)
        label = F.when(percent < reached, name) if label is None else label.when(percent < reached, name)
    return df.withColumn(column, label)


def frequency_weight(label: Column) -> Column:
    """Share of a frequency label; unknown and missing labels get the lowest."""
    weight = None
    for name, share in FREQUENCY_SHARES.items():
        weight = F.when(label == name, share) if weight is None else weight.when(label == name, share)
    return weight.otherwise(UNKNOWN_SHARE)


def anchor_products(products: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """Products of the anchor categories, or all products when there are none."""
    anchors = products.filter(F.col("category").isin(*(ANCHOR_CATEGORIES if categories is None else categories)))
    return products if anchors.isEmpty() else anchors


def priced_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines (ticket, product, quantity) with the line amount from the unit price."""
    prices = products.select("product_id", "price")
    joined = lookup_join(lines, prices, ["product_id"])
    return joined.withColumn("amount", line_total(F.col("price"), F.col("quantity"))).drop("price")


def ticket_totals(lines: DataFrame) -> DataFrame:
    """Amount and quantity per ticket from its lines; tickets without a positive total drop."""
    totals = lines.groupBy("ticket_id").agg(
        F.sum(F.round("amount", 2)).cast(AMOUNT).alias("total_amount"),
        F.sum("quantity").cast("long").alias("total_quantity"),
    )
    return totals.filter((F.col("total_amount") > 0) & (F.col("total_quantity") > 0))


def resolve_ticket_ids(lines: DataFrame, tickets: DataFrame) -> DataFrame:
    """Replace the external ticket id on lines by the stored id; lines of unknown tickets drop."""
    ids = tickets.select("external_uuid", "ticket_id")
    return salted_join(lines, ids, ["external_uuid"]).drop("external_uuid")


def products_by_category(products: DataFrame) -> DataFrame:
    """The products of each category, one row per product, with the category's number of products.

    The row shape is the same for every size: no row or task holds a whole category.
    """
    sizes = products.groupBy("category").agg(F.count(F.lit(1)).alias("n_products"))
    listed = products.select("category", "product_id", "product_name", "price")
    return lookup_join(listed, sizes, ["category"]).select("category", "n_products", "product_id", "product_name", "price")
