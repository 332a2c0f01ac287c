"""Star schema: calendar, product and customer dimensions, sales facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab import schemas
from basketlab.functions import calendar as cal
from basketlab.operators.joins import fits_broadcast, hot_keys, lookup_join, salted_join
from basketlab.operators.surrogates import assign_keys
from basketlab.operators.upserts import absent_rows, insert_ignore, unique_rows, update_rows, upsert

# The one customer row and its key.
GENERAL_CUSTOMER_KEY = 1
GENERAL_CUSTOMER = "General"


def dim_time(tickets: DataFrame) -> DataFrame:
    """One calendar row per distinct ticket date."""
    days = tickets.select(F.to_date("sold_at").alias("date")).filter(F.col("date").isNotNull()).distinct()
    d = F.col("date")
    return days.select(
        cal.date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        cal.month_name(d).alias("month_name"),
        cal.day_name(d).alias("day_name"),
        F.quarter(d).alias("quarter"),
        cal.monday_week(d).alias("week"),
        cal.is_weekend(d).alias("is_weekend"),
        cal.period(d).alias("period"),
        cal.season(d).alias("season"),
    )


def upsert_dim_time(existing: DataFrame, tickets: DataFrame) -> DataFrame:
    """Add the dates the calendar lacks; a known date keeps its row."""
    return upsert(existing, dim_time(tickets), ["date_key"], ["date_key"])


def dim_product(products: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Products by business id with current name, category and price.

    Known products keep their key and take the new values; new ones are numbered on. A
    product id that occurs twice fails: it would double every fact of the product.
    """
    incoming = unique_rows(products.select("product_id", "product_name", "category", "price"), ["product_id"])
    columns = [f.name for f in schemas.DIM_PRODUCT.fields]
    if existing is None:
        return assign_keys(incoming, "product_key", ["product_id"]).select(*columns)
    last = existing.agg(F.coalesce(F.max("product_key"), F.lit(0))).first()[0]
    known = update_rows(existing, incoming, ["product_id"], ["product_name", "category", "price"])
    fresh = absent_rows(incoming, existing, ["product_id"])
    fresh = assign_keys(fresh, "product_key", ["product_id"], start=last + 1)
    return known.select(*columns).unionByName(fresh.select(*columns))


def dim_customer(spark, existing: DataFrame | None = None) -> DataFrame:
    """Customer types with the general row present."""
    general = spark.createDataFrame([(GENERAL_CUSTOMER_KEY, GENERAL_CUSTOMER)], schemas.DIM_CUSTOMER)
    return general if existing is None else insert_ignore(existing, general, ["customer_key"])


def fact_sales(lines: DataFrame, tickets: DataFrame, products: DataFrame, hot: list | None = None) -> DataFrame:
    """Sales lines with date key, product key and the ticket's totals.

    ``products`` is the product dimension. Lines without ticket or product drop. The
    business product id stays on the row as well, since item sets are built from it.
    ``hot`` are the lines' hot tickets where they are known already.
    """
    headers = tickets.select(
        "ticket_id",
        cal.date_key(F.to_date("sold_at")).alias("date_key"),
        F.col("total_amount").alias("ticket_total"),
        F.col("total_quantity").alias("ticket_quantity"),
    )
    headed = salted_join(lines, headers, ["ticket_id"], hot=hot)
    keys = products.select("product_id", "product_key")
    small = fits_broadcast(products)
    # Hot products are looked for on the plain lines, not on the result of the join above.
    hot_products = None if small else hot_keys(lines, ["product_id"])
    return lookup_join(headed, keys, ["product_id"], small=small, hot=hot_products).select(
        "date_key",
        "product_key",
        F.lit(GENERAL_CUSTOMER_KEY).cast("long").alias("customer_key"),
        "ticket_id",
        "quantity",
        "amount",
        "ticket_total",
        "ticket_quantity",
        "product_id",
    )


def fact_increment(
    lines: DataFrame, tickets: DataFrame, products: DataFrame, after: int, id_column: str = "line_id"
) -> tuple[DataFrame, int]:
    """Facts of the lines whose id lies above ``after``, and the next high-water mark.

    The upper end is fixed before the load, so lines arriving meanwhile wait for the
    next one.
    """
    last = lines.agg(F.max(id_column)).first()[0]
    if last is None or last <= after:
        return fact_sales(lines.filter(F.lit(False)), tickets, products), after
    window = lines.filter((F.col(id_column) > after) & (F.col(id_column) <= last))
    return fact_sales(window, tickets, products), last
