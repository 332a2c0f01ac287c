"""Facts in one folder per month, read month by month through the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab.operators.joins import lookup_join

MONTH = "month_key"


def month_key(date_key: Column) -> Column:
    """yyyymm of a date key."""
    return F.floor(date_key / 100).cast("int")


def store_facts(facts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write facts below one folder per month.

    Rows are gathered by month before the write, so a month has few files; a month too
    large for one task is split by the adaptive rebalance. Facts without a date go to the folder of
    a missing month.
    """
    keyed = facts.withColumn(MONTH, month_key(F.col("date_key")))
    keyed.hint("rebalance", MONTH).write.mode(mode).partitionBy(MONTH).parquet(path)


def replace_months(facts: DataFrame, path: str) -> None:
    """Replace the months that occur in ``facts`` and leave the folders of all others alone.

    ``facts`` must not read the store. The same call again gives the same store.
    """
    keyed = facts.withColumn(MONTH, month_key(F.col("date_key"))).hint("rebalance", MONTH)
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def read_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def facts_of_days(facts: DataFrame, calendar: DataFrame, days: Column) -> DataFrame:
    """Facts of the calendar rows that satisfy ``days``, with those rows' columns.

    The calendar has a row per day and is broadcast. The join on the month lets Spark
    skip the folders of all other months at run time, when the calendar's filter has been evaluated.
    """
    chosen = calendar.filter(days).withColumn(MONTH, month_key(F.col("date_key")))
    return facts.join(F.broadcast(chosen), [MONTH, "date_key"])


def season_sales(facts: DataFrame, calendar: DataFrame, products: DataFrame, season: str) -> DataFrame:
    """Amount, quantity and number of lines by month and category in one season of all years.

    ``products`` is the product dimension, whose size decides how it is joined.
    """
    of_season = facts_of_days(facts, calendar, F.col("season") == season)
    grouped = of_season.groupBy("period", "product_key").agg(
        F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity"), F.count(F.lit(1)).alias("n_lines"))
    named = lookup_join(grouped, products.select("product_key", "category"), ["product_key"])
    return named.groupBy("period", "category").agg(
        F.sum("amount").cast("decimal(20,2)").alias("amount"), F.sum("quantity").alias("quantity"), F.sum("n_lines").alias("n_lines"))
