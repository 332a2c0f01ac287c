"""Stored tables: typed reads, full refresh, append and upsert to a new version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, file_format: str = "parquet", **options) -> DataFrame:
    """Stored table, reduced to ``columns`` in the scan itself.

    ``file_format="jdbc"`` with the usual options reads a database table the same way.
    """
    reader = spark.read.format(file_format).options(**options)
    df = reader.load() if file_format == "jdbc" else reader.load(path)
    return df.select(*columns) if columns else df


def conform(df: DataFrame, layout: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Cast to a fixed layout; NULL or absent columns take their default.

    A NULL that remains in a required column, or a value that does not fit its type,
    fails the job that writes the table.
    """
    defaults = defaults or {}
    columns = []
    for f in layout.fields:
        if f.name in df.columns:
            value = F.col(f.name).cast(f.dataType)
        elif f.name in defaults or f.nullable:
            value = F.lit(None).cast(f.dataType)
        else:
            raise ValueError(f"missing column: {f.name}")
        if f.name in defaults:
            value = F.coalesce(value, F.lit(defaults[f.name]).cast(f.dataType))
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"NULL in required column {f.name}")).cast(f.dataType))
        columns.append(value.alias(f.name))
    return df.select(*columns)


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace a table; ``df`` must not read from ``path`` itself."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_batches(path: str, *batches: DataFrame) -> None:
    """Append batches to a table; Spark's partitions are the write chunks."""
    for batch in batches:
        batch.write.mode("append").parquet(path)


def save_table(df: DataFrame, name: str, path: str) -> None:
    """Write a table and list it in the session catalog."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> None:
    """Write a table bucketed by its join keys.

    Tables with the same keys and bucket count join without a shuffle, which pays off
    for lines and tickets, joined on the ticket in every run.
    """
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.saveAsTable(name)
