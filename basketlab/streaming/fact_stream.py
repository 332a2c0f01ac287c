"""Incremental fact load as a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from basketlab.operators.staging import stage
from basketlab.operators.star import fact_sales


def read_new_lines(spark: SparkSession, path: str, layout: T.StructType, max_files: int | None = None) -> DataFrame:
    """Line files as a stream: every file is read once."""
    reader = spark.readStream.schema(layout)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def load_new_facts(
    lines: DataFrame, tickets: DataFrame, products: DataFrame, target: str, progress: str
) -> StreamingQuery:
    """Append the facts of all line files that arrived since the last run, then stop.

    The files already loaded are remembered in ``progress``, which takes the place of
    a high-water mark. Each micro-batch goes to a folder of its own, so a batch that
    is repeated after a failure replaces itself. The product dimension is written once for the
    whole run and each batch is kept while it is loaded, so looking for hot keys and the size of
    the dimension read no file again.
    """
    known = stage(products, "stream_products")

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        facts = fact_sales(batch, tickets, known)
        facts.write.mode("overwrite").parquet(f"{target}/batch={number}")
        batch.unpersist()

    stream = lines.writeStream.foreachBatch(write).option("checkpointLocation", progress)
    return stream.trigger(availableNow=True).start()
