"""Intermediate tables that outlive executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_local_folders: dict[str, str] = {}
_staged: dict[str, list[str]] = {}
#: The size of a page is looked at from its first row on, else a hundred rows of megabytes become one page, which is
#: (de)compressed in one piece outside the heap.
WRITE_OPTIONS = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}


def configured_folder(spark: SparkSession) -> str | None:
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a session in one process without that setting gets a temporary folder of its own.
    """
    folder = configured_folder(spark)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="basketlab-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path for a table in the shared folder."""
    path = f"{shared_folder(spark)}/basketlab/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def staged_paths(spark: SparkSession) -> list[str]:
    """Paths that this application has taken since the last ``remove_staged``."""
    return list(_staged.get(spark.sparkContext.applicationId, []))


def remove_staged(spark: SparkSession, since: int = 0) -> int:
    """Delete the staged tables from number ``since`` on, once nothing reads them any more; gives how many."""
    return remove_paths(spark, staged_paths(spark)[since:])


def remove_paths(spark: SparkSession, old: list[str]) -> int:
    """Delete these staged tables, once nothing reads them any more; gives how many there were."""
    paths = _staged.get(spark.sparkContext.applicationId, [])
    old = [p for p in old if p in paths]
    paths[:] = [p for p in paths if p not in old]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in old:
        place = hadoop.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(old)


@contextmanager
def shuffled_into(spark: SparkSession, parts: int) -> Iterator[None]:
    """Jobs that run meanwhile shuffle into at least so many parts; partial aggregates still come before the shuffle."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    if parts <= int(usual):
        yield
        return
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)


@contextmanager
def scanned_by(spark: SparkSession, max_bytes: int) -> Iterator[None]:
    """A task of the jobs that run meanwhile scans at most so many bytes of files, as far as their row groups allow."""
    key = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(key)
    least = min(max_bytes, spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(usual))
    spark.conf.set(key, f"{least}b")
    try:
        yield
    finally:
        spark.conf.set(key, usual)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run meanwhile hand Python batches of at most so many rows: a batch lies in both processes, beside the heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, rows if int(usual) <= 0 else min(int(usual), rows))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def stage(df: DataFrame, name: str, parts: int = 0) -> DataFrame:
    """Write a table and read it back; its shuffles have at least ``parts`` parts.

    The lineage ends at the files, so a lost executor never recomputes the steps
    before, and later readers get column pruning and counts from file footers. The
    write itself measures the table, so ``measured_bytes`` of it needs no job.
    """
    path = new_path(df.sparkSession, name)
    seen = Observation()
    measured = df.observe(seen, F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes"))
    with shuffled_into(df.sparkSession, parts):
        measured.write.options(**WRITE_OPTIONS).parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.measured = seen.get.get("bytes")
    staged.path = path
    return staged


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for table in tables:
        remove_paths(table.sparkSession, [table.path])


def _width(field: T.StructField) -> Column:
    """Rough bytes one value of a column takes in a broadcast table."""
    name = f"`{field.name}`"
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(16) + F.coalesce(F.octet_length(name), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.lit(16) + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
    return F.lit(16)


def row_bytes(df: DataFrame) -> Column:
    """Rough bytes a row takes in a broadcast table."""
    return reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields]).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of a table: known of a staged one, else from one distributed aggregate over it."""
    known = getattr(df, "measured", None)
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0] if known is None else known
