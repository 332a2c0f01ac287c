"""All reports as JSON: one folder of lines per report, or one document of bounded reports."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlab.operators.staging import new_path, stage
from basketlab.schemas import published_name, to_published

#: Rows of a report that one document may hold by default; the reports have 30 or 50.
DOCUMENT_ROWS = 10_000


def _plain(report: DataFrame) -> list:
    """Columns in their JSON form: decimals as numbers, dates and times in ISO text."""
    shown = []
    for f in report.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        shown.append(column.alias(f.name))
    return shown


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with their position from 0, in the order they have: places in a partition plus what earlier ones hold."""
    placed = stage(rows.withColumn("_id", F.monotonically_increasing_id()), "report")
    part = F.shiftright("_id", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))  # one row per partition
    inner = F.col("_id") - F.shiftleft(F.col("_part"), 33)
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        (F.col("_start") + inner).alias("position"), "row")


def write_report_json(spark: SparkSession, reports: dict[str, DataFrame], path: str, published: bool = True) -> None:
    """Write reports by name below ``path``: one folder each, one JSON object per line and row.

    Spark writes the rows where they are, whatever their number; a row's ``position`` keeps
    the report's order. ``published`` uses the table and column names that existing readers expect.
    """
    for name, report in reports.items():
        shown = to_published(report, name) if published else report
        shown_name = published_name(name) if published else name
        _numbered(shown.select(F.struct(*_plain(shown)).alias("row"))).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{shown_name}")
        if spark.read.text(f"{path}/{shown_name}").isEmpty():
            warnings.warn(f"report {shown_name} has no rows", stacklevel=2)


def write_report_document(
    spark: SparkSession, reports: dict[str, DataFrame], path: str, published: bool = True, most_rows: int = DOCUMENT_ROWS
) -> None:
    """Write reports by name as one JSON document at ``path``, an object with an array of rows per report.

    A document is one text, so a report of more than ``most_rows`` rows is refused before anything
    is written; such reports belong into ``write_report_json``. A report without rows is an empty array.
    """
    parts = None
    for place, (name, report) in enumerate(reports.items()):
        shown = to_published(report, name) if published else report
        rows = _numbered(shown.select(F.struct(*_plain(shown)).alias("row")).limit(most_rows + 1))
        listed = F.array_sort(F.collect_list(F.struct("position", F.to_json("row", {"ignoreNullFields": "false"}).alias("text"))))
        part = rows.agg(F.count(F.lit(1)).alias("n"), listed.alias("rows")).select(
            F.lit(place).alias("place"), F.lit(published_name(name) if published else name).alias("name"), "n",
            F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["text"]), ",\n"), F.lit("]")).alias("rows"))
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        parts = spark.createDataFrame([], "place int, name string, n long, rows string")
    parts = stage(parts, "report_parts")  # one row per report
    long = [r["name"] for r in parts.filter(F.col("n") > most_rows).select("name").collect()]
    if long:
        raise ValueError(f"reports of more than {most_rows} rows: {sorted(long)}")
    named = F.concat(F.lit('"'), "name", F.lit('": '), "rows")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("place", named.alias("text")))), lambda p: p["text"])
    whole = parts.agg(F.concat(F.lit("{"), F.array_join(texts, ",\n"), F.lit("}")).alias("value"))
    folder = new_path(spark, "report_document")
    whole.coalesce(1).write.text(folder)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    source, target = hadoop.Path(folder), hadoop.Path(path)
    written = source.getFileSystem(conf).globStatus(hadoop.Path(f"{folder}/part-*"))[0].getPath()
    hadoop.FileUtil.copy(source.getFileSystem(conf), written, target.getFileSystem(conf), target, False, True, conf)


def read_report_json(spark: SparkSession, path: str, names: list[str], row: str) -> DataFrame:
    """(report, position, row) of reports written before; ``row`` is the rows' type."""
    read = [spark.read.schema(f"position long, row {row}").json(f"{path}/{name}").select(
        F.lit(name).alias("report"), "position", "row") for name in names]
    return reduce(DataFrame.unionByName, read)
