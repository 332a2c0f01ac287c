"""Product files in CSV."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from basketlab import schemas
from basketlab.operators.cleanse import fill_frequency, normalize_headers, reject_bad_rows, require_columns
from basketlab.operators.joins import lookup_join
from basketlab.operators.quality import duplicate_keys
from basketlab.operators.staging import stage

# Required headers, and the optional one.
REQUIRED = ["identificador", "producto", "precio", "categoria"]
OPTIONAL = "frecuencia"
RECORD = "whole_record"


def files_by_encoding(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by their encoding: UTF-8, or ISO-8859-1 where some line holds bytes that are no UTF-8.

    The text source keeps bytes as they are, so the test sees each file itself. The result
    holds one name per file.
    """
    tested = spark.read.text(path).groupBy(F.input_file_name().alias("file")).agg(F.bool_and(F.is_valid_utf8("value")).alias("valid"))
    found: dict[str, list[str]] = {}
    for row in sorted(tested.collect()):
        found.setdefault("UTF-8" if row["valid"] else "ISO-8859-1", []).append(unquote(row["file"]))
    return found


def record_column(columns: list[str]) -> str:
    """A name for whole malformed records that no header takes."""
    taken, name = {c.strip().lower() for c in columns}, RECORD
    while name in taken:
        name += "_"
    return name


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, str]:
    """CSV files with headers, all columns as text, parsed and stored once; and the name of one more column.

    That column holds the whole record where its number of fields is not the header's, and NULL
    elsewhere. Fails when the file is missing, has no rows, or when files of one encoding have
    different headers.
    """
    try:
        encodings = files_by_encoding(spark, path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(path) from error
        raise
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    headers = {encoding: reader.option("encoding", encoding).csv(files).columns for encoding, files in encodings.items()}
    record = record_column([c for columns in headers.values() for c in columns])
    # Without pruning every record is compared with the whole header.
    reader = reader.option("columnNameOfCorruptRecord", record).option("columnPruning", False).option("enforceSchema", False)
    read = []
    for encoding, files in encodings.items():
        layout = T.StructType([T.StructField(c, T.StringType()) for c in [*headers[encoding], record]])
        read.append(reader.option("encoding", encoding).schema(layout).csv(files))
    df = stage(reduce(DataFrame.unionByName, read), "csv_records") if read and all(headers.values()) else None
    if df is None or df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df, record


def read_products_csv(
    spark: SparkSession, path: str, seed: int = 42, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Products of CSV files, and the rows that cannot be loaded.

    Those have too many or too few fields (the whole record is kept in the last column, ``whole_record``), no
    readable id or price, an empty name or category, or an id that other loadable rows have
    too: none of such rows can be told to be the right one.
    """
    parsed, record = read_csv(spark, path, multi_line)
    raw = require_columns(normalize_headers(parsed), REQUIRED)
    malformed = raw.filter(F.col(record).isNotNull())
    good, bad = reject_bad_rows(raw.filter(F.col(record).isNull()), "precio", "price")
    product_id = F.col("identificador").try_cast("bigint")
    empty = F.lit(False)
    for column in ("producto", "categoria"):
        empty = empty | (F.trim(F.coalesce(column, F.lit(""))) == "")
    usable = product_id.isNotNull() & ~empty
    bad = bad.unionByName(malformed).unionByName(good.filter(~usable).select(*raw.columns))
    typed = good.filter(usable).withColumn("product_id", product_id)
    repeated = duplicate_keys(typed, ["product_id"]).select("product_id")
    # Rows of one repeated id may be many; the ids themselves are few or spread.
    bad = bad.unionByName(lookup_join(typed, repeated, ["product_id"], "left_semi").select(*raw.columns))
    typed = lookup_join(typed, repeated, ["product_id"], "left_anti")
    typed = typed.withColumnsRenamed({"producto": "product_name", "categoria": "category", OPTIONAL: "frequency"})
    columns = [f.name for f in schemas.PRODUCTS.fields]
    return fill_frequency(typed, seed=seed).select(*columns), bad
