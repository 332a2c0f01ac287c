"""Keys beside the columns of any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlab.operators.staging import stage


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keyed_rows(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The table written once with a number for each row, and the number's column; ids may be null or repeated."""
    key = unused(docs, "_row")
    return stage(docs.withColumn(key, F.monotonically_increasing_id()), name), key


def id_key(doc_id: str) -> Column:
    """The id as text; null counts as the empty id."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
