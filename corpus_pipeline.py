"""Quality classifier, line dedup, n-gram Jaccard join, decontamination and packing, one after another.

A stage's result is written before the next stage begins, so that one starts by deleting what the
stage before it has staged on its way; the disk holds the intermediate tables of one stage at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from basketlab.llm import decontaminate, jaccard_join, line_crf, line_dedup, packing
from basketlab.operators.staging import remove_paths, stage, staged_paths

_left: dict[str, list[str]] = {}


def _step(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, after the tables staged by the one before it are gone."""

    @wraps(function)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        remove_paths(spark, _left.pop(application, []))
        before = set(staged_paths(spark))
        found = function(spark, docs, sf_dir)
        _left[application] = [p for p in staged_paths(spark) if p not in before]
        return found

    return run_step


#: Each function takes (spark, docs, sf_dir); its rows are written and read again as the next one's docs.
STAGES = [
    ("quality_classifier", _step(line_crf.keep_good)),
    ("line_dedup", _step(line_dedup.drop_lines)),
    ("jaccard_join", _step(jaccard_join.keep_one_per_group)),
    ("decontamination", _step(decontaminate.drop_contaminated)),
    ("packing", _step(packing.pack_stage)),
]

#: The classifier is fitted, so SQL has no form of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents that every stage keeps."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline_{name}")
        remove_paths(spark, written)  # the documents that this stage has read
        written = staged_paths(spark)[-1:]
    remove_paths(spark, _left.pop(spark.sparkContext.applicationId, []))
    return docs
