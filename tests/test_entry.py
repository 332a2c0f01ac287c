"""Queries over the small test tables against their SQL."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, oracle
from checks.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
# One query per family here; ``python -m checks.compare`` runs all of them.
CHECKED = [
    "read_products_csv", "upsert", "parse_price", "products_by_category", "dim_time", "dim_product", "fact_sales",
    "check_keys", "pair_metrics", "category_pairs", "stratified_sample", "frequent_3_brands", "contains_all",
    "association_rules", "bundles", "ticket_anomalies", "report_comparison", "load_counts", "audit_counts",
]


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    outcome = compare(spark, con, FOLDER, name)
    assert outcome.startswith("ok"), outcome


def test_entry_gives_the_top_pairs(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"product_a", "product_b", "name_a", "name_b", "lift", "confidence_ab"}
    assert df.count() == 50


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
