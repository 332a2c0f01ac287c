"""One ticket, one product and one category each hold a third of all lines."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlab import schemas
from basketlab.operators import baskets as bk
from basketlab.operators import cleanse, insights, itemsets, joins, staging, star
from basketlab.plans.mining import mine
from tests.helpers import as_dict, baskets_frame, brute_sets

N_ITEMS = 60


@pytest.fixture(scope="module")
def content():
    baskets = {t: {0, 1 + t % (N_ITEMS - 1), 1 + (t * 7) % (N_ITEMS - 1)} for t in range(1, 120)}
    baskets[0] = set(range(N_ITEMS))
    return baskets


@pytest.fixture(scope="module")
def lines(spark, content):
    rows = [(t, p, 1, Decimal("2.00")) for t, ps in content.items() for p in sorted(ps)]
    rows += [(0, p, 1, Decimal("2.00")) for p in range(N_ITEMS)] * 3
    return spark.createDataFrame(rows, schemas.LINES)


@pytest.fixture(scope="module")
def tickets(spark, content):
    rows = [(t, datetime(2024, 1 + t % 12, 1), f"u{t}", Decimal("9.00"), 3) for t in content]
    return spark.createDataFrame(rows, schemas.TICKETS)


@pytest.fixture(scope="module")
def products(spark):
    rows = [(i, f"p{i}", Decimal("1.00"), "big" if i < 20 else f"c{i % 7}") for i in range(N_ITEMS)]
    return spark.createDataFrame(rows, "product_id long, product_name string, price decimal(10,2), category string")


@pytest.fixture
def shuffled(monkeypatch):
    """No broadcast by our own choice, hot keys found exactly, small basket limit."""
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HOT_MIN_ROWS", 2)
    found = []
    original = joins.hot_keys

    def exact(df, on, *rest, **more):
        keys = original(df, on, fraction=0.1, sample=1.0, min_rows=2)
        found.extend(tuple(k) for k in keys)
        return keys

    monkeypatch.setattr(joins, "hot_keys", exact)
    monkeypatch.setattr(star, "hot_keys", exact)
    monkeypatch.setattr(insights, "hot_keys", exact)
    monkeypatch.setattr(itemsets, "hot_keys", exact)
    monkeypatch.setattr(bk, "hot_keys", exact)
    return found


def test_facts(lines, tickets, products, shuffled):
    facts = star.fact_sales(lines, tickets, star.dim_product(products))
    assert (0,) in shuffled
    assert facts.count() == lines.count()
    assert facts.groupBy("ticket_id").count().filter("ticket_id = 0").first()["count"] == 4 * N_ITEMS


def test_totals_and_metrics(lines, products, content, shuffled):
    totals = {r.ticket_id: r.total_amount for r in cleanse.ticket_totals(lines).collect()}
    assert totals[0] == 2 * 4 * N_ITEMS
    baskets = bk.basket_items(lines)
    pairs = insights.pair_metrics(bk.pair_support(baskets, 2, big_basket=10), bk.item_support(baskets), products, 120)
    got = {(r.product_a, r.product_b): r.support for r in pairs.collect()}
    assert got == brute_sets(content, 2, 2)


def test_triples_of_a_large_basket_and_hot_ends(spark, shuffled, monkeypatch):
    monkeypatch.setattr(itemsets, "BIG_TRIPLE_BASKET", 10)
    rng = random.Random(3)
    baskets = {0: set(range(60)), 1: set(range(60))} | {t: {0, 1, rng.randrange(2, 60), rng.randrange(2, 60)} for t in range(2, 150)}
    frame = staging.stage(baskets_frame(spark, baskets), "baskets")
    pairs = staging.stage(bk.pair_support(frame, 3, big_basket=10), "pairs")
    assert as_dict(itemsets.frequent_3(frame, pairs, 3), "abc") == brute_sets(baskets, 3, 3)
    known = set(brute_sets(baskets, 2, 3))
    want = {(a, b, c) for a, b in known for c in range(60) if (a, c) in known and (b, c) in known and b < c}
    assert {tuple(r) for r in itemsets.candidates_3(pairs).collect()} == want


def test_mining(tickets, lines, content, shuffled, monkeypatch):
    monkeypatch.setattr(bk, "BIG_BASKET", 10)
    found = mine(tickets, lines, "0.02", 1.0, min_confidence=0.5)
    sets = {tuple(r["items"]): r.support for r in found.itemsets.collect()}
    assert sets == {**brute_sets(content, 1, 3), **brute_sets(content, 2, 3), **brute_sets(content, 3, 3)}


def test_category_pairs(lines, products, content, shuffled):
    name = {r.product_id: r.category for r in products.collect()}
    baskets = {t: {name[p] for p in ps} for t, ps in content.items()}
    got = insights.category_pairs(lines, products, 120, min_support=2)
    listed = got.select(F.col("category_a").alias("a"), F.col("category_b").alias("b"), "support")
    assert as_dict(listed, "ab") == brute_sets(baskets, 2, 2)
