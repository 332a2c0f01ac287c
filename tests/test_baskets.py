from decimal import Decimal

import pytest

from basketlab.operators import baskets as bk
from basketlab.operators import pair_buckets, staging
from tests.helpers import as_dict, baskets_frame, brute_sets, random_baskets


def test_repeated_product_counts_once(spark):
    lines = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 5), (None, 5), (3, None)], "ticket_id long, product_id long")
    baskets = bk.basket_items(lines)
    assert baskets.count() == 3
    assert {r["item"]: r.support for r in bk.item_support(baskets).collect()} == {5: 2, 6: 1}


def test_hand_counts(hand):
    assert as_dict(bk.pair_support(hand), "ab") == {(1, 2): 2, (1, 3): 2, (2, 3): 2}
    assert as_dict(bk.pair_support(hand, 3), "ab") == {}


@pytest.mark.parametrize("n,rel,want", [(100, "0.01", 1), (101, "0.01", 2), (0, "0.5", 1), (2_920_000, "0.000025", 73), (3, 0.1, 1), (30, 0.1, 3)])
def test_min_pair_support(n, rel, want):
    assert bk.min_pair_support(n, rel) == want
    assert bk.min_pair_support(n, Decimal(str(rel))) == want


@pytest.mark.parametrize("huge,minimum", [(0, 3), (1, 1), (4, 3), (9, 4)])
def test_pairs_equal_brute_force_with_huge_baskets(spark, huge, minimum):
    content = random_baskets(huge * 10 + minimum, huge=huge)
    baskets = baskets_frame(spark, content)
    counted = bk.pair_support(baskets, minimum, big_basket=7)
    assert as_dict(counted, "ab") == brute_sets(content, 2, minimum)


def test_groups_set_aside_at_most_one_less_than_the_minimum(spark):
    content = random_baskets(3, huge=5)
    groups = bk.BasketGroups(baskets_frame(spark, content), 3, big_basket=8)
    largest = sorted(content, key=lambda k: (-len(content[k]), k))[:2]
    assert {r.ticket_id for r in groups.set_aside.select("ticket_id").distinct().collect()} == set(largest)
    assert {r.ticket_id for r in groups.big.select("ticket_id").distinct().collect()} == {
        k for k, v in content.items() if len(v) > 8 and k not in largest
    }
    assert groups.normal.count() == sum(len(v) for v in content.values() if len(v) <= 8)


def test_blocks_list_every_pair_once(spark):
    content = {1: set(range(40)), 2: set(range(20, 45))}
    groups = bk.BasketGroups(baskets_frame(spark, content), 1, big_basket=6)
    listed = bk.ticket_pairs_by_block(groups.big)
    assert listed.count() == listed.distinct().count() == 40 * 39 // 2 + 25 * 24 // 2


def test_frequent_only_does_not_change_counts(spark):
    content = random_baskets(11)
    baskets = baskets_frame(spark, content)
    pruned = bk.frequent_only(baskets, 5)
    assert pruned.count() < baskets.count()
    assert as_dict(bk.pair_support(pruned, 5), "ab") == brute_sets(content, 2, 5)


def test_contains_all_equals_brute_force(spark):
    content = random_baskets(5, huge=2)
    baskets = baskets_frame(spark, content)
    sets = [[0], [0, 1], [0, 1, 2], [3, 9, 11, 0], [4, 99], [77]]
    counted = bk.contains_all(spark.createDataFrame([(s,) for s in sets], "items array<bigint>"), baskets)
    got = {tuple(r["items"]): r.support for r in counted.collect()}
    assert got == {tuple(s): sum(set(s) <= v for v in content.values()) for s in sets}


def test_string_items(spark):
    rows = [(1, "x"), (1, "y"), (2, "y"), (2, "x"), (3, "x")]
    baskets = spark.createDataFrame(rows, "ticket_id long, item string")
    assert as_dict(bk.pair_support(baskets, 2), "ab") == {("x", "y"): 2}


def test_pair_join_has_ticket_as_key(hand):
    plan = bk.pair_support(hand, 1)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_listing_parts_grow_with_the_baskets(spark, monkeypatch):
    content = random_baskets(9, n_tickets=300)
    baskets = bk.stage(baskets_frame(spark, content), "baskets")
    monkeypatch.setattr(bk, "LISTED_BYTES", baskets.measured // 20)
    assert bk.listing_parts(baskets) in (20, 21)
    assert bk.BasketGroups(baskets, 2, parts=bk.listing_parts(baskets)).normal.rdd.getNumPartitions() == bk.listing_parts(baskets)
    assert "REPARTITION_BY_NUM" in bk.pair_support(baskets, 2)._jdf.queryExecution().executedPlan().toString()
    assert as_dict(bk.pair_support(baskets, 2), "ab") == brute_sets(content, 2, 2)


def test_pairs_are_counted_in_parts_of_a_bounded_size(spark, monkeypatch):
    baskets = random_baskets(3, n_tickets=200, huge=4)
    sizes = sorted(len(items) for items in baskets.values())
    frame = baskets_frame(spark, baskets)
    groups = bk.BasketGroups(frame, 3, 10)
    assert groups.n_set_aside == 2 and groups.n_pairs == sum(n * (n - 1) // 2 for n in sizes[:-2])

    usual, plain, made = spark.conf.get("spark.sql.shuffle.partitions"), staging.stage, {}

    def seen(df, name, parts=0):
        made[name] = parts
        return plain(df, name, parts)

    monkeypatch.setattr(bk, "stage", seen)
    monkeypatch.setattr(bk, "COUNTED_PAIRS", 50)
    for minimum in (1, 3):
        assert as_dict(bk.pair_support(frame, minimum, big_basket=10), ["a", "b"]) == brute_sets(baskets, 2, minimum)
        assert made.pop("counted_sets") > int(usual)
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
    with staging.shuffled_into(spark, 99):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "99"


def test_baskets_are_made_and_sized_in_parts_of_a_bounded_size(spark, tmp_path, monkeypatch):
    baskets = random_baskets(5, n_tickets=300)
    baskets_frame(spark, baskets).write.parquet(f"{tmp_path}/lines")
    lines = spark.read.parquet(f"{tmp_path}/lines").withColumnRenamed("item", "product_id")
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    usual, shuffled, made = [spark.conf.get(k) for k in keys], staging.shuffled_into, []

    def seen(session, parts):
        made.append((parts, session.conf.get(keys[1])))
        return shuffled(session, parts)

    monkeypatch.setattr(bk, "GROUPED_ROWS", 20)
    monkeypatch.setattr(bk, "LISTED_BYTES", 640)
    monkeypatch.setattr(bk, "shuffled_into", seen)
    monkeypatch.setattr(staging, "shuffled_into", seen)
    staged = bk.stage_baskets(bk.basket_items(lines))
    parts = -(-lines.count() // 20)
    assert made == [(parts, f"{bk.SCANNED_BYTES}b")] and parts > int(usual[0])
    made.clear()
    groups = bk.BasketGroups(staged, 2, parts=bk.listing_parts(staged))
    assert made[0] == (parts, f"{bk.SCANNED_BYTES}b")
    assert groups.n_pairs == sum(len(i) * (len(i) - 1) // 2 for i in baskets.values()) == pair_buckets.listed_pairs(staged)
    assert [spark.conf.get(k) for k in keys] == usual
    assert as_dict(bk.pair_support(bk.basket_items(lines), 2), ["a", "b"]) == brute_sets(baskets, 2, 2)


def test_no_baskets_have_no_pairs(spark):
    empty = spark.createDataFrame([], "ticket_id long, item long")
    assert bk.BasketGroups(empty, 2).n_pairs == 0 and bk.pair_support(empty, 1).count() == 0
