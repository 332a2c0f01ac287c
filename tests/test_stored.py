"""Stored forms: buckets of tickets, months of facts, merged tables, bitmaps, buckets of pairs, column statistics."""

import random
import time
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketlab import schemas
from basketlab.operators import baskets as bk
from basketlab.operators import itemsets as its
from basketlab.operators import insights, key_bitmaps, pair_buckets, quality, star, ticket_bitmaps
from basketlab.operators.running import running_sums
from basketlab.sources import fact_store, merge_store, tables, ticket_store
from tests.helpers import as_dict, baskets_frame, brute_sets, random_baskets


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(spark):
    """Lines of which one ticket holds a third, tickets over two years, products."""
    rng = random.Random(4)
    lines = [(t, rng.randint(1, 40), rng.randint(1, 5), Decimal(rng.randint(100, 9999)) / 100) for t in range(1, 301) for _ in range(rng.randint(1, 6))]
    lines += [(7, k % 45, 1, Decimal("1.00")) for k in range(5000)] + [(9999, 3, 1, Decimal("1.00"))]
    tickets = [(t, datetime(2023, 1, 1) + timedelta(days=(t * 37) % 700), f"u{t}", Decimal("100.00"), 3) for t in range(1, 301)]
    products = [(p, f"product {p}", Decimal("10.00"), f"c{p % 3}") for p in range(1, 44)]
    return (
        spark.createDataFrame(lines, schemas.LINES).repartition(4), spark.createDataFrame(tickets, schemas.TICKETS),
        star.dim_product(spark.createDataFrame(products, "product_id long, product_name string, price decimal(10,2), category string")))


# --- Buckets of pairs --------------------------------------------------------


@pytest.mark.parametrize("huge", [0, 3])
@pytest.mark.parametrize("minimum", [1, 2, 5, 30])
def test_prefiltered_pairs_equal_brute_force(spark, huge, minimum):
    content = random_baskets(11, n_tickets=150, huge=huge)
    found = pair_buckets.prefiltered_pair_support(baskets_frame(spark, content), minimum, big_basket=8)
    assert as_dict(found, ["a", "b"]) == brute_sets(content, 2, minimum)


def test_the_first_pass_keeps_frequent_pairs_and_drops_others(spark):
    rng = random.Random(1)
    content = {t: {*rng.sample(range(400), 6), *((1000, 1001) if t % 20 == 0 else ())} for t in range(600)}
    baskets = baskets_frame(spark, content)
    passes = pair_buckets.Prefilter(baskets, 10)
    listed, kept = passes.listed().count(), passes.kept().count()
    assert listed == passes.n_listed and kept < listed / 5
    assert as_dict(passes.support(), ["a", "b"]) == brute_sets(content, 2, 10)
    assert "BroadcastHashJoin" in plan(passes.kept())


def test_bucket_numbers_are_bounded():
    assert pair_buckets.bucket_number(0, 5) == pair_buckets.LEAST_BUCKETS
    assert pair_buckets.bucket_number(115_729, 2) == 1 << 18
    assert pair_buckets.bucket_number(10**12, 10**6) == 1 << 22
    assert pair_buckets.bucket_number(10**12, 10**5) == pair_buckets.MAX_BUCKETS
    assert pair_buckets.bucket_number(10**12, 1000) is None


def test_too_many_pairs_for_the_buckets_are_counted_plainly(spark, monkeypatch):
    monkeypatch.setattr(pair_buckets, "MAX_BUCKETS", 2)
    content = random_baskets(3)
    passes = pair_buckets.Prefilter(baskets_frame(spark, content), 2)
    assert passes.words is None and as_dict(passes.support(), ["a", "b"]) == brute_sets(content, 2, 2)


# --- Buckets of tickets ------------------------------------------------------


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture
def store(spark, shop, tmp_path):
    lines, tickets, _ = shop
    store = ticket_store.store_by_ticket(lines, tickets, str(tmp_path), "shop", 4)
    yield store
    ticket_store.forget_store(spark, "shop")


def test_stored_facts_and_baskets_equal_the_plain_ones(shop, store):
    lines, tickets, products = shop
    facts = star.fact_sales(lines, tickets, products)
    assert rows(ticket_store.stored_facts(store, products)) == rows(facts)
    assert rows(ticket_store.stored_baskets(store, products)) == rows(bk.basket_items(facts))
    assert [r.ticket_id for r in store.hot_lines.select("ticket_id").distinct().collect()] == [7]


def test_nothing_is_shuffled_by_the_ticket(spark, shop, store):
    no_broadcast(spark)
    try:
        facts = ticket_store.stored_facts(store, shop[2])
        listed = ticket_store.stored_baskets(store, shop[2])
        pairs = bk.ticket_pairs(listed).groupBy("a", "b").count()
        sizes = store.baskets.groupBy("ticket_id").count()
        for df in (facts, listed, pairs, sizes):
            assert "hashpartitioning(ticket_id" not in plan(df)
        assert "SortMergeJoin" in plan(facts) and "hashpartitioning(a" in plan(pairs)
        plain = star.fact_sales(*shop, hot=[])
        assert "hashpartitioning(ticket_id" in plan(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_store_without_hot_tickets_or_rows_is_replaced_by_the_next(spark, shop, store, tmp_path):
    lines, tickets, products = shop
    few = lines.filter("ticket_id IN (1, 2, 3)")
    again = ticket_store.store_by_ticket(few, tickets, str(tmp_path), "shop", 4)
    assert rows(ticket_store.stored_facts(again, products)) == rows(star.fact_sales(few, tickets, products))
    none = ticket_store.store_by_ticket(few.filter("ticket_id < 0"), tickets, str(tmp_path), "shop", 4)
    assert ticket_store.stored_facts(none, products).count() == 0 == none.baskets.count()


# --- Months of facts ---------------------------------------------------------


def test_only_matching_months_are_read(spark, shop, tmp_path):
    lines, tickets, products = shop
    facts, path = star.fact_sales(lines, tickets, products), str(tmp_path / "facts")
    fact_store.store_facts(facts, path)
    stored = fact_store.read_facts(spark, path)
    assert rows(stored.drop("month_key").select(*facts.columns)) == rows(facts)
    calendar = star.dim_time(tickets)
    of_june = rows(fact_store.facts_of_days(stored, calendar, F.col("month") == 6).select(*facts.columns))
    june = {f"month_key={y}06" for y in (2023, 2024)}
    folders = [p for p in Path(path).glob("month_key=*")]
    assert len(folders) > 12 and of_june == rows(facts.filter("floor(date_key / 100) % 100 = 6"))
    assert "dynamicpruning" in plan(fact_store.facts_of_days(stored, calendar, F.col("month") == 6))
    # Files of all other months become unreadable; the same question still has its answer.
    stored = fact_store.read_facts(spark, path)
    for folder in folders:
        if folder.name not in june:
            for file in folder.glob("*.parquet"):
                (folder / f".{file.name}.crc").unlink(missing_ok=True)
                file.write_bytes(b"broken")
    assert rows(fact_store.facts_of_days(stored, calendar, F.col("month") == 6).select(*facts.columns)) == of_june
    with pytest.raises(Exception):
        stored.agg(F.sum("amount")).collect()


def test_a_season_by_category(spark, shop, tmp_path):
    lines, tickets, products = shop
    facts, path = star.fact_sales(lines, tickets, products), str(tmp_path / "facts")
    fact_store.store_facts(facts, path)
    want = {}
    category = {r.product_key: r.category for r in products.collect()}
    period = {r.date_key: r.period for r in star.dim_time(tickets).filter("season = 'Verano'").collect()}
    for r in facts.collect():
        if r.date_key in period:
            total = want.setdefault((period[r.date_key], category[r.product_key]), [Decimal(0), 0, 0])
            total[0] += r.amount
            total[1] += r.quantity
            total[2] += 1
    found = fact_store.season_sales(fact_store.read_facts(spark, path), star.dim_time(tickets), products, "Verano")
    assert {(r.period, r.category): [r.amount, r.quantity, r.n_lines] for r in found.collect()} == want


def test_replacing_months_leaves_the_others_alone(spark, shop, tmp_path):
    facts, path = star.fact_sales(*shop), str(tmp_path / "facts")
    fact_store.store_facts(facts, path)
    before = files(path)
    june = facts.filter("floor(date_key / 100) = 202306").withColumn("quantity", F.lit(1).cast("long"))
    for _ in range(2):
        fact_store.replace_months(june, path)
        after = files(path)
        assert {f for f in before.items() if "202306" not in f[0]} == {f for f in after.items() if "202306" not in f[0]}
        assert rows(fact_store.read_facts(spark, path).filter("month_key = 202306").select(*facts.columns)) == rows(june)


# --- Merged tables -----------------------------------------------------------


def files(path):
    return {str(p.relative_to(path)): (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(path).rglob("*.parquet")}


def test_merges_rewrite_touched_folders_only_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "rules")
    old = spark.range(200).select("id", (F.col("id") * 2).alias("v"), F.lit("old").alias("kind"))
    merge_store.create_store(old, path, ["id"], 16)
    assert rows(merge_store.read_store(spark, path)) == rows(old)
    before = files(path)
    new = spark.createDataFrame([(3, -3, "new"), (1000, -1000, "new")], "id long, v long, kind string")
    want = sorted([(i, -3 if i == 3 else i * 2, "old") for i in range(200)] + [(1000, -1000, "new")])
    for _ in range(2):
        time.sleep(0.01)
        touched = merge_store.merge_store(new, path, ["id"], 16, ["v"])
        assert touched <= 2 and rows(merge_store.read_store(spark, path)) == want
        parts = {f"key_part={r[0]}" for r in new.select(merge_store.key_part(["id"], 16)).collect()}
        kept = {f: s for f, s in before.items() if f.split("/")[0] not in parts}
        assert len(kept) >= 10 and kept.items() <= files(path).items()
    assert merge_store.merge_store(new.withColumn("v", F.lit(5).cast("long")), path, ["id"], 16, ignore_known=True) == touched
    assert rows(merge_store.read_store(spark, path)) == want
    assert merge_store.merge_store(new.filter("id < 0"), path, ["id"], 16) == 0


def test_a_repeated_key_stops_a_merge_before_the_table_changes(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_store.create_store(spark.createDataFrame([("a", "x", 1)], "k string, l string, v long"), path, ["k", "l"], 4)
    before = files(path)
    twice = spark.createDataFrame([("a", "x", 2), ("a", "x", 3)], "k string, l string, v long")
    with pytest.raises(Exception, match="repeated key"):
        merge_store.merge_store(twice, path, ["k", "l"], 4)
    assert files(path) == before
    merge_store.merge_store(twice.filter("v = 3"), path, ["k", "l"], 4)
    assert rows(merge_store.read_store(spark, path)) == [("a", "x", 3)]


# --- Bitmaps -----------------------------------------------------------------


@pytest.mark.parametrize("broadcast", [True, False])
def test_set_supports_by_bitmaps_equal_brute_force(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(ticket_bitmaps, "fits_broadcast", lambda df: False)
    content = random_baskets(2, n_tickets=120, n_items=12, huge=20)
    content = {t * 1000: items for t, items in content.items()}  # tickets in several buckets
    sets = [list(c) for size in (1, 2, 3, 4, 5) for c in combinations(range(8), size)] + [[1, 77], [99]]
    bitmaps = ticket_bitmaps.ticket_bitmaps(baskets_frame(spark, content), item="item")
    found = ticket_bitmaps.contains_all_by_bitmaps(spark.createDataFrame([(s,) for s in sets], "items array<bigint>"), bitmaps)
    want = {tuple(s): sum(set(s) <= items for items in content.values()) for s in sets}
    assert {tuple(r["items"]): r["support"] for r in found.collect()} == want


def test_bitmaps_merge_over_loads(spark):
    content = random_baskets(5, n_tickets=80)
    frame = baskets_frame(spark, content).withColumn("ticket_id", F.col("ticket_id") * 700)
    shares = [frame.filter("item % 3 <> 0"), frame.filter("item % 3 <> 1"), frame.filter("item < 0")]
    merged = ticket_bitmaps.merge_bitmaps(*[ticket_bitmaps.ticket_bitmaps(s, item="item") for s in shares])
    assert rows(ticket_bitmaps.bitmap_supports(merged)) == rows(bk.item_support(frame))
    counted = ticket_bitmaps.bitmap_basket_counts(merged).first()
    n_pairs = sum(map(len, content.values()))
    assert tuple(counted) == (its.count_tickets(frame), n_pairs, n_pairs / len(content))
    lines = frame.withColumnRenamed("item", "product_id")
    assert counted.avg_items == quality.avg_distinct_items(lines).first().avg_items
    empty = ticket_bitmaps.ticket_bitmaps(frame.filter("item < 0"), item="item")
    assert tuple(ticket_bitmaps.bitmap_basket_counts(empty).first()) == (0, 0, 0.0)


def test_bitmaps_take_no_more_room_than_the_lines(spark):
    lines = spark.range(60_000).select((F.col("id") * 7919 % 600_000).alias("ticket_id"), (F.col("id") % 20_000).alias("product_id"))
    bitmaps = ticket_bitmaps.stage(ticket_bitmaps.ticket_bitmaps(lines), "ticket_bitmaps")
    assert bitmaps.measured <= 60_000 * 48  # of 4 KB each they took 245 MB
    assert rows(ticket_bitmaps.bitmap_supports(bitmaps)) == [(p, 3) for p in range(20_000)]


def test_dense_sets_meet_their_bucket_without_a_shuffle_by_the_set(spark, monkeypatch):
    monkeypatch.setattr(ticket_bitmaps, "SETS_AT_ONCE", 20)
    rng = random.Random(11)
    content = {t: set(rng.sample(range(8), 5)) for t in [*range(-70, 500), *range(32_000, 33_500)]}
    sets = [list(c) for size in (1, 2, 3, 4) for c in combinations(range(8), size)] + [[1, 77], [99]]
    bitmaps = ticket_bitmaps.ticket_bitmaps(baskets_frame(spark, content), item="item")
    frame = spark.createDataFrame([(s,) for s in sets], "items array<bigint>")
    want = {tuple(s): sum(set(s) <= items for items in content.values()) for s in sets}
    for dense in (1, 10**9):  # by buckets and by words
        monkeypatch.setattr(ticket_bitmaps, "DENSE_WORDS", dense)
        found = ticket_bitmaps.contains_all_by_bitmaps(frame, bitmaps)
        assert {tuple(r["items"]): r["support"] for r in found.collect()} == want
        shuffles = [line for line in plan(found).splitlines() if "Exchange hashpartitioning(" in line]
        assert not any("items#" in line and "bucket#" in line.split("Exchange", 1)[1].split(")", 1)[0] for line in shuffles)
    monkeypatch.setattr(ticket_bitmaps, "DENSE_WORDS", 1)
    monkeypatch.setattr(ticket_bitmaps, "MEMBER_BYTES", 2_000)  # several passes
    found = ticket_bitmaps.contains_all_by_bitmaps(frame, bitmaps)
    assert {tuple(r["items"]): r["support"] for r in found.collect()} == want


def test_missing_parents_by_bitmaps(spark, monkeypatch):
    child = spark.range(0, 200_000, 7).select((F.col("id") % 100_000).alias("k"), "id").unionByName(
        spark.createDataFrame([(None, -1), (500_000, -2), (500_000, -3), (-5, -4)], "k long, id long"))
    parent = spark.range(100_000).select(F.col("id").alias("k")).filter("k % 9001 <> 0")
    want = rows(quality.missing_parents(child, parent, ["k"]).select("id"))
    for least in (64, 10**9):  # by bitmaps, and the plain way of sparse keys
        monkeypatch.setattr(key_bitmaps, "LEAST_KEYS", least)
        assert rows(key_bitmaps.missing_by_bitmaps(child, parent, "k").select("id")) == want
    assert rows(key_bitmaps.incomplete_buckets(key_bitmaps.key_bitmaps(parent, "k"), key_bitmaps.key_bitmaps(parent, "k"))) == []
    assert tuple(key_bitmaps.count_missing(child, child, "k").first()) == (1, 0)


def test_rows_of_complete_buckets_are_not_shuffled(spark):
    child = spark.range(0, 300_000).select((F.col("id") % 90_000).alias("k"))
    parents = key_bitmaps.key_bitmaps(spark.range(0, 80_000).select(F.col("id").alias("k")), "k")
    found = key_bitmaps.incomplete_buckets(key_bitmaps.key_bitmaps(child, "k"), parents)
    assert [tuple(r) for r in found.collect()] == [(3, 10_000)]  # of the buckets 1, 2 and 3


# --- Counts without loops, statistics ----------------------------------------


def test_running_sums_over_ranges(spark):
    df = spark.range(0, 1000).select("id", (F.col("id") % 7).alias("v")).repartition(5)
    found = running_sums(df, [F.desc("id")], {"total": "v"}).collect()
    assert {r.id: r.total for r in found} == {i: sum(k % 7 for k in range(i, 1000)) for i in range(1000)}


def test_level_counts_equal_the_counts_of_each_level(spark):
    content = random_baskets(8, n_tickets=100, n_items=14)
    pairs = bk.pair_support(baskets_frame(spark, content), 1)
    supports = {(r.a, r.b): r.support for r in pairs.collect()}
    want = []
    for least in sorted(set(supports.values())):
        starts = Counter(a for (a, _), n in supports.items() if n >= least)
        want.append((least, sum(starts.values()), sum(d * (d - 1) // 2 for d in starts.values())))
    counts = its.level_counts(pairs)
    assert rows(counts) == want
    limits = its.LevelLimits(max_pairs=60, max_candidates=10)
    decided = counts.select("min_support", its.decision_of(F.col("n_pairs"), F.col("n_candidates"), limits).alias("d"))
    assert {r.min_support: r.d for r in decided.collect()} == {
        least: its.level_decision(pairs.filter(F.col("support") >= least), limits) for least, _, _ in want}


@pytest.mark.parametrize("n, limit, want", [(0, None, "no pairs"), (5, 4, "too many pairs"), (5, 5, "ok"), (5, None, "ok")])
def test_limit_status(spark, n, limit, want):
    assert spark.range(1).select(insights.limit_status(F.lit(n), limit)).first()[0] == want


def test_hot_pairs_come_from_their_supports(spark):
    pairs = spark.createDataFrame([(1, 2, 900)] + [(3, k, 1) for k in range(4, 2000)], "a long, b long, support long")
    assert its.hot_pairs(pairs) == [(1, 2)]


def test_column_statistics_are_stored_and_change_a_plan(spark, tmp_path):
    # A million rows, of which the histogram knows that almost none lie above 900.
    facts = spark.range(200_000).select(F.when(F.col("id") % 10_000 == 0, 950).otherwise(F.col("id") % 100).alias("v"), (F.col("id") % 5000).alias("k"), F.lit("x" * 40).alias("pad"))
    other = spark.range(200_000).select((F.col("id") % 5000).alias("k"), F.lit("y" * 40).alias("more"))
    tables.save_table(facts, "stat_facts", str(tmp_path / "facts"))
    tables.save_table(other, "stat_other", str(tmp_path / "other"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    question = "SELECT f.k, more FROM stat_facts f JOIN stat_other o ON f.k = o.k WHERE f.v > 900"
    try:
        quality.refresh_statistics(spark, ["stat_facts", "stat_other"])
        with quality.cost_based_plans(spark):
            assert "SortMergeJoin" in plan(spark.sql(question))
        quality.refresh_statistics(spark, ["stat_facts", "stat_other"], {"stat_facts": ["v", "k"], "stat_other": ["k"]}, bins=32)
        found = {r.column_name: r for r in quality.column_statistics(spark, "stat_facts", ["v", "k", "pad"]).collect()}
        assert (found["v"].min, found["v"].max, found["v"].num_nulls, found["v"].bins) == ("0", "950", 0, 32)
        assert abs(found["k"].distinct_count - 5000) < 500 and found["pad"].num_nulls is None
        with quality.cost_based_plans(spark):
            assert "BroadcastHashJoin" in plan(spark.sql(question))
        assert spark.conf.get("spark.sql.cbo.enabled") == "false" == spark.conf.get("spark.sql.statistics.histogram.enabled")
        assert "SortMergeJoin" in plan(spark.sql(question))
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
        for name in ("stat_facts", "stat_other"):
            spark.sql(f"DROP TABLE {name}")
