import random
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from basketlab.operators import baskets as bk
from basketlab.operators import itemsets as its
from basketlab.operators import rules as rl
from basketlab.plans.mining import mine, sampled_lines
from tests.helpers import as_dict, baskets_frame, brute_sets, random_baskets


@pytest.mark.parametrize("huge,minimum", [(0, 1), (2, 2), (8, 4)])
def test_triples_equal_brute_force_with_huge_baskets(spark, huge, minimum):
    content = random_baskets(50 + huge * 10 + minimum, huge=huge)
    baskets = baskets_frame(spark, content)
    pairs = its.frequent_2(baskets, minimum)
    counted = its.frequent_3(baskets, pairs, minimum, big_basket=7)
    assert as_dict(counted, "abc") == brute_sets(content, 3, minimum)


def test_triples_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(its, "fits_broadcast", lambda df: False)
    content = random_baskets(8, huge=1)
    baskets = baskets_frame(spark, content)
    counted = its.frequent_3(baskets, its.frequent_2(baskets, 3), 3, big_basket=7)
    assert as_dict(counted, "abc") == brute_sets(content, 3, 3)


def test_supports_equal_fp_growth(spark):
    content = random_baskets(21, n_tickets=200, n_items=30)
    baskets = baskets_frame(spark, content)
    minimum = 6
    pairs = its.frequent_2(baskets, minimum)
    levels = [its.frequent_1(baskets, minimum), pairs, its.frequent_3(baskets, pairs, minimum)]
    ours = {tuple(r["items"]): r.support for r in its.frequent_itemsets(levels, 200).collect()}
    arrays = baskets.groupBy("ticket_id").agg(F.collect_set("item").alias("items"))
    model = FPGrowth(minSupport=minimum / 200, itemsCol="items").fit(arrays)
    theirs = {tuple(sorted(r["items"])): r.freq for r in model.freqItemsets.collect() if len(r["items"]) <= 3}
    assert ours == theirs
    for items, support in ours.items():
        assert all(ours[part] >= support for k in range(1, len(items)) for part in combinations(items, k))


def test_triples_are_counted_in_parts_of_a_bounded_size(spark, monkeypatch):
    content = random_baskets(6, n_tickets=200, huge=2)
    baskets, made, plain = baskets_frame(spark, content), {}, bk.stage
    pairs = its.frequent_2(baskets, 2)
    sizes = [len(items) for items in content.values()]
    assert bk.BasketGroups(baskets, 1, 7).n_triples == sum(n * (n - 1) * (n - 2) // 6 for n in sizes)

    def seen(df, name, parts=0):
        made[name] = parts
        return plain(df, name, parts)

    monkeypatch.setattr(bk, "stage", seen)
    monkeypatch.setattr(its, "COUNTED_TRIPLES", 20)
    counted = its.frequent_3(baskets, pairs, 2, big_basket=7)
    assert as_dict(counted, ["a", "b", "c"]) == brute_sets(content, 3, 2)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert usual < made["counted_sets"] <= -(-its.candidate_count(pairs) // 20)


def test_candidates_need_all_three_pairs(spark):
    pairs = spark.createDataFrame([(1, 2, 5), (1, 3, 5), (4, 5, 5), (4, 6, 5), (5, 6, 5)], "a long, b long, support long")
    assert its.candidate_count(pairs) == 2
    assert [tuple(r) for r in its.candidates_3(pairs).collect()] == [(4, 5, 6)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_candidates_with_an_item_that_pairs_with_all(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(its, "fits_broadcast", lambda df: False)
    rng = random.Random(5)
    edges = {(0, i) for i in range(1, 200)} | {tuple(sorted(rng.sample(range(200), 2))) for _ in range(900)}
    pairs = spark.createDataFrame([(a, b, 1) for a, b in edges], "a long, b long, support long")
    naive = {(a, b, c) for a, b in edges for x, c in edges if x == b and (a, c) in edges}
    found = [tuple(r) for r in its.candidates_3(pairs).collect()]
    assert len(found) == len(naive) and set(found) == naive


def test_level_decision(spark):
    pairs = spark.createDataFrame([(1, 2, 5), (1, 3, 5)], "a long, b long, support long")
    limits = its.LevelLimits
    assert its.level_decision(pairs) == "count triples"
    assert its.level_decision(pairs, limits(max_size=2)) == "triples disabled"
    assert its.level_decision(pairs, limits(triples_enabled=False)) == "triples disabled"
    assert its.level_decision(pairs, limits(max_pairs=1)) == "too many pairs"
    assert its.level_decision(pairs, limits(max_candidates=0)) == "too many candidates"
    assert its.level_decision(pairs.filter("a > 1")) == "no frequent pairs"
    assert its.level_decision(pairs.limit(1)) == "no candidates"


def test_scaled_support():
    assert [its.scaled_support(73, r) for r in (1.0, 0.15, 0.001)] == [73, 10, 1]


def test_six_rules_per_triple(spark):
    sets = spark.createDataFrame([([1, 2, 3], 4), ([1, 2], 5), ([9], 6)], "items array<bigint>, support long")
    found = {(tuple(r.antecedent), tuple(r.consequent), r.support) for r in rl.enumerate_rules(sets).collect()}
    assert found == {
        ((1,), (2, 3), 4), ((2,), (1, 3), 4), ((3,), (1, 2), 4), ((1, 2), (3,), 4), ((1, 3), (2,), 4), ((2, 3), (1,), 4),
        ((1,), (2,), 5), ((2,), (1,), 5),
    }


def brute_rules(content, minimum, min_confidence):
    n = len(content)
    supports = {}
    for size in (1, 2, 3):
        supports.update(brute_sets(content, size, minimum))
    found = {}
    for items, support in supports.items():
        for k in range(1, len(items)):
            for left in combinations(items, k):
                right = tuple(i for i in items if i not in left)
                confidence = support / supports[left]
                if confidence >= min_confidence:
                    share = supports[right] / n
                    certain = confidence >= 0.999999
                    found[left, right] = (
                        support, confidence, confidence / share, support / n - supports[left] / n * share,
                        999999.0 if certain else (1 - share) / (1 - confidence),
                    )
    return found


def test_rules_equal_brute_force(spark):
    content = random_baskets(33)
    baskets = baskets_frame(spark, content)
    pairs = its.frequent_2(baskets, 3)
    levels = [its.frequent_1(baskets, 3), pairs, its.frequent_3(baskets, pairs, 3)]
    sets = its.frequent_itemsets(levels, len(content))
    got = {
        (tuple(r.antecedent), tuple(r.consequent)): (r.support, r.confidence, r.lift, r.leverage, r.conviction)
        for r in rl.association_rules(sets, len(content), 0.3).collect()
    }
    want = brute_rules(content, 3, 0.3)
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=6e-7)


def test_certain_rule_has_fixed_conviction(spark):
    content = {1: {1, 2}, 2: {1, 2}, 3: {2}}
    baskets = baskets_frame(spark, content)
    sets = its.frequent_itemsets([its.frequent_1(baskets, 1), its.frequent_2(baskets, 1)], 3)
    rules = {r.antecedent_text: r for r in rl.association_rules(sets, 3).collect()}
    assert rules["[1]"].conviction == 999999.0 and rules["[1]"].confidence == 1.0
    assert rules["[2]"].confidence == 0.666667 and rules["[2]"].conviction == 1.0


def test_rules_need_known_sides(spark):
    pairs = spark.createDataFrame([(1, 2, 3)], "a long, b long, support long")
    singles = spark.createDataFrame([(1, 5)], "a long, support long")
    assert rl.association_rules(its.frequent_itemsets([singles, pairs], 10), 10).count() == 0


def test_extrapolation(spark):
    df = spark.createDataFrame([(3,), (20,)], "s long")
    assert [r[0] for r in df.select(rl.extrapolate_support(F.col("s"), 0.15)).collect()] == [20, 134]
    assert [r[0] for r in df.select(rl.extrapolate_support(F.col("s"), 1.0)).collect()] == [3, 20]


def _tickets(spark, n):
    return spark.range(n).select(
        F.col("id").alias("ticket_id"), F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 366 as int))").alias("sold_at")
    )


def test_mine_end_to_end(spark):
    content = random_baskets(4, n_tickets=120)
    lines = baskets_frame(spark, content).withColumnRenamed("item", "product_id")
    found = mine(_tickets(spark, 130), lines, "0.03", sample_rate=1.0, min_confidence=0.2)
    assert (found.n_tickets, found.min_support, found.decision) == (120, 4, "count triples")
    sets = {tuple(r["items"]): r.support for r in found.itemsets.collect()}
    assert sets == {**brute_sets(content, 1, 4), **brute_sets(content, 2, 4), **brute_sets(content, 3, 4)}
    assert found.rules.count() == len(brute_rules(content, 4, 0.2))


def test_mine_on_a_sample_uses_whole_tickets(spark):
    content = random_baskets(4, n_tickets=200)
    lines = baskets_frame(spark, content).withColumnRenamed("item", "product_id")
    tickets = _tickets(spark, 200)
    for by_season in (True, False):
        kept = sampled_lines(tickets, lines, 0.4, by_season=by_season).collect()
        chosen = {r.ticket_id for r in kept}
        assert 0 < len(chosen) < 120
        assert len(kept) == sum(len(content[k]) for k in chosen)


def test_mine_without_tickets(spark):
    lines = spark.createDataFrame([], "ticket_id long, product_id long")
    assert mine(_tickets(spark, 0), lines) is None
    assert mine(_tickets(spark, 5), lines, "0.1", 1.0) is None


def test_item_support_is_shared(hand):
    supports = bk.item_support(hand)
    assert as_dict(its.frequent_2(hand, 2, supports), "ab") == {(1, 2): 2, (1, 3): 2, (2, 3): 2}
