"""Star schema, insights, reports, checks and the full run."""

from datetime import datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from basketlab import schemas
from basketlab.operators import baskets as bk
from basketlab.operators import insights, quality, star
from basketlab.operators.rules import association_rules
from basketlab.operators.itemsets import frequent_1, frequent_2, frequent_itemsets
from basketlab.plans import reports
from basketlab.plans.use_cases import Thresholds, run_use_cases, run_use_cases_simple
from basketlab.streaming import fact_stream


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def products(spark):
    content = [(i, f"product {i}", Decimal(f"{i * 10}.00"), "Hogar" if i < 3 else "Juguetes") for i in range(1, 6)]
    return spark.createDataFrame(content, "product_id long, product_name string, price decimal(10,2), category string")


@pytest.fixture
def tickets(spark):
    content = [(i, datetime(2024, 1 + i, 5, 10), f"u{i}", Decimal("100.00"), 3) for i in range(1, 7)]
    return spark.createDataFrame(content, schemas.TICKETS)


@pytest.fixture
def lines(spark):
    held = {1: [1, 2, 3], 2: [1, 2], 3: [1, 3], 4: [2, 3], 5: [4], 9: [1], 6: [77]}
    content = [(t, p, 1, Decimal(f"{p}.50")) for t, ps in held.items() for p in ps]
    return spark.createDataFrame(content, schemas.LINES)


def test_dim_product_keeps_keys(spark, products):
    first = star.dim_product(products.filter("product_id in (2, 4)"))
    assert rows(first.select("product_key", "product_id")) == [(1, 2), (2, 4)]
    cheaper = products.withColumn("price", F.lit(1).cast("decimal(10,2)")).filter("product_id <> 2")
    second = star.dim_product(cheaper, first)
    assert rows(second.select("product_key", "product_id", "price")) == [
        (1, 2, Decimal("20.00")), (2, 4, Decimal("1.00")), (3, 1, Decimal("1.00")), (4, 3, Decimal("1.00")), (5, 5, Decimal("1.00")),
    ]


def test_dim_time_is_idempotent(tickets):
    first = star.dim_time(tickets)
    assert first.schema.names == schemas.DIM_TIME.names
    assert rows(star.upsert_dim_time(first, tickets)) == rows(first)
    assert first.count() == 6


def test_dim_customer(spark):
    assert rows(star.dim_customer(spark)) == [(1, "General")]
    old = spark.createDataFrame([(1, "Changed"), (2, "Club")], schemas.DIM_CUSTOMER)
    assert rows(star.dim_customer(spark, old)) == [(1, "Changed"), (2, "Club")]


def test_facts_drop_unmatched_lines(lines, tickets, products):
    facts = star.fact_sales(lines, tickets, star.dim_product(products))
    assert facts.count() == 10  # ticket 9 and product 77 do not exist
    assert facts.filter("ticket_id = 1 and product_id = 3").first().asDict() == {
        "date_key": 20240205, "product_key": 3, "customer_key": 1, "ticket_id": 1, "quantity": 1,
        "amount": Decimal("3.50"), "ticket_total": Decimal("100.00"), "ticket_quantity": 3, "product_id": 3,
    }


def test_fact_increment(lines, tickets, products):
    numbered = lines.withColumn("line_id", F.col("ticket_id") * 100 + F.col("product_id"))
    dim = star.dim_product(products)
    first, mark = star.fact_increment(numbered.filter("line_id < 300"), tickets, dim, 0)
    second, last = star.fact_increment(numbered, tickets, dim, mark)
    assert (mark, last) == (202, 901)
    assert rows(first.unionByName(second)) == rows(star.fact_sales(lines, tickets, dim))
    none, same = star.fact_increment(numbered, tickets, dim, last)
    assert none.count() == 0 and same == last


def test_fact_stream_reads_each_file_once(spark, tmp_path, lines, tickets, products):
    dim = star.dim_product(products)
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for delivery in ("ticket_id <= 2", "ticket_id > 2", None):
        if delivery:
            lines.filter(delivery).write.mode("append").parquet(source)
        stream = fact_stream.read_new_lines(spark, source, schemas.LINES)
        fact_stream.load_new_facts(stream, tickets, dim, target, progress).awaitTermination()
    loaded = spark.read.parquet(target).drop("batch")
    assert rows(loaded) == rows(star.fact_sales(lines, tickets, dim))


def test_check_keys_finds_violations(spark, lines, tickets, products):
    twice = lines.unionByName(lines.filter("ticket_id = 1"))
    dim = star.dim_product(products)
    facts = star.fact_sales(twice, tickets, dim)
    found = dict(rows(quality.check_keys(
        tickets.unionByName(tickets.limit(1)), twice, products, facts, star.dim_time(tickets), dim, star.dim_customer(spark)
    )))
    assert found == {
        "ticket id unique": 1, "ticket uuid unique": 1, "product id unique": 0, "line ticket exists": 1,
        "line product exists": 1, "fact ticket and product unique": 3, "fact date exists": 0,
        "fact product exists": 0, "fact customer exists": 0,
    }


def test_load_checks(spark, lines, tickets):
    assert rows(quality.load_counts(tickets, lines)) == [(6, 12, 2.0)]
    assert rows(quality.load_counts(tickets.filter("false"), lines)) == [(0, 12, 0.0)]
    mean, in_range = quality.avg_distinct_items(lines.filter("ticket_id <= 4")).first()
    assert (mean, in_range) == (2.25, False)
    assert quality.avg_distinct_items(lines, 1, 3).first().in_range
    assert quality.orphan_lines(lines, tickets).first()[0] == 1
    assert quality.zero_quantity_tickets(tickets.withColumn("total_quantity", F.col("ticket_id") - 1)).first()[0] == 1


def test_pair_metrics_by_hand(hand, products):
    pairs = insights.pair_metrics(bk.pair_support(hand), bk.item_support(hand), products, 5)
    row = pairs.filter("product_a = 1 and product_b = 2").first()
    assert (row.support, row.support_a, row.support_b) == (2, 3, 3)
    assert (row.confidence_ab, row.confidence_ba, row.lift, row.jaccard) == (0.666667, 0.666667, 1.111111, 0.5)
    assert (row.category_a, row.category_b) == ("Hogar", "Hogar")
    assert pairs.filter("jaccard > least(confidence_ab, confidence_ba)").count() == 0


def test_pair_limit_guard(hand):
    pairs = bk.pair_support(hand)
    assert insights.pair_limit_guard(pairs, 3) == insights.pair_limit_guard(pairs) == "ok"
    assert insights.pair_limit_guard(pairs, 2) == "too many pairs"
    assert insights.pair_limit_guard(pairs.filter("support > 9")) == "no pairs"


def test_money_statistics_do_not_depend_on_partitions(spark):
    rows = [(k, Decimal("0.01") * (k * 7919 % 100_003) + (Decimal("99999999.99") if k % 500 == 0 else 0)) for k in range(3000)]
    tickets = spark.createDataFrame(rows, "ticket_id long, total_amount decimal(20,2)")
    found = [sorted(map(tuple, insights.ticket_anomalies(tickets.repartition(n)).collect())) for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) == 6


def test_bundles_of_extreme_lifts(spark):
    pairs = spark.createDataFrame([(1, 2, 1.0, 5e11)], "product_a long, product_b long, confidence_ab double, lift double")
    price = Decimal("99999999.99")
    products = spark.createDataFrame(
        [(1, "a", price), (2, "b", price)], "product_id long, product_name string, price decimal(10,2)")
    assert insights.bundles(pairs, products).first()["potential"] == Decimal(5 * 10**11) * 2 * price


def test_category_pairs_can_ignore_case_and_accents(spark):
    products = spark.createDataFrame(
        [(1, "Hogar"), (2, "hogar"), (3, "HOGÁR"), (4, "Juguetes")], "product_id long, category string"
    )
    lines = spark.createDataFrame([(t, p) for t in range(6) for p in (1 + t % 3, 4)], "ticket_id long, product_id long")
    strict = insights.category_pairs(lines, products, 6, min_support=1)
    assert strict.count() == 3
    folded = insights.category_pairs(lines, products, 6, min_support=1, ignore_case=True).collect()
    assert [(r.support, r.score, r.priority) for r in folded] == [(6, 1.0, "Alta")]


def test_priority_bands(spark):
    df = spark.createDataFrame([(10,), (9,), (5,), (4,)], "s long")
    assert [r[0] for r in df.select(insights.priority_band(F.col("s"), 1000)).collect()] == ["Alta", "Media", "Media", "Baja"]


def pair(spark, *content):
    """Pair rows (a, b, confidence a-b, confidence b-a, lift)."""
    full = [(a, b, f"h{a}", f"h{b}", 2, 3, 3, ab, ba, lift, 0.5, "x", "y") for a, b, ab, ba, lift in content]
    return spark.createDataFrame(full, schemas.PAIRS)


def test_recommendations_and_bundles(spark, products):
    pairs = pair(spark, (1, 2, 0.2, 0.9, 1.5), (1, 3, 0.199999, 0.9, 9.0), (2, 3, 0.9, 0.9, 1.499999), (3, 5, 0.333333, 0.1, 2.0))
    rec = insights.recommendations(pairs, products).orderBy("trigger_product").collect()
    assert [(r.trigger_product, r.recommended_product, r.score, r.probability, r.uplift) for r in rec] == [
        (1, 2, 0.15, 0.2, Decimal("4.00")), (3, 5, 0.333333, 0.333333, Decimal("16.67")),
    ]
    assert rec[0].message == "Clientes que compran product 1 también compran product 2"
    bundled = insights.bundles(pairs, products).collect()
    assert [(r.bundle_name, r.products, r.potential) for r in bundled] == [
        ("Bundle_product_3_product_5", "product 3 + product 5", Decimal("53.3333")),
        ("Bundle_product_1_product_2", "product 1 + product 2", Decimal("9.0000")),
    ]


def test_bundles_with_one_name_are_both_kept(spark):
    products = spark.createDataFrame(
        [(i, "same name", Decimal("99999999.00"), "c") for i in (1, 2, 3)],
        "product_id long, product_name string, price decimal(10,2), category string",
    )
    bundled = insights.bundles(pair(spark, (1, 2, 1.0, 1.0, 999999.0), (1, 3, 1.0, 1.0, 2.0)), products).collect()
    assert len(bundled) == 2 and len({r.bundle_name for r in bundled}) == 1
    assert {(r.product_a, r.product_b): r.potential for r in bundled}[1, 2] == Decimal("199999798000002.0000")


def test_anomalies(spark):
    totals = [(i, Decimal("10.00")) for i in range(20)] + [(99, Decimal("100.00"))]
    tickets = spark.createDataFrame(totals, "ticket_id long, total_amount decimal(12,2)")
    found = insights.ticket_anomalies(tickets).collect()
    assert [(r.ticket_id, r.score, r.message) for r in found] == [(99, 4.472136, "Ticket con valor 100.00 vs promedio 14.29")]
    equal = tickets.filter("ticket_id < 20")
    assert insights.ticket_anomalies(equal).count() == 0
    plan = insights.ticket_anomalies(tickets)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_anomalies_with_a_large_mean_and_a_small_deviation(spark):
    """The mean of the squares less the square of the mean loses all digits here; exact sums lose none."""
    totals = [(i, Decimal("987654321.00") + Decimal(i % 10) / 100) for i in range(999)] + [(999, Decimal("987654322.00"))]
    tickets = spark.createDataFrame(totals, "ticket_id long, total_amount decimal(20,2)").repartition(5)
    found = insights.ticket_anomalies(tickets).collect()
    mean = sum(Fraction(v) for _, v in totals) / 1000
    deviation = float(sum((Fraction(v) - mean) ** 2 for _, v in totals) / 1000) ** 0.5
    assert [(r.ticket_id, r.score) for r in found] == [(999, round(float(Fraction(totals[-1][1]) - mean) / deviation, 6))]
    assert insights.exact_moments(tickets, "total_amount") == (1000, mean * 100, sum((Fraction(v) - mean) ** 2 for _, v in totals) * 10)


def test_moments_of_extreme_negative_and_missing_amounts(spark):
    amounts = [Decimal("999999999999999999.99"), Decimal("-999999999999999999.98"), Decimal("0.01"), None, Decimal("49999999.995")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(amounts)], "ticket_id long, total_amount decimal(24,4)")
    cents = [int(v * 100) for v in amounts[:3]] + [5_000_000_000]
    mean = Fraction(sum(cents), 4)
    assert insights.exact_moments(rows, "total_amount") == (4, mean, sum((c - mean) ** 2 for c in cents) / 4)
    assert insights.exact_moments(rows.filter("ticket_id = 3"), "total_amount") is None
    assert insights.ticket_anomalies(rows.filter("ticket_id = 3")).collect() == []


def rule(spark, *content):
    full = [(a, b, f"h{a}", f"h{b}", 2, 0.1, c, lift, 1.0, 0.0, source) for a, b, c, lift, source in content]
    return spark.createDataFrame(full, schemas.RULES)


def test_compare_methods_takes_the_higher_direction(spark):
    found = rule(
        spark, ("[1]", "[2]", 0.3, 1.2, "APRIORI"), ("[2]", "[1]", 0.4, 1.1, "APRIORI"),
        ("[1]", "[3]", 0.9, 9.0, "OTHER"), ("[1,2]", "[3]", 0.9, 9.0, "APRIORI"), ("[2]", "[3]", 0.1, 5.0, "APRIORI"),
    )
    pairs = pair(spark, (1, 2, 0.2, 0.5, 1.0), (1, 3, 0.2, 0.1, 2.0), (2, 3, 0.3, 0.2, 5.0))
    named = pairs.withColumn("hash_a", F.expr("concat('h[', product_a, ']')")).withColumn("hash_b", F.expr("concat('h[', product_b, ']')"))
    assert rows(insights.compare_methods(named, found)) == [
        (1, 2, 0.5, 0.4, 1.0, 1.2, 0.1, -0.2, "APRIORI"),
        (1, 3, 0.2, 0.0, 2.0, 0.0, 0.2, 2.0, "MBA"),
        (2, 3, 0.3, 0.1, 5.0, 5.0, 0.2, 0.0, "MBA"),
    ]
    assert insights.rules_present(found)
    assert not insights.rules_present(None) and not insights.rules_present(found.filter("false"))


def test_rule_hashes_meet_pair_hashes(hand, products):
    sets = frequent_itemsets([frequent_1(hand, 1), frequent_2(hand, 1)], 5)
    pairs = insights.pair_metrics(bk.pair_support(hand), bk.item_support(hand), products, 5)
    compared = insights.compare_methods(pairs, association_rules(sets, 5)).collect()
    assert len(compared) == 3
    assert all(r.delta_confidence == 0 and r.delta_lift == 0 for r in compared)


def test_reports_are_sorted_and_named(spark, products):
    pairs = pair(spark, (1, 2, 0.2, 0.9, 1.5), (2, 3, 0.5, 0.9, 3.0), (1, 3, 0.5, 0.9, 3.0))
    top = reports.report_basket(pairs, products, limit=2).collect()
    assert [(r.name_a, r.name_b) for r in top] == [("product 1", "product 3"), ("product 2", "product 3")]
    anomalies = spark.createDataFrame([(1, "k", -3.0, "m"), (2, "k", 4.0, "m"), (3, "k", 4.0, "m")], schemas.ANOMALIES)
    assert [r.ticket_id for r in reports.report_anomalies(anomalies).collect()] == [2, 3, 1]
    assert "TakeOrderedAndProject" in reports.report_anomalies(anomalies)._jdf.queryExecution().executedPlan().toString()


def test_run_use_cases(spark, lines, tickets, products):
    result = run_use_cases(products, tickets, lines, "0.3", cuts=Thresholds(min_category_support=1))
    assert (result.status, result.pair_status) == ("ok", "ok")
    assert rows(result.tables["basket"].select("product_a", "product_b", "support")) == [(1, 2, 2), (1, 3, 2), (2, 3, 2)]
    row = result.audit.first()
    assert row.message == "MBA:3, Cat:1, Rec:0, Anom:0, Bnd:0, Cmp:0"
    assert (row.input_rows, row.status, row.comment) == (10, "COMPLETADO", "Soporte Relativo: 0.30000000")
    assert result.tables["fact_sales"].count() == 10


def test_run_with_rules_gives_all_reports(spark, lines, tickets, products):
    baskets = bk.basket_items(lines)
    found = association_rules(frequent_itemsets([frequent_1(baskets, 1), frequent_2(baskets, 1)], 6), 6)
    cuts = Thresholds(min_confidence=0.1, min_lift=0.5, min_category_support=1)
    result = run_use_cases(products, tickets, lines, "0.1", found, cuts=cuts)
    made = reports.all_reports(result.tables, products)
    assert {name: df.count() for name, df in made.items()} == {
        "basket": 3, "category": 1, "recommendations": 3, "anomalies": 0, "bundles": 3, "rules": 6, "comparison": 3,
    }


def test_runs_without_data(spark, lines, tickets, products):
    assert run_use_cases(products, tickets, lines.filter("false"), "0.1").status == "SIN DATOS"
    assert run_use_cases(products, tickets.filter("false"), lines, "0.1").status == "SIN DATOS"


def test_simple_run_refreshes_statistics(spark, lines, tickets, products):
    result = run_use_cases_simple(products, tickets, lines)
    assert result.audit.first().comment == "Soporte Relativo: 0.01000000"
    details = spark.sql("DESCRIBE TABLE EXTENDED basketlab_fact_sales").filter("col_name = 'Statistics'").first()
    assert "10 rows" in details.data_type
    for name in ("fact_sales", "basket", "category", "recommendations"):
        spark.sql(f"DROP TABLE basketlab_{name}")
