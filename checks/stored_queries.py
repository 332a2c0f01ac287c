"""Queries over stored forms of the tables: buckets, month folders, merged tables, bitmaps and column statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.functions.text_hash import itemset_text
from basketlab.operators import insights, itemsets, key_bitmaps, pair_buckets, quality, star, ticket_bitmaps
from basketlab.operators import baskets as bk
from basketlab.operators.staging import new_path, stage
from basketlab.plans import reports
from basketlab.sources import fact_store, merge_store, report_json, tables, ticket_store
from checks import tables as t
from checks.queries import _CATEGORY, _DIM_TIME, _FACTS, MIN_BRANDS, MIN_PAIR, _basket, _baskets, _brand_pairs, _n_orders, query


@query(f"WITH {t.BASKETS}, {t.pairs_sql(MIN_PAIR)} SELECT a, b, n AS support FROM pairs")
def prefiltered_pair_support(spark, folder):
    """Pairs counted only where their bucket of hashed pairs is full enough."""
    baskets = bk.stage_baskets(_baskets(spark, folder))
    return pair_buckets.prefiltered_pair_support(baskets, MIN_PAIR, bk.stage_supports(baskets))


@query(f"WITH {t.BASKETS}, {t.pairs_sql(1)} SELECT CAST(sum(n) AS BIGINT) AS n_listed, count(*) AS n_pairs FROM pairs")
def listed_pairs(spark, folder):
    """Occurrences of pairs known from the basket sizes alone, beside the pairs themselves."""
    baskets = bk.stage_baskets(_baskets(spark, folder))
    pairs = bk.pair_support(baskets, 1).agg(F.count(F.lit(1)).alias("n_pairs"))
    return pairs.select(F.lit(pair_buckets.listed_pairs(baskets)).cast("long").alias("n_listed"), "n_pairs")


def _store(spark, folder) -> ticket_store.TicketStore:
    """Lines, tickets and baskets in buckets; the names leave the catalog again, the frames stay readable."""
    place = new_path(spark, "ticket_store")
    prefix = "store_" + place.rsplit("-", 1)[-1][:12]
    store = ticket_store.store_by_ticket(stage(t.lines(spark, folder), "lines"), t.tickets(spark, folder), place, prefix)
    ticket_store.forget_store(spark, prefix)
    return store


@query(f"WITH {_FACTS} SELECT * FROM facts")
def stored_facts(spark, folder):
    """Facts from bucketed lines and tickets."""
    return ticket_store.stored_facts(_store(spark, folder), stage(star.dim_product(t.products(spark, folder)), "dim_product"))


@query(f"WITH {t.BASKETS}, {t.pairs_sql(MIN_PAIR)} SELECT a, b, n AS support FROM pairs")
def stored_pairs(spark, folder):
    """Pairs from bucketed baskets."""
    baskets = ticket_store.stored_baskets(_store(spark, folder), t.products(spark, folder))
    return bk.pair_support(baskets, MIN_PAIR, stage(bk.item_support(baskets), "item_support"))


@query(f"""WITH {_DIM_TIME}, {_FACTS}
SELECT period, p_brand AS category, CAST(CAST(sum(CAST(amount AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS DOUBLE) AS amount,
       CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS n_lines
FROM facts JOIN dim_time USING (date_key) JOIN part ON p_partkey = product_id WHERE season = 'Verano' GROUP BY ALL""")
def season_sales(spark, folder):
    """Sales of the summers from facts kept by month; the other months' folders are not read."""
    products = stage(star.dim_product(t.products(spark, folder)), "dim_product")
    path = new_path(spark, "facts_by_month")
    fact_store.store_facts(star.fact_sales(t.lines(spark, folder), t.tickets(spark, folder), products), path)
    calendar = stage(star.dim_time(t.headers(spark, folder)), "dim_time")
    return fact_store.season_sales(fact_store.read_facts(spark, path), calendar, products, "Verano")


@query("""SELECT p_partkey AS product_id, CASE WHEN p_partkey % 4 = 0 THEN upper(p_name) ELSE p_name END AS product_name,
  CASE WHEN p_partkey % 4 = 0 AND p_partkey % 3 <> 0 THEN 0.0 ELSE p_retailprice END AS price FROM part""")
def merge_store_twice(spark, folder):
    """A stored part of the products takes the prices of every third one, then the products it lacks; known ones stay."""
    path = new_path(spark, "merged_products")
    products = t.products(spark, folder).select("product_id", "product_name", "price")
    first = products.filter("product_id % 4 = 0").select(
        "product_id", F.upper("product_name").alias("product_name"), F.lit(0).cast("decimal(10,2)").alias("price"))
    merge_store.create_store(first, path, ["product_id"], 8)
    third = products.filter("product_id % 3 = 0 AND product_id % 4 = 0")
    for _ in range(2):  # the same merge again changes nothing
        merge_store.merge_store(third, path, ["product_id"], 8, ["price"])
    merge_store.merge_store(products, path, ["product_id"], 8, ignore_known=True)
    return merge_store.read_store(spark, path)


_BRAND_BASKETS = "baskets AS MATERIALIZED (SELECT DISTINCT l_orderkey AS t, p_brand AS i FROM lineitem JOIN part ON p_partkey = l_partkey)"


def _brand_sets(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Sets of two to four brands that may be frequent, and the brands' baskets by ticket."""
    baskets, _, pairs = _brand_pairs(spark, folder)
    triples = stage(itemsets.candidates_3(pairs), "brand_triples")
    four = triples.withColumnRenamed("c", "d").join(triples, ["a", "b"]).filter(F.col("c") < F.col("d"))
    sets = pairs.select(F.array("a", "b").alias("items")).unionByName(triples.select(F.array("a", "b", "c").alias("items")))
    return stage(sets.unionByName(four.select(F.array("a", "b", "c", "d").alias("items"))), "brand_sets"), baskets


@query(f"""WITH {_BRAND_BASKETS}, {t.pairs_sql(MIN_BRANDS)}, three AS MATERIALIZED (
  SELECT x.a, x.b, y.b AS c FROM pairs x JOIN pairs y ON x.a = y.a AND x.b < y.b JOIN pairs z ON z.a = x.b AND z.b = y.b), four AS (
  SELECT x.a, x.b, x.c, y.c AS d FROM three x JOIN three y ON x.a = y.a AND x.b = y.b AND x.c < y.c),
held2 AS (SELECT x.t, x.i AS a, y.i AS b FROM baskets x JOIN baskets y ON y.t = x.t AND x.i < y.i),
held3 AS (SELECT h.*, z.i AS c FROM held2 h JOIN baskets z ON z.t = h.t AND h.b < z.i),
held4 AS (SELECT h.*, z.i AS d FROM held3 h JOIN baskets z ON z.t = h.t AND h.c < z.i),
n3 AS (SELECT a, b, c, count(*) AS n FROM held3 GROUP BY ALL), n4 AS (SELECT a, b, c, d, count(*) AS n FROM held4 GROUP BY ALL)
SELECT '["' || a || '","' || b || '"]' AS itemset_text, n AS support FROM pairs
UNION ALL SELECT '["' || a || '","' || b || '","' || c || '"]', coalesce(n, 0) FROM three LEFT JOIN n3 USING (a, b, c)
UNION ALL SELECT '["' || a || '","' || b || '","' || c || '","' || d || '"]', coalesce(n, 0) FROM four LEFT JOIN n4 USING (a, b, c, d)""")
def bitmap_set_support(spark, folder):
    """Support of sets of two, three and four brands by intersected bitmaps."""
    sets, baskets = _brand_sets(spark, folder)
    bitmaps = stage(ticket_bitmaps.ticket_bitmaps(baskets, item="item"), "ticket_bitmaps")
    counted = ticket_bitmaps.contains_all_by_bitmaps(sets, bitmaps)
    return counted.select(itemset_text(F.col("items")).alias("itemset_text"), "support")


@query(f"WITH {t.BASKETS}, {t.SUPPORTS} SELECT i AS item, s AS support FROM supports")
def bitmap_item_support(spark, folder):
    """Item supports from the bitmaps of a first load and those of an increment that shares tickets with it."""
    lines = t.lines(spark, folder)
    loads = [lines.filter("quantity < 30"), lines.filter("quantity >= 20")]  # some lines come twice
    parts = [stage(ticket_bitmaps.ticket_bitmaps(load), "ticket_bitmaps") for load in loads]
    return ticket_bitmaps.bitmap_supports(ticket_bitmaps.merge_bitmaps(*parts))


@query(f"""WITH {t.BASKETS}, parts AS (SELECT 'first' AS load, l_orderkey AS t, l_partkey AS i FROM lineitem WHERE l_quantity < 30
  UNION SELECT 'both', t, i FROM baskets)
SELECT load, count(DISTINCT t) AS n_tickets, count(*) AS n_pairs, CAST(count(*) AS DOUBLE) / count(DISTINCT t) AS avg_items FROM parts GROUP BY load""")
def bitmap_basket_counts(spark, folder):
    """Tickets, pairs and items per ticket before and after an increment; after it only the new lines are read."""
    lines = t.lines(spark, folder)
    first = stage(ticket_bitmaps.ticket_bitmaps(lines.filter("quantity < 30")), "ticket_bitmaps")
    added = ticket_bitmaps.ticket_bitmaps(lines.filter("quantity >= 30"))
    states = {"first": first, "both": ticket_bitmaps.merge_bitmaps(first, added)}
    counted = [ticket_bitmaps.bitmap_basket_counts(b).select(F.lit(load).alias("load"), "*") for load, b in states.items()]
    return counted[0].unionByName(counted[1])


@query("""SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_keys FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def missing_by_bitmaps(spark, folder):
    """Lines and tickets that would be missing if only finished orders had been loaded."""
    finished = t.raw(spark, folder, "orders", ["o_orderkey", "o_orderstatus"]).filter("o_orderstatus = 'F'")
    return key_bitmaps.count_missing(t.lines(spark, folder), finished.select(F.col("o_orderkey").alias("ticket_id")), "ticket_id")


@query("""WITH x AS (SELECT l_orderkey AS a, l_partkey AS b, CAST(l_quantity AS BIGINT) AS c, CAST(l_extendedprice AS DECIMAL(10,2)) AS d FROM lineitem)
SELECT unnest(['ticket_id', 'product_id', 'quantity', 'amount']) AS column_name,
  unnest([min(a)::VARCHAR, min(b)::VARCHAR, min(c)::VARCHAR, min(d)::VARCHAR]) AS min,
  unnest([max(a)::VARCHAR, max(b)::VARCHAR, max(c)::VARCHAR, max(d)::VARCHAR]) AS max,
  unnest([count(*) - count(a), count(*) - count(b), count(*) - count(c), count(*) - count(d)]) AS num_nulls, true AS has_histogram FROM x""")
def column_statistics(spark, folder):
    """Statistics of the line table's columns, read back from the catalog."""
    place = new_path(spark, "lines")
    name = "statistics_" + place.rsplit("-", 1)[-1][:12]
    tables.save_table(t.lines(spark, folder), name, place)
    columns = ["ticket_id", "product_id", "quantity", "amount"]
    quality.refresh_statistics(spark, [name], {name: columns})
    found = quality.column_statistics(spark, name, columns)
    spark.sql(f"DROP TABLE {name}")
    return found.select("column_name", "min", "max", "num_nulls", (F.col("bins") > 0).alias("has_histogram"))


@query(f"""WITH {t.basket_sql(MIN_PAIR)}, {_CATEGORY}, top AS (SELECT * FROM basket ORDER BY lift DESC, product_a, product_b LIMIT 50),
  near AS (SELECT * FROM category ORDER BY score DESC, category_a, category_b LIMIT 50)
SELECT 'market_basket_analysis' AS report, row_number() OVER (ORDER BY lift DESC, product_a, product_b) AS position,
       product_a::VARCHAR AS a, product_b::VARCHAR AS b FROM top
UNION ALL SELECT 'categoria_proximidad', row_number() OVER (ORDER BY score DESC, category_a, category_b), category_a, category_b FROM near""")
def write_report_document(spark, folder):
    """Two reports in one JSON document, read back whole."""
    products = t.products(spark, folder)
    found = {
        "basket": reports.report_basket(stage(_basket(spark, folder), "basket"), products),
        "category": reports.report_category(insights.category_pairs(t.lines(spark, folder), products, _n_orders(spark, folder))),
    }
    path = new_path(spark, "report_document")
    report_json.write_report_document(spark, found, path)
    pairs = {"market_basket_analysis": ("producto_a_key", "producto_b_key", "bigint"), "categoria_proximidad": ("categoria_a", "categoria_b", "string")}
    schema = ", ".join(f"{name} array<struct<{a}: {kind}, {b}: {kind}>>" for name, (a, b, kind) in pairs.items())
    content = spark.read.schema(schema).json(path, multiLine=True)
    parts = [content.select(F.lit(name).alias("report"), F.posexplode(name).alias("position", "row")).select(
        "report", (F.col("position") + 1).cast("long").alias("position"), F.col(f"row.{a}").cast("string").alias("a"), F.col(f"row.{b}").cast("string").alias("b"))
        for name, (a, b, _) in pairs.items()]
    return parts[0].unionByName(parts[1])
