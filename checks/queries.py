"""Every operator as a query over the test tables, with SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlab import schemas
from basketlab.functions import money
from basketlab.functions.text_hash import itemset_hash, itemset_text
from basketlab.operators import baskets as bk
from basketlab.operators import cleanse, insights, itemsets, quality, rules, sampling, star, surrogates, upserts
from basketlab.operators.staging import new_path, stage
from basketlab.plans import load, reports
from basketlab.plans.mining import mine, sampled_lines
from basketlab.plans.use_cases import Thresholds, run_use_cases, run_use_cases_simple
from basketlab.sources import product_csv, report_json, tables
from basketlab.streaming import fact_stream
from checks import tables as t

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The default cuts find nothing in the test tables, so queries use these.
MIN_PAIR, MIN_BRANDS = 2, 30
MIN_CONFIDENCE, RULE_CONFIDENCE = 0.08, 0.05
REL_SUPPORT = "0.0001"
_REL_MIN = f"greatest(CAST(ceil({t.N} * {REL_SUPPORT}) AS BIGINT), 1)"
_SAMPLE_MIN = f"greatest(CAST(floor({_REL_MIN} * 0.15) AS BIGINT), 1)"


def query(sql: str | None = None):
    """Register a query under its function name, with its SQL if there is one."""
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = lambda spark, folder: t.plain(build(spark, folder))
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


# --- Shared inputs ---------------------------------------------------------


def _baskets(spark, folder) -> DataFrame:
    return bk.basket_items(t.lines(spark, folder))


def _brand_pairs(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Baskets, supports and frequent pairs of brands instead of products."""
    baskets = stage(insights.ticket_categories(t.lines(spark, folder), t.products(spark, folder)), "brand_baskets")
    supports = stage(bk.item_support(baskets), "item_support")
    return baskets, supports, stage(itemsets.frequent_2(baskets, MIN_BRANDS, supports), "frequent_pairs")


def _n_orders(spark, folder) -> int:
    return t.headers(spark, folder).count()


def _pairs(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Baskets, item supports and frequent pairs, all stored."""
    baskets = bk.stage_baskets(_baskets(spark, folder))
    supports = bk.stage_supports(baskets)
    return baskets, supports, stage(itemsets.frequent_2(baskets, MIN_PAIR, supports), "frequent_pairs")


def _basket(spark, folder, found=None) -> DataFrame:
    """Pair metrics of all products from the minimum support up."""
    _, supports, pairs = found or _pairs(spark, folder)
    return insights.pair_metrics(pairs, supports, t.products(spark, folder), _n_orders(spark, folder))


def _itemsets(spark, folder, found=None) -> tuple[DataFrame, int]:
    baskets, supports, pairs = found or _pairs(spark, folder)
    levels = [itemsets.frequent_1(baskets, MIN_PAIR, supports), pairs, itemsets.frequent_3(baskets, pairs, MIN_PAIR)]
    n = itemsets.count_tickets(baskets)
    return stage(itemsets.frequent_itemsets(levels, n), "itemsets"), n


def _rules(spark, folder, min_confidence: float = RULE_CONFIDENCE, found=None) -> DataFrame:
    sets, n = _itemsets(spark, folder, found)
    return rules.association_rules(sets, n, min_confidence)


def _rule_table(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in schemas.RULES.fields])


_RULE_COLUMNS = ", ".join(f.name for f in schemas.RULES.fields)
_STRONG = f"confidence_ab >= {MIN_CONFIDENCE} AND lift >= 1.5"
_PRODUCT_ROW = "SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category, p_retailprice AS price FROM part"


# --- Sources and sinks -----------------------------------------------------


@query(_PRODUCT_ROW)
def read_products_csv(spark, folder):
    """Write the parts as a product file with untidy headers and price texts, then load it."""
    path = new_path(spark, "products_csv")
    price = F.concat(F.lit("$"), F.format_number("price", 2))
    t.products(spark, folder).select(
        F.col("product_id").alias("  Identificador "), F.col("product_name").alias("PRODUCTO"),
        price.alias("Precio  "), F.col("category").alias("Categoria"),
    ).write.option("header", True).csv(path)
    good, _ = product_csv.read_products_csv(spark, path)
    return good.select("product_id", "product_name", "category", "price")


@query("SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS the_brand FROM part")
def normalize_headers(spark, folder):
    raw = t.raw(spark, folder, "part", ["p_partkey", "p_name", "p_brand"])
    return cleanse.normalize_headers(raw.toDF(" Part Key", "PART\tNAME ", "The   Brand"))


@query("SELECT p_partkey, p_brand FROM part")
def require_columns(spark, folder):
    return cleanse.require_columns(t.raw(spark, folder, "part", ["p_partkey", "p_brand"]), ["p_partkey", "p_brand"])


@query("SELECT p_partkey, p_name, p_retailprice, p_brand FROM part")
def read_table(spark, folder):
    return tables.read_table(spark, f"{folder}/part.parquet", ["p_partkey", "p_name", "p_retailprice", "p_brand"])


@query("""SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice AS price,
       'Regular' AS frequency, p_brand AS category FROM part""")
def conform(spark, folder):
    text = t.products(spark, folder).select(*[F.col(c).cast("string") for c in ("product_id", "product_name", "price", "category")])
    return tables.conform(text, schemas.PRODUCTS, {"frequency": "Regular"})


@query(_PRODUCT_ROW)
def overwrite_table(spark, folder):
    """Load a table twice: the second load replaces the first."""
    path = new_path(spark, "products")
    products = t.products(spark, folder)
    tables.overwrite_table(products, path)
    return tables.overwrite_table(products, path).select("product_id", "product_name", "category", "price")


@query("SELECT o_orderkey AS ticket_id, strftime(o_orderdate, '%Y-%m-%d') AS sold_at FROM orders")
def append_batches(spark, folder):
    """Load the tickets as an early and a late batch."""
    path = new_path(spark, "tickets")
    tickets = t.headers(spark, folder).select("ticket_id", "sold_at")
    early = F.col("sold_at") < "1996-01-01"
    tables.append_batches(path, tickets.filter(early), tickets.filter(~early))
    return spark.read.parquet(path)


@query(f"""WITH {t.basket_sql(MIN_PAIR)}, top AS (
  SELECT * FROM basket ORDER BY lift DESC, product_a, product_b LIMIT 50)
SELECT 'market_basket_analysis' AS report, row_number() OVER (ORDER BY lift DESC, product_a, product_b) AS position,
       product_a AS producto_a_key, product_b AS producto_b_key, lift
FROM top""")
def write_report_json(spark, folder):
    """Write a report as JSON, then read the file back with Spark."""
    path = new_path(spark, "reports")
    report = reports.report_basket(stage(_basket(spark, folder), "basket"), t.products(spark, folder))
    report_json.write_report_json(spark, {"basket": report}, path)
    row = "struct<producto_a_key:bigint,producto_b_key:bigint,lift:double>"
    content = report_json.read_report_json(spark, path, ["market_basket_analysis"], row)
    return content.select("report", (F.col("position") + 1).alias("position"), "row.*")


@query("""WITH old AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity = 50)
SELECT p_partkey AS product_id, CASE WHEN l_partkey IS NULL THEN p_name ELSE upper(p_name) END AS product_name,
       p_retailprice AS price
FROM part LEFT JOIN old ON l_partkey = p_partkey""")
def upsert(spark, folder):
    """Known products (those sold in fifties) keep their name and take the new price; others are added."""
    products = t.products(spark, folder).select("product_id", "product_name", "price")
    known = t.lines(spark, folder).filter("quantity = 50").select("product_id").distinct()
    old = products.join(known, "product_id", "left_semi").select(
        "product_id", F.upper("product_name").alias("product_name"), F.lit(0).cast("decimal(10,2)").alias("price")
    )
    return upserts.upsert(old, products, ["product_id"], ["price"])


@query("""WITH old AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity = 50)
SELECT p_partkey AS product_id, CASE WHEN l_partkey IS NULL THEN p_name ELSE upper(p_name) END AS product_name
FROM part LEFT JOIN old ON l_partkey = p_partkey""")
def insert_ignore(spark, folder):
    products = t.products(spark, folder).select("product_id", "product_name")
    known = t.lines(spark, folder).filter("quantity = 50").select("product_id").distinct()
    old = products.join(known, "product_id", "left_semi").withColumn("product_name", F.upper("product_name"))
    return upserts.insert_ignore(old, products, ["product_id"])


# --- Cleaning --------------------------------------------------------------


@query("""SELECT l_orderkey, l_partkey, CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price FROM lineitem""")
def parse_price(spark, folder):
    """Line amounts as texts like ' $1,234.50 ' and back."""
    amount = t.raw(spark, folder, "lineitem", ["l_orderkey", "l_partkey", "l_extendedprice"])
    text = F.concat(F.lit(" $"), F.format_number("l_extendedprice", 2), F.lit(" "))
    return amount.select("l_orderkey", "l_partkey", money.parse_price(text).alias("price"))


_PRICE_TEXT = "CASE WHEN p_type = 'ECONOMY' THEN 'on request' ELSE CAST(p_retailprice AS VARCHAR) END"


@query(f"""SELECT p_partkey AS product_id, 'good' AS kind, p_retailprice AS price FROM part WHERE p_type <> 'ECONOMY'
UNION ALL SELECT p_partkey, 'bad', -1.0 FROM part WHERE p_type = 'ECONOMY'""")
def reject_bad_rows(spark, folder):
    part = t.raw(spark, folder, "part", ["p_partkey", "p_type", "p_retailprice"])
    text = F.when(F.col("p_type") == "ECONOMY", "on request").otherwise(F.col("p_retailprice").cast("string"))
    good, bad = cleanse.reject_bad_rows(part.select(F.col("p_partkey").alias("product_id"), text.alias("text")), "text")
    shown = good.select("product_id", F.lit("good").alias("kind"), F.col("price").cast("double").alias("price"))
    return shown.unionByName(bad.select("product_id", F.lit("bad").alias("kind"), F.lit(-1.0).alias("price")))


_FREQUENCY = """freq AS (SELECT p_partkey AS product_id,
  CAST('0x' || substr(md5(p_partkey || ':42'), 1, 8) AS BIGINT) % 100 AS k FROM part), labels_ AS (
  SELECT product_id, CASE WHEN k < 40 THEN 'Muy Frecuente' WHEN k < 65 THEN 'Frecuente' WHEN k < 85 THEN 'Regular'
         ELSE 'Esporádicamente' END AS frequency FROM freq)"""


@query(f"WITH {_FREQUENCY} SELECT * FROM labels_")
def fill_frequency(spark, folder):
    return cleanse.fill_frequency(t.products(spark, folder)).select("product_id", "frequency")


@query(f"""WITH {_FREQUENCY} SELECT product_id, CASE frequency WHEN 'Muy Frecuente' THEN 0.4 WHEN 'Frecuente' THEN 0.25
  WHEN 'Regular' THEN 0.2 ELSE 0.15 END::DOUBLE AS weight FROM labels_""")
def frequency_weight(spark, folder):
    labelled = cleanse.fill_frequency(t.products(spark, folder))
    return labelled.select("product_id", cleanse.frequency_weight(F.col("frequency")).alias("weight"))


@query(f"""WITH {t.PRODUCTS} SELECT 'two brands' AS request, product_id FROM products WHERE category IN ('Brand#1', 'Brand#2')
UNION ALL SELECT 'default', product_id FROM products""")
def anchor_products(spark, folder):
    """Anchors of two brands; no part is in the default categories, which gives all parts."""
    products = t.products(spark, folder)
    some = cleanse.anchor_products(products, ["Brand#1", "Brand#2"])
    return some.select(F.lit("two brands").alias("request"), "product_id").unionByName(
        cleanse.anchor_products(products).select(F.lit("default").alias("request"), "product_id")
    )


@query("""SELECT l_orderkey AS ticket_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS BIGINT) AS DOUBLE) AS amount
FROM lineitem JOIN part ON p_partkey = l_partkey""")
def line_total(spark, folder):
    lines = t.lines(spark, folder).drop("amount")
    return cleanse.priced_lines(lines, t.products(spark, folder)).select("ticket_id", "product_id", "quantity", "amount")


@query(f"""WITH {t.LINES}, {t.TOTALS}
SELECT ticket_id, CAST(total_amount AS DOUBLE) AS total_amount, total_quantity FROM totals""")
def ticket_totals(spark, folder):
    return cleanse.ticket_totals(t.lines(spark, folder))


@query("""SELECT o_orderkey AS ticket_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def resolve_ticket_ids(spark, folder):
    """Lines that carry the external ticket id only."""
    uuid = F.md5(F.col("ticket_id").cast("string"))
    incoming = t.lines(spark, folder).select(uuid.alias("external_uuid"), "product_id", "quantity")
    return cleanse.resolve_ticket_ids(incoming, t.headers(spark, folder)).select("ticket_id", "product_id", "quantity")


@query("""SELECT p_brand AS category, count(*) OVER (PARTITION BY p_brand) AS n_products, p_partkey AS product_id,
       p_name AS product_name, p_retailprice AS price FROM part""")
def products_by_category(spark, folder):
    return cleanse.products_by_category(t.products(spark, folder))


@query(f"""WITH {t.LINES}, {t.TOTALS}, mean AS (SELECT CAST(sum(total_amount) AS DOUBLE) / count(*) AS m FROM totals)
SELECT ticket_id, 'Ticket con valor ' || CAST(total_amount AS VARCHAR) || ' vs promedio ' ||
       CAST(CAST(m AS DECIMAL(20,2)) AS VARCHAR) AS message FROM totals, mean""")
def ticket_message(spark, folder):
    totals = cleanse.ticket_totals(t.lines(spark, folder))
    mean = totals.agg(F.avg(F.col("total_amount").cast("double"))).scalar()
    with_mean = totals.withColumn("mean", mean)
    return with_mean.select("ticket_id", money.ticket_message(F.col("total_amount"), F.col("mean")).alias("message"))


# --- Star schema -----------------------------------------------------------

_DIM_TIME = f"""days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), weeks AS (
  SELECT d, isodow(date_trunc('year', d)) - 1 AS w FROM days), dim_time AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
         CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
         ['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'][month(d)] AS month_name,
         ['Domingo','Lunes','Martes','Miércoles','Jueves','Viernes','Sábado'][dayofweek(d) + 1] AS day_name,
         CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(floor((dayofyear(d) - 1 + CASE WHEN w >= 4 THEN w - 7 ELSE w END) / 7.0) + 1 AS INTEGER) AS week,
         CAST(dayofweek(d) IN (0, 6) AS INTEGER) AS is_weekend, strftime(d, '%Y-%m') AS period,
         {t.SEASON.format(d='d')} AS season
  FROM weeks)"""


@query(f"WITH {_DIM_TIME} SELECT * FROM dim_time")
def dim_time(spark, folder):
    return star.dim_time(t.headers(spark, folder))


@query(f"WITH {_DIM_TIME} SELECT * FROM dim_time")
def upsert_dim_time(spark, folder):
    """A calendar of the early tickets, brought up to date."""
    tickets = t.headers(spark, folder)
    early = stage(star.dim_time(tickets.filter(F.col("sold_at") < "1996-01-01")), "dim_time")
    return star.upsert_dim_time(early, tickets)


@query("""WITH known AS (SELECT p.*, row_number() OVER (ORDER BY p_partkey) AS k FROM part p
  WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)),
fresh AS (SELECT p.*, row_number() OVER (ORDER BY p_partkey) + (SELECT count(*) FROM known) AS k FROM part p
  WHERE p_partkey NOT IN (SELECT p_partkey FROM known))
SELECT k AS product_key, p_partkey AS product_id, p_name AS product_name, p_brand AS category, p_retailprice AS price
FROM (SELECT * FROM known UNION ALL SELECT * FROM fresh)""")
def dim_product(spark, folder):
    """A first load of some products at another price, then the load of all."""
    products = t.products(spark, folder)
    sold = t.lines(spark, folder).filter("quantity = 50").select("product_id").distinct()
    first = products.join(sold, "product_id", "left_semi").withColumn("price", F.lit(0).cast("decimal(10,2)"))
    return star.dim_product(products, stage(star.dim_product(first), "dim_product"))


@query("""SELECT CAST(1 AS BIGINT) AS customer_key, 'General' AS customer_type
UNION ALL SELECT row_number() OVER (ORDER BY s) + 1, s FROM (SELECT DISTINCT c_mktsegment AS s FROM customer)""")
def dim_customer(spark, folder):
    """The market segments as customer types, with the general row added."""
    segments = t.raw(spark, folder, "customer", ["c_mktsegment"]).distinct().toDF("customer_type")
    return star.dim_customer(spark, surrogates.assign_keys(segments, "customer_key", ["customer_type"], start=2))


@query("SELECT row_number() OVER (ORDER BY o_orderkey) AS ticket_key, o_orderkey AS ticket_id FROM orders")
def assign_keys(spark, folder):
    return surrogates.assign_keys(t.headers(spark, folder).select("ticket_id"), "ticket_key", ["ticket_id"])


_FACTS = f"""{t.LINES}, {t.TOTALS}, {t.TICKETS}, keys AS (
  SELECT row_number() OVER (ORDER BY p_partkey) AS product_key, p_partkey AS product_id FROM part), facts AS (
  SELECT CAST(strftime(sold_on, '%Y%m%d') AS INTEGER) AS date_key, product_key, CAST(1 AS BIGINT) AS customer_key,
         lines.ticket_id, quantity, CAST(amount AS DOUBLE) AS amount, CAST(total_amount AS DOUBLE) AS ticket_total,
         total_quantity AS ticket_quantity, lines.product_id
  FROM lines JOIN tickets ON tickets.ticket_id = lines.ticket_id JOIN keys ON keys.product_id = lines.product_id)"""


def _facts(spark, folder) -> DataFrame:
    products = stage(star.dim_product(t.products(spark, folder)), "dim_product")
    return star.fact_sales(t.lines(spark, folder), t.tickets(spark, folder), products)


@query(f"WITH {_FACTS} SELECT * FROM facts")
def fact_sales(spark, folder):
    return _facts(spark, folder)


@query(f"""WITH {_FACTS}, middle AS (SELECT max(l_orderkey) // 2 AS m FROM lineitem)
SELECT date_key, product_key, ticket_id, quantity, amount, CASE WHEN ticket_id <= m THEN 1 ELSE 2 END AS load
FROM facts, middle""")
def fact_increment(spark, folder):
    """Two loads: first while half of the ticket numbers exist, then the rest."""
    lines, tickets = t.lines(spark, folder), t.tickets(spark, folder)
    products = stage(star.dim_product(t.products(spark, folder)), "dim_product")
    middle = lines.agg((F.max("ticket_id") / 2).cast("long")).first()[0]
    early = lines.filter(F.col("ticket_id") <= middle)
    first, mark = star.fact_increment(early, tickets, products, -1, "ticket_id")
    second, _ = star.fact_increment(lines, tickets, products, mark, "ticket_id")
    both = first.withColumn("load", F.lit(1)).unionByName(second.withColumn("load", F.lit(2)))
    return both.select("date_key", "product_key", "ticket_id", "quantity", "amount", "load")


@query(f"WITH {_FACTS} SELECT * FROM facts")
def fact_stream_load(spark, folder):
    """The fact load as a stream: line files land in two deliveries, each followed by a load."""
    lines = t.lines(spark, folder)
    landing, target, progress = (new_path(spark, name) for name in ("landing", "facts", "facts_progress"))
    products = stage(star.dim_product(t.products(spark, folder)), "dim_product")
    tickets = stage(t.tickets(spark, folder), "tickets")
    small = F.col("quantity") < 25
    for delivery in (lines.filter(small), lines.filter(~small)):
        tables.append_batches(landing, delivery)
        new_lines = fact_stream.read_new_lines(spark, landing, lines.schema)
        fact_stream.load_new_facts(new_lines, tickets, products, target, progress).awaitTermination()
    return spark.read.parquet(target).drop("batch")


@query(f"""WITH {_FACTS}
SELECT 'fact customer exists' AS check_name, (SELECT count(*) FROM facts WHERE customer_key <> 1) AS violations
UNION ALL SELECT 'fact date exists', (SELECT count(*) FROM facts WHERE date_key NOT IN (SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) FROM orders))
UNION ALL SELECT 'fact product exists', (SELECT count(*) FROM facts WHERE product_key NOT IN (SELECT product_key FROM keys))
UNION ALL SELECT 'fact ticket and product unique', (SELECT count(*) FROM (SELECT 1 FROM facts GROUP BY ticket_id, product_key HAVING count(*) > 1))
UNION ALL SELECT 'line product exists', (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part))
UNION ALL SELECT 'line ticket exists', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
UNION ALL SELECT 'product id unique', (SELECT count(*) FROM (SELECT 1 FROM part GROUP BY p_partkey HAVING count(*) > 1))
UNION ALL SELECT 'ticket id unique', (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
UNION ALL SELECT 'ticket uuid unique', (SELECT count(*) FROM (SELECT 1 FROM tickets GROUP BY external_uuid HAVING count(*) > 1))""")
def check_keys(spark, folder):
    tickets, lines, products = t.tickets(spark, folder), t.lines(spark, folder), t.products(spark, folder)
    dim = stage(star.dim_product(products), "dim_product")
    facts = stage(star.fact_sales(lines, tickets, dim), "fact_sales")
    return quality.check_keys(tickets, lines, products, facts, star.dim_time(tickets), dim, star.dim_customer(spark))


# --- Baskets ---------------------------------------------------------------


@query(f"WITH {t.BASKETS} SELECT t AS ticket_id, i AS item FROM baskets")
def basket_items(spark, folder):
    return _baskets(spark, folder)


@query(f"WITH {t.BASKETS}, {t.SUPPORTS} SELECT i AS item, s AS support FROM supports")
def item_support(spark, folder):
    return bk.item_support(_baskets(spark, folder))


@query(f"""SELECT o_orderstatus AS status, count(*) AS n_tickets,
       greatest(CAST(ceil(count(*) * CAST(0.0125 AS DECIMAL(10,8))) AS BIGINT), 1) AS min_support
FROM orders GROUP BY o_orderstatus""")
def min_pair_support(spark, folder):
    """Minimum support for the tickets of each order status (three or so rows)."""
    counts = t.raw(spark, folder, "orders", ["o_orderstatus"]).groupBy(F.col("o_orderstatus").alias("status"))
    rows = counts.agg(F.count(F.lit(1)).alias("n_tickets")).collect()
    found = [(r.status, r.n_tickets, bk.min_pair_support(r.n_tickets, Decimal("0.0125"))) for r in rows]
    return spark.createDataFrame(found, "status string, n_tickets long, min_support long")


@query(f"WITH {t.BASKETS}, {t.pairs_sql(MIN_PAIR)} SELECT a, b, n AS support FROM pairs")
def pair_support(spark, folder):
    return bk.pair_support(_baskets(spark, folder), MIN_PAIR)


@query(f"""WITH {t.BASKETS}, {t.pairs_sql(MIN_PAIR)}, counted AS (SELECT n AS support, count(*) AS n_pairs FROM pairs GROUP BY n)
SELECT support, n_pairs, CASE WHEN n_pairs > 100 THEN 'too many pairs' ELSE 'ok' END AS status_with_limit, 'ok' AS status FROM counted""")
def pair_limit_guard(spark, folder):
    """The pairs of each support, judged with a limit of 100, and all pairs without one."""
    pairs = stage(bk.pair_support(_baskets(spark, folder), MIN_PAIR), "pairs")
    counts = pairs.groupBy("support").agg(F.count(F.lit(1)).alias("n_pairs"))
    with_limit = insights.limit_status(F.col("n_pairs"), 100).alias("status_with_limit")
    return counts.select("support", "n_pairs", with_limit, F.lit(insights.pair_limit_guard(pairs)).alias("status"))


@query(f"WITH {t.basket_sql(MIN_PAIR)} SELECT * FROM basket")
def pair_metrics(spark, folder):
    return _basket(spark, folder)


_CATEGORY = f"""cats AS MATERIALIZED (SELECT DISTINCT l_orderkey AS t, p_brand AS i FROM lineitem JOIN part ON p_partkey = l_partkey),
{t.pairs_sql(5, 'cat_pairs', 'cats')}, category AS (
  SELECT a AS category_a, b AS category_b, n AS support, {t.N} AS n_tickets,
         round(CAST(n AS DOUBLE) / {t.N}, 6) AS score,
         CASE WHEN n >= {t.N} * 0.01 THEN 'Alta' WHEN n >= {t.N} * 0.005 THEN 'Media' ELSE 'Baja' END AS priority,
         'General' AS peak_season FROM cat_pairs)"""


@query(f"WITH {_CATEGORY} SELECT * FROM category")
def category_pairs(spark, folder):
    return insights.category_pairs(t.lines(spark, folder), t.products(spark, folder), _n_orders(spark, folder))


@query(f"""WITH {t.BASKETS}, {t.SUPPORTS} SELECT i AS item, s AS support,
  CASE WHEN s >= {t.N} * 0.01 THEN 'Alta' WHEN s >= {t.N} * 0.005 THEN 'Media' ELSE 'Baja' END AS priority FROM supports""")
def priority_band(spark, folder):
    supports = bk.item_support(_baskets(spark, folder))
    return supports.withColumn("priority", insights.priority_band(F.col("support"), _n_orders(spark, folder)))


# --- Frequent sets and rules -----------------------------------------------

_SAMPLE = f"""ranked AS (
  SELECT o_orderkey AS ticket_id, row_number() OVER (PARTITION BY s ORDER BY md5(o_orderkey || ':42'), o_orderkey) AS rn,
         count(*) OVER (PARTITION BY s) AS n
  FROM (SELECT o_orderkey, {t.SEASON.format(d='o_orderdate')} AS s FROM orders)),
sample AS MATERIALIZED (SELECT ticket_id FROM ranked WHERE rn <= n * 0.15)"""


@query(f"WITH {t.BASKETS} SELECT {t.N} AS n_tickets, count(DISTINCT t) AS n_analysed FROM baskets")
def count_tickets(spark, folder):
    analysed = itemsets.count_tickets(_baskets(spark, folder))
    return t.headers(spark, folder).agg(F.count("ticket_id").alias("n_tickets"), F.lit(analysed).cast("long").alias("n_analysed"))


@query(f"WITH {_SAMPLE} SELECT ticket_id FROM sample")
def stratified_sample(spark, folder):
    return sampling.stratified_sample(sampling.tickets_with_season(t.headers(spark, folder)), 0.15)


@query("""SELECT o_orderkey AS ticket_id FROM orders
WHERE CAST('0x' || substr(md5(o_orderkey || ':42'), 1, 8) AS BIGINT) / 4294967296.0 < 0.15""")
def simple_sample(spark, folder):
    return sampling.simple_sample(t.headers(spark, folder), 0.15)


@query(f"WITH {_SAMPLE} SELECT l_orderkey AS ticket_id, l_partkey AS product_id FROM lineitem JOIN sample ON ticket_id = l_orderkey")
def sampled_ticket_lines(spark, folder):
    chosen = sampled_lines(t.headers(spark, folder), t.lines(spark, folder), 0.15)
    return chosen.select("ticket_id", "product_id")


@query(f"WITH {t.BASKETS}, {t.SUPPORTS} SELECT i AS a, s AS support FROM supports WHERE s >= 30")
def frequent_1(spark, folder):
    return itemsets.frequent_1(_baskets(spark, folder), 30)


@query(f"WITH {t.BASKETS}, {t.pairs_sql(MIN_PAIR)} SELECT a, b, n AS support FROM pairs")
def frequent_2(spark, folder):
    return itemsets.frequent_2(_baskets(spark, folder), MIN_PAIR)


_BRANDS = "baskets AS MATERIALIZED (SELECT DISTINCT l_orderkey AS t, p_brand AS i FROM lineitem JOIN part ON p_partkey = l_partkey)"


@query(f"""WITH {t.BASKETS}, {t.pairs_sql(MIN_PAIR)}, levels AS (SELECT DISTINCT n AS least FROM pairs), kept AS (
  SELECT least, a, b FROM levels JOIN pairs ON n >= least), starts AS (
  SELECT least, a, count(*) AS d FROM kept GROUP BY least, a), counted AS (
  SELECT least, CAST(sum(d) AS BIGINT) AS n_pairs, CAST(sum(d * (d - 1) // 2) AS BIGINT) AS n_candidates FROM starts GROUP BY least)
SELECT least AS min_support, n_pairs, n_candidates,
  CASE WHEN n_candidates = 0 THEN 'no candidates' ELSE 'count triples' END AS decision,
  CASE WHEN n_pairs > 1000 THEN 'too many pairs' WHEN n_candidates = 0 THEN 'no candidates'
       WHEN n_candidates > 50 THEN 'too many candidates' ELSE 'count triples' END AS decision_with_limits FROM counted""")
def level_guards(spark, folder):
    """The decision for each possible minimum support, without limits and with limits of the caller's."""
    counts = itemsets.level_counts(_pairs(spark, folder)[2])
    n_pairs, n_candidates = F.col("n_pairs"), F.col("n_candidates")
    limits = itemsets.LevelLimits(max_pairs=1000, max_candidates=50)
    return counts.select(
        "min_support", "n_pairs", "n_candidates", itemsets.decision_of(n_pairs, n_candidates).alias("decision"),
        itemsets.decision_of(n_pairs, n_candidates, limits).alias("decision_with_limits"))


_CANDIDATES = """wedges AS MATERIALIZED (SELECT x.a, x.b, y.b AS c FROM pairs x JOIN pairs y ON x.a = y.a WHERE x.b < y.b), cand AS MATERIALIZED (
  SELECT w.a, w.b, w.c FROM wedges w SEMI JOIN pairs z ON z.a = w.b AND z.b = w.c)"""


@query(f"WITH {t.BASKETS}, {t.pairs_sql(MIN_PAIR)}, {_CANDIDATES} SELECT a, b, c FROM cand ORDER BY a, b, c")
def candidates_3(spark, folder):
    return itemsets.candidates_3(_pairs(spark, folder)[2])


@query(f"WITH {t.itemsets_sql(MIN_PAIR)} SELECT a, b, c, n AS support FROM triples")
def frequent_3(spark, folder):
    baskets, _, pairs = _pairs(spark, folder)
    return itemsets.frequent_3(baskets, pairs, MIN_PAIR)


@query(f"WITH {t.itemsets_sql(MIN_BRANDS, _BRANDS)} SELECT a, b, c, n AS support FROM triples")
def frequent_3_brands(spark, folder):
    """Triples of brands instead of products: few items, and most triples are frequent."""
    baskets, _, pairs = _brand_pairs(spark, folder)
    return itemsets.frequent_3(baskets, pairs, MIN_BRANDS)


@query(f"""WITH {t.BASKETS}, {t.pairs_sql(MIN_PAIR)}, {_CANDIDATES}, held2 AS MATERIALIZED (
  SELECT x.t, x.i AS a, y.i AS b FROM baskets x JOIN baskets y ON y.t = x.t WHERE x.i < y.i), held AS MATERIALIZED (
  SELECT h.a, h.b, z.i AS c, count(*) AS n FROM held2 h JOIN baskets z ON z.t = h.t WHERE h.b < z.i GROUP BY ALL), counted AS (
  SELECT {t.set_text('a', 'b', 'c')} AS itemset_text, coalesce(n, 0) AS support FROM cand LEFT JOIN held USING (a, b, c)
  UNION ALL SELECT {t.set_text('a', 'b')}, n FROM pairs)
SELECT itemset_text, support FROM counted ORDER BY itemset_text""")
def contains_all(spark, folder):
    """Support of all frequent pairs and all candidate triples by the general counting method."""
    baskets, _, pairs = _pairs(spark, folder)
    triples = itemsets.candidates_3(pairs).select(F.array("a", "b", "c").alias("items"))
    sets = stage(triples.unionByName(pairs.select(F.array("a", "b").alias("items"))), "candidate_sets")
    counted = bk.contains_all(sets, baskets)
    return counted.select(itemset_text(F.col("items")).alias("itemset_text"), "support")


@query(f"""WITH {t.BASKETS}, {t.pairs_sql(MIN_PAIR)}
SELECT '[' || a || ',' || b || ']' AS itemset_text, md5('[' || a || ',' || b || ']') AS itemset_hash FROM pairs""")
def itemset_key(spark, folder):
    pairs = bk.pair_support(_baskets(spark, folder), MIN_PAIR)
    unsorted = F.array("b", "a")
    return pairs.select(itemset_text(unsorted).alias("itemset_text"), itemset_hash(unsorted).alias("itemset_hash"))


@query(f"WITH {t.itemsets_sql(MIN_PAIR)} SELECT itemset_text, itemset_hash, CAST(size AS INTEGER) AS size, support, relative_support FROM itemsets")
def frequent_itemsets(spark, folder):
    return _itemsets(spark, folder)[0].drop("items")


@query(f"""WITH {t.itemsets_sql(MIN_PAIR)}, pairs_and_triples AS (SELECT items, support FROM itemsets WHERE size >= 2), masks AS (
  SELECT items, support, unnest(range(1, CAST(pow(2, len(items)) AS BIGINT) - 1)) AS m FROM pairs_and_triples)
SELECT '[' || array_to_string([items[k] FOR k IN range(1, len(items) + 1) IF (m >> (k - 1)) & 1 = 1], ',') || ']' AS antecedent,
       '[' || array_to_string([items[k] FOR k IN range(1, len(items) + 1) IF (m >> (k - 1)) & 1 = 0], ',') || ']' AS consequent, support
FROM masks""")
def enumerate_rules(spark, folder):
    listed = rules.enumerate_rules(_itemsets(spark, folder)[0])
    sides = [itemset_text(F.col(c)).alias(c) for c in ("antecedent", "consequent")]
    return listed.select(*sides, "support")


_RULE_ORDER = "ORDER BY antecedent_text, consequent_text"


@query(f"WITH {t.rules_sql(MIN_PAIR, 0.0)} SELECT {_RULE_COLUMNS} FROM rules {_RULE_ORDER}")
def rule_metrics(spark, folder):
    """All rules, without a confidence cut."""
    return _rule_table(_rules(spark, folder, 0.0))


@query(f"WITH {t.rules_sql(MIN_PAIR, RULE_CONFIDENCE)} SELECT {_RULE_COLUMNS} FROM rules {_RULE_ORDER}")
def association_rules(spark, folder):
    return _rule_table(_rules(spark, folder))


@query(f"""WITH {t.rules_sql(MIN_BRANDS, 0.05, baskets=_BRANDS, quote='"')} SELECT {_RULE_COLUMNS} FROM rules""")
def association_rules_brands(spark, folder):
    """Rules between brands; most have two brands on one side."""
    baskets, supports, pairs = _brand_pairs(spark, folder)
    levels = [itemsets.frequent_1(baskets, MIN_BRANDS, supports), pairs, itemsets.frequent_3(baskets, pairs, MIN_BRANDS)]
    n = itemsets.count_tickets(baskets)
    return _rule_table(rules.association_rules(stage(itemsets.frequent_itemsets(levels, n), "itemsets"), n, 0.05))


_SAMPLED_BASKETS = f"{_SAMPLE}, baskets AS MATERIALIZED (SELECT DISTINCT l_orderkey AS t, l_partkey AS i FROM lineitem JOIN sample ON ticket_id = l_orderkey)"


@query(f"WITH {t.rules_sql(_SAMPLE_MIN, 0.5, 0.15, _SAMPLED_BASKETS)} SELECT {_RULE_COLUMNS} FROM rules {_RULE_ORDER}")
def extrapolate_support(spark, folder):
    """Rules of the season sample, with supports scaled up to all tickets."""
    found = mine(
        t.tickets(spark, folder), t.lines(spark, folder), REL_SUPPORT, 0.15, min_confidence=0.5,
    )
    return _rule_table(found.rules)


@query(f"""WITH {t.rules_sql(MIN_PAIR, RULE_CONFIDENCE)} SELECT antecedent_hash, consequent_hash, support, confidence, lift,
  conviction, leverage FROM rules {_RULE_ORDER}""")
def upsert_rules(spark, folder):
    """Rules of an earlier run with other values, brought up to date."""
    found = stage(_rule_table(_rules(spark, folder)), "rules")
    earlier = found.filter("lift < 20").withColumn("support", F.col("support") - 1).withColumn("lift", F.lit(0.0))
    merged = upserts.upsert(earlier, found, rules.RULE_KEYS, rules.RULE_UPDATES)
    return merged.select(*rules.RULE_KEYS, "support", "confidence", "lift", "conviction", "leverage")


# --- Insights --------------------------------------------------------------

_RECOMMENDED = f"""rec AS (SELECT product_a AS trigger_product, product_b AS recommended_product, 'Market Basket' AS kind,
  CAST(round(CAST(confidence_ab AS DECIMAL(7,6)) * CAST(lift AS DECIMAL(18,6)) * CAST(0.5 AS DECIMAL(2,1)), 6) AS DOUBLE) AS score,
  confidence_ab AS probability,
  CAST(round(pb.price * CAST(confidence_ab AS DECIMAL(7,6)), 2) AS DOUBLE) AS uplift,
  'Clientes que compran ' || pa.product_name || ' también compran ' || pb.product_name AS message, 'MBA' AS source
  FROM basket JOIN products pa ON pa.product_id = product_a JOIN products pb ON pb.product_id = product_b WHERE {_STRONG})"""
_BUNDLED = f"""bundled AS (SELECT product_a, product_b,
  'Bundle_' || replace(pa.product_name, ' ', '_') || '_' || replace(pb.product_name, ' ', '_') AS bundle_name,
  pa.product_name || ' + ' || pb.product_name AS products, 'Producto_Cross' AS kind,
  CAST(round(CAST(lift AS DECIMAL(24,6)) * (pa.price + pb.price) * CAST(confidence_ab AS DECIMAL(7,6)), 4) AS DOUBLE) AS potential
  FROM basket JOIN products pa ON pa.product_id = product_a JOIN products pb ON pb.product_id = product_b WHERE {_STRONG}
  ORDER BY potential DESC, product_a, product_b LIMIT 100)"""
# DuckDB's running moments, not the sums that the library takes.
_ANOMALIES = """stats AS (SELECT CAST(sum(total_amount) AS DOUBLE) / count(*) AS m, stddev_pop(CAST(total_amount AS DOUBLE)) AS d FROM totals),
  anomalies AS (SELECT ticket_id, 'Valor_Extremo' AS kind, round((CAST(total_amount AS DOUBLE) - m) / d, 6) AS score,
  'Ticket con valor ' || CAST(total_amount AS VARCHAR) || ' vs promedio ' || CAST(CAST(m AS DECIMAL(20,2)) AS VARCHAR) AS message
  FROM totals, stats WHERE abs(CAST(total_amount AS DOUBLE) - m) > 2.5 * d)"""
_COMPARED = """single AS (SELECT least(antecedent_hash, consequent_hash) AS lo, greatest(antecedent_hash, consequent_hash) AS hi,
  max(confidence) AS c, max(lift) AS l FROM rules
  WHERE antecedent_text NOT LIKE '%,%' AND consequent_text NOT LIKE '%,%' GROUP BY 1, 2), compared AS (
  SELECT product_a, product_b, greatest(confidence_ab, confidence_ba) AS confidence_basket, coalesce(c, 0.0)::DOUBLE AS confidence_rules,
  basket.lift AS lift_basket, coalesce(l, 0.0)::DOUBLE AS lift_rules,
  round(greatest(confidence_ab, confidence_ba) - coalesce(c, 0), 6) AS delta_confidence,
  round(basket.lift - coalesce(l, 0), 6) AS delta_lift,
  CASE WHEN basket.lift >= coalesce(l, 0) THEN 'MBA' ELSE 'APRIORI' END AS winner
  FROM basket LEFT JOIN single ON lo = least(hash_a, hash_b) AND hi = greatest(hash_a, hash_b))"""


def _recommended(spark, folder) -> DataFrame:
    basket = stage(_basket(spark, folder), "basket")
    return insights.recommendations(basket, t.products(spark, folder), MIN_CONFIDENCE)


def _bundled(spark, folder) -> DataFrame:
    return insights.bundles(stage(_basket(spark, folder), "basket"), t.products(spark, folder), MIN_CONFIDENCE)


def _compared(spark, folder) -> DataFrame:
    found = _pairs(spark, folder)
    return insights.compare_methods(_basket(spark, folder, found), _rules(spark, folder, found=found))


def _anomalies(spark, folder) -> DataFrame:
    return insights.ticket_anomalies(stage(cleanse.ticket_totals(t.lines(spark, folder)), "ticket_totals"))


@query(f"WITH {t.basket_sql(MIN_PAIR)}, {_RECOMMENDED} SELECT * FROM rec")
def recommendations(spark, folder):
    return _recommended(spark, folder)


@query(f"WITH {t.LINES}, {t.TOTALS}, {_ANOMALIES} SELECT * FROM anomalies")
def ticket_anomalies(spark, folder):
    return _anomalies(spark, folder)


@query(f"WITH {t.basket_sql(MIN_PAIR)}, {_BUNDLED} SELECT * FROM bundled")
def bundles(spark, folder):
    return _bundled(spark, folder)


@query(f"""WITH {t.rules_sql(MIN_PAIR, RULE_CONFIDENCE)} SELECT antecedent_hash, consequent_hash, max(confidence) AS confidence,
  max(lift) AS lift FROM rules WHERE antecedent_text NOT LIKE '%,%' AND consequent_text NOT LIKE '%,%' GROUP BY 1, 2""")
def rule_pair_lookup(spark, folder):
    return insights.rule_pair_lookup(_rules(spark, folder))


def _basket_and_rules(minimum) -> str:
    """Pair metrics and rules as one chain; both start with the same basket steps."""
    shared = f"{t.BASKETS}, {t.SUPPORTS}, {t.pairs_sql(minimum)}, "
    return f"WITH {t.basket_sql(minimum)}, {t.rules_sql(minimum, RULE_CONFIDENCE).replace(shared, '', 1)}"


_BASKET_AND_RULES = _basket_and_rules(MIN_PAIR)


@query(f"{_BASKET_AND_RULES}, {_COMPARED} SELECT * FROM compared")
def compare_methods(spark, folder):
    return _compared(spark, folder)


@query(f"""WITH {t.rules_sql(MIN_PAIR, RULE_CONFIDENCE)} SELECT count(*) > 0 AS present, false AS present_when_empty FROM rules""")
def rules_present(spark, folder):
    found = stage(_rules(spark, folder), "rules")
    row = (insights.rules_present(found), insights.rules_present(found.filter("support < 0")))
    return spark.createDataFrame([row], "present boolean, present_when_empty boolean")


# --- Reports ---------------------------------------------------------------


@query(f"""WITH {t.basket_sql(MIN_PAIR)}
SELECT product_a, product_b, pa.product_name AS name_a, pb.product_name AS name_b, lift, confidence_ab
FROM basket JOIN products pa ON pa.product_id = product_a JOIN products pb ON pb.product_id = product_b
ORDER BY lift DESC, product_a, product_b LIMIT 50""")
def report_basket(spark, folder):
    return reports.report_basket(_basket(spark, folder), t.products(spark, folder))


@query(f"WITH {_CATEGORY} SELECT * FROM category ORDER BY score DESC, category_a, category_b LIMIT 50")
def report_category(spark, folder):
    return reports.report_category(
        insights.category_pairs(t.lines(spark, folder), t.products(spark, folder), _n_orders(spark, folder))
    )


@query(f"""WITH {t.basket_sql(MIN_PAIR)}, {_RECOMMENDED}
SELECT rec.*, pa.product_name AS trigger_name, pb.product_name AS recommended_name
FROM rec JOIN products pa ON pa.product_id = trigger_product JOIN products pb ON pb.product_id = recommended_product
ORDER BY score DESC, trigger_product, recommended_product, source LIMIT 50""")
def report_recommendations(spark, folder):
    return reports.report_recommendations(_recommended(spark, folder), t.products(spark, folder))


@query(f"WITH {t.LINES}, {t.TOTALS}, {_ANOMALIES} SELECT * FROM anomalies ORDER BY score DESC, ticket_id LIMIT 30")
def report_anomalies(spark, folder):
    return reports.report_anomalies(_anomalies(spark, folder))


@query(f"""WITH {t.basket_sql(MIN_PAIR)}, {_BUNDLED}
SELECT * FROM bundled ORDER BY potential DESC, bundle_name, product_a, product_b LIMIT 30""")
def report_bundles(spark, folder):
    return reports.report_bundles(_bundled(spark, folder))


@query(f"""WITH {t.rules_sql(MIN_PAIR, RULE_CONFIDENCE)} SELECT {_RULE_COLUMNS} FROM rules
ORDER BY lift DESC, confidence DESC, antecedent_text, consequent_text LIMIT 50""")
def report_rules(spark, folder):
    return reports.report_rules(_rule_table(_rules(spark, folder)))


@query(f"""{_BASKET_AND_RULES}, {_COMPARED}
SELECT compared.*, pa.product_name AS name_a, pb.product_name AS name_b
FROM compared JOIN products pa ON pa.product_id = product_a JOIN products pb ON pb.product_id = product_b
ORDER BY abs(delta_lift) DESC, product_a, product_b LIMIT 50""")
def report_comparison(spark, folder):
    return reports.report_comparison(_compared(spark, folder), t.products(spark, folder))


# --- Checks ----------------------------------------------------------------


@query(f"SELECT {t.N} AS n_tickets, count(*) AS n_lines, CAST(count(*) AS DOUBLE) / {t.N} AS lines_per_ticket FROM lineitem")
def load_counts(spark, folder):
    return quality.load_counts(t.headers(spark, folder), t.lines(spark, folder))


@query("""SELECT avg(n) AS avg_items, avg(n) BETWEEN 8 AND 20 AS in_range
FROM (SELECT count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY l_orderkey)""")
def avg_distinct_items(spark, folder):
    return quality.avg_distinct_items(t.lines(spark, folder))


@query(f"WITH {t.LINES}, {t.TOTALS}, {t.TICKETS} SELECT count(*) AS n_tickets FROM tickets WHERE total_quantity = 0")
def zero_quantity_tickets(spark, folder):
    return quality.zero_quantity_tickets(t.tickets(spark, folder))


@query("""SELECT count(*) AS n_lines FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def orphan_lines(spark, folder):
    """Lines that would be orphans if only finished orders had been loaded."""
    finished = t.raw(spark, folder, "orders", ["o_orderkey", "o_orderstatus"]).filter("o_orderstatus = 'F'")
    return quality.orphan_lines(t.lines(spark, folder), finished.select(F.col("o_orderkey").alias("ticket_id")))


@query("SELECT count(*) > 0 AS lines_present, false AS negative_lines_present FROM lineitem")
def empty_input_guards(spark, folder):
    lines = t.lines(spark, folder)
    row = (quality.has_rows(lines), quality.has_rows(lines.filter("quantity < 0")))
    return spark.createDataFrame([row], "lines_present boolean, negative_lines_present boolean")


def _run(spark, folder):
    tickets, lines = stage(t.tickets(spark, folder), "tickets"), t.lines(spark, folder)
    found = mine(tickets, lines, REL_SUPPORT, 1.0, min_confidence=RULE_CONFIDENCE)
    cuts = Thresholds(min_confidence=MIN_CONFIDENCE)
    return run_use_cases(t.products(spark, folder), tickets, lines, REL_SUPPORT, found.rules, cuts=cuts)


def _audit_sql(basket: str, rec: str, compared: str, comment: str) -> str:
    return f"""SELECT (SELECT count(*) FROM lineitem) AS input_rows, {basket} AS n_basket,
  (SELECT count(*) FROM category) AS n_category, {rec} AS n_recommendations,
  (SELECT count(*) FROM anomalies) AS n_anomalies, least({rec}, 100) AS n_bundles, {compared} AS n_comparison,
  'COMPLETADO' AS status,
  'MBA:' || {basket} || ', Cat:' || (SELECT count(*) FROM category) || ', Rec:' || {rec} || ', Anom:' ||
  (SELECT count(*) FROM anomalies) || ', Bnd:' || least({rec}, 100) || ', Cmp:' || {compared} AS message,
  'Soporte Relativo: {comment}' AS comment"""


# In the full run the anomalies look at all tickets, also those without lines.
_ALL_TICKETS = f"{t.LINES}, {t.TOTALS}, {t.TICKETS}, {_ANOMALIES.replace('FROM totals', 'FROM tickets')}"
_N_BASKET, _N_REC = "(SELECT count(*) FROM basket)", "(SELECT count(*) FROM rec)"


@query(f"""WITH {t.basket_sql(_REL_MIN)}, {_RECOMMENDED}, {_CATEGORY}, {_ALL_TICKETS}
{_audit_sql(_N_BASKET, _N_REC, _N_BASKET, '0.00010000')}""")
def audit_counts(spark, folder):
    return _run(spark, folder).audit


@query("SELECT count(*) AS n_rows FROM lineitem")
def refresh_statistics(spark, folder):
    """Save the line table in the catalog and let Spark count it for the optimizer."""
    name = "basketlab_lines_checked"
    tables.save_table(t.lines(spark, folder), name, new_path(spark, "lines"))
    quality.refresh_statistics(spark, [name])
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Statistics'")
    return details.select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long").alias("n_rows"))


@query(f"{_basket_and_rules(_REL_MIN)}, {_COMPARED} SELECT * FROM compared")
def run_use_cases_comparison(spark, folder):
    """Last table of the full run: it needs dimensions, facts, pairs and mined rules."""
    return _run(spark, folder).tables["comparison"]


@query(f"""WITH {_CATEGORY} SELECT * FROM category""")
def run_use_cases_standard(spark, folder):
    """The standard run: at its support no product pair remains, but category pairs do."""
    result = run_use_cases_simple(t.products(spark, folder), t.tickets(spark, folder), t.lines(spark, folder))
    return result.tables["category"]


@query(f"""WITH {t.basket_sql(_REL_MIN)}, top AS (
  SELECT * FROM basket ORDER BY lift DESC, product_a, product_b LIMIT 50)
SELECT row_number() OVER (ORDER BY lift DESC, product_a, product_b) AS position,
       product_a AS producto_a_key, product_b AS producto_b_key, lift, 'written' AS report FROM top""")
def run_all(spark, folder):
    """Load from files, mine, analyse, store and report; then the basket report read back."""
    place = new_path(spark, "run_all")
    t.products(spark, folder).select(
        F.col("product_id").alias("Identificador"), F.col("product_name").alias("Producto"),
        F.col("price").cast("string").alias("Precio"), F.col("category").alias("Categoria"),
    ).write.option("header", True).csv(f"{place}/products")
    uuid = F.md5(F.col("ticket_id").cast("string"))
    incoming = t.lines(spark, folder).select(uuid.alias("external_uuid"), "product_id", "quantity")
    prefix = "run_" + place.rsplit("-", 1)[-1][:12]
    load.run_all(spark, f"{place}/products", t.headers(spark, folder), incoming, REL_SUPPORT, prefix, place, date(2024, 1, 31))
    row = "struct<producto_a_key:bigint,producto_b_key:bigint,lift:double>"
    read = report_json.read_report_json(spark, f"{place}/{prefix}_reports", ["market_basket_analysis"], row)
    return read.select((F.col("position") + 1).alias("position"), "row.*", F.lit("written").alias("report"))
