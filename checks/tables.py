"""The test tables in the library's layouts, from Spark and as SQL for the other engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketlab.operators.cleanse import ticket_totals
from basketlab.sources.tables import read_table


def raw(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet", columns)


def products(spark: SparkSession, folder: str, category: str = "p_brand") -> DataFrame:
    return raw(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col(category).alias("category"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("amount"),
    )


def headers(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets without totals."""
    return raw(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ticket_id"),
        F.col("o_orderdate").alias("sold_at"),
        F.md5(F.col("o_orderkey").cast("string")).alias("external_uuid"),
    )


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Tickets with totals from their lines; a ticket without lines has 0."""
    totals = ticket_totals(lines(spark, folder))
    return headers(spark, folder).join(totals, "ticket_id", "left").select(
        "ticket_id", "sold_at", "external_uuid",
        F.coalesce("total_amount", F.lit(0)).cast("decimal(20,2)").alias("total_amount"),
        F.coalesce("total_quantity", F.lit(0)).cast("long").alias("total_quantity"),
    )


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so both engines hand over the same values."""
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            columns.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            columns.append(F.date_format(f.name, "yyyy-MM-dd").alias(f.name))
        else:
            columns.append(F.col(f.name))
    return df.select(*columns)


PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_brand AS category
  FROM part)"""
LINES = """lines AS (
  SELECT l_orderkey AS ticket_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS amount
  FROM lineitem)"""
TOTALS = """totals AS (
  SELECT ticket_id, CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount, CAST(sum(quantity) AS BIGINT) AS total_quantity
  FROM lines GROUP BY ticket_id HAVING sum(amount) > 0 AND sum(quantity) > 0)"""
TICKETS = """tickets AS (
  SELECT o_orderkey AS ticket_id, CAST(o_orderdate AS DATE) AS sold_on,
         md5(CAST(o_orderkey AS VARCHAR)) AS external_uuid,
         coalesce(total_amount, 0) AS total_amount, coalesce(total_quantity, 0) AS total_quantity
  FROM orders LEFT JOIN totals ON ticket_id = o_orderkey)"""
# The season of each month, January first.
SEASONS = [
    "Invierno", "Invierno", "Primavera", "Primavera", "Primavera", "Verano",
    "Verano", "Verano", "Otoño", "Otoño", "Otoño", "Invierno",
]
SEASON = "[" + ", ".join(f"'{name}'" for name in SEASONS) + "][month({d})]"
BASKETS = "baskets AS MATERIALIZED (SELECT DISTINCT l_orderkey AS t, l_partkey AS i FROM lineitem)"
SUPPORTS = "supports AS MATERIALIZED (SELECT i, count(*) AS s FROM baskets GROUP BY i)"
N = "(SELECT count(*) FROM orders)"
N_BASKETS = "(SELECT count(DISTINCT t) FROM baskets)"


def pairs_sql(minimum: int | str, name: str = "pairs", baskets: str = "baskets") -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT x.i AS a, y.i AS b, count(*) AS n FROM {baskets} x JOIN {baskets} y ON x.t = y.t AND x.i < y.i
  GROUP BY x.i, y.i HAVING count(*) >= {minimum})"""


def basket_sql(minimum: int | str) -> str:
    """The pair metrics table as a chain of common table expressions."""
    return f"""{PRODUCTS}, {BASKETS}, {SUPPORTS}, {pairs_sql(minimum)}, basket AS MATERIALIZED (
  SELECT a AS product_a, b AS product_b, md5('[' || a || ']') AS hash_a, md5('[' || b || ']') AS hash_b,
         n AS support, sa.s AS support_a, sb.s AS support_b,
         round(CAST(n AS DOUBLE) / sa.s, 6) AS confidence_ab, round(CAST(n AS DOUBLE) / sb.s, 6) AS confidence_ba,
         round(CAST(n AS DOUBLE) * {N} / (CAST(sa.s AS DOUBLE) * sb.s), 6) AS lift,
         round(CAST(n AS DOUBLE) / (sa.s + sb.s - n), 6) AS jaccard,
         pa.category AS category_a, pb.category AS category_b
  FROM pairs JOIN supports sa ON sa.i = a JOIN supports sb ON sb.i = b
  JOIN products pa ON pa.product_id = a JOIN products pb ON pb.product_id = b)"""


def itemsets_sql(minimum: int | str, baskets: str = BASKETS) -> str:
    """Frequent sets of one to three items and their relative support."""
    return f"""{baskets}, {SUPPORTS}, {pairs_sql(minimum)}, triples AS MATERIALIZED (
  SELECT x.i AS a, y.i AS b, z.i AS c, count(*) AS n
  FROM baskets x JOIN baskets y ON x.t = y.t AND x.i < y.i JOIN baskets z ON y.t = z.t AND y.i < z.i
  GROUP BY x.i, y.i, z.i HAVING count(*) >= {minimum}), sets AS (
  SELECT [i] AS items, s AS support FROM supports WHERE s >= {minimum}
  UNION ALL SELECT [a, b], n FROM pairs UNION ALL SELECT [a, b, c], n FROM triples), itemsets AS MATERIALIZED (
  SELECT items, '[' || array_to_string(items, ',') || ']' AS itemset_text,
         md5('[' || array_to_string(items, ',') || ']') AS itemset_hash,
         len(items) AS size, support, round(CAST(support AS DOUBLE) / {N_BASKETS}, 6) AS relative_support,
         array_to_string(items, chr(1)) AS set_key
  FROM sets)"""


def set_text(*items: str, quote: str = "") -> str:
    """The text of a set whose items are these columns, in order."""
    return "'[" + quote + "' || " + f" || '{quote},{quote}' || ".join(items) + f" || '{quote}]'"


def rules_sql(minimum: int | str, min_confidence: float, rate: float = 1.0, baskets: str = BASKETS, quote: str = "") -> str:
    """Rules of the frequent sets: two of each pair, six of each triple, joined on the items themselves."""
    n = N_BASKETS
    support = "n" if rate >= 1 else f"CAST(ceil(n / {rate}) AS BIGINT)"
    splits = {"held2": [("a", "b"), ("b", "a")], "held3": [("a", "bc"), ("b", "ac"), ("c", "ab"), ("bc", "a"), ("ac", "b"), ("ab", "c")]}
    listed = " UNION ALL ".join(
        f"SELECT {set_text(*x, quote=quote)} AS x, {set_text(*y, quote=quote)} AS y, s{x} AS sx, s{y} AS sy, n FROM {held}"
        for held, sides in splits.items() for x, y in sides)
    return f"""{baskets}, {SUPPORTS}, {pairs_sql(minimum)}, triples AS MATERIALIZED (
  SELECT x.i AS a, y.i AS b, z.i AS c, count(*) AS n
  FROM baskets x JOIN baskets y ON x.t = y.t AND x.i < y.i JOIN baskets z ON y.t = z.t AND y.i < z.i
  GROUP BY x.i, y.i, z.i HAVING count(*) >= {minimum}), held2 AS MATERIALIZED (
  SELECT p.a, p.b, p.n, x.s AS sa, y.s AS sb FROM pairs p JOIN supports x ON x.i = p.a JOIN supports y ON y.i = p.b), held3 AS MATERIALIZED (
  SELECT t.a, t.b, t.c, t.n, ab.sa, ab.sb, bc.sb AS sc, ab.n AS sab, ac.n AS sac, bc.n AS sbc
  FROM triples t JOIN held2 ab ON ab.a = t.a AND ab.b = t.b JOIN held2 ac ON ac.a = t.a AND ac.b = t.c
  JOIN held2 bc ON bc.a = t.b AND bc.b = t.c), splits AS MATERIALIZED (
  {listed}), scored AS MATERIALIZED (
  SELECT x, y, n, CAST(n AS DOUBLE) / sx AS cf, CAST(n AS DOUBLE) / {n} AS r, CAST(sx AS DOUBLE) / {n} AS rx, CAST(sy AS DOUBLE) / {n} AS ry
  FROM splits WHERE CAST(n AS DOUBLE) / sx >= {min_confidence}), rules AS (
  SELECT x AS antecedent_text, y AS consequent_text, md5(x) AS antecedent_hash, md5(y) AS consequent_hash, {support} AS support,
         round(r, 6) AS relative_support, round(cf, 6) AS confidence, round(cf / ry, 6) AS lift,
         round(CASE WHEN cf < 0.999999 THEN (1 - ry) / (1 - cf) ELSE 999999.0 END, 6) AS conviction,
         round(r - rx * ry, 6) + 0.0 AS leverage, 'APRIORI' AS source
  FROM scored)"""
