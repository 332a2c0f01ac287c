import datetime as dt
import hashlib
import json
from decimal import Decimal

from pyspark.sql import functions as F

from basketlab.functions import calendar as cal
from basketlab.functions import money
from basketlab.functions.text_hash import item_hash, itemset_hash, itemset_text, seeded_fraction


def test_parse_price_texts(spark):
    texts = ["$1,234.565", " 10 ", "abc", None, "2.675", "1.00499996", "", "-3.005", "99999999.99", "100000000", "\t7\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(money.parse_price(F.col("t")).alias("p"))
    got = [r.p for r in df.collect()]
    want = ["1234.57", "10.00", None, None, "2.68", "1.00", None, "-3.01", "99999999.99", None, "7.00"]
    assert got == [None if w is None else Decimal(w) for w in want]


def test_parse_price_number(spark):
    df = spark.createDataFrame([(19.995,), (3.0,)], "x double").select(money.parse_price(F.col("x")).alias("p"))
    assert [str(r.p) for r in df.collect()] == ["20.00", "3.00"]


def test_line_total_rounds_half_up(spark):
    df = spark.createDataFrame([(Decimal("0.3350"), 1), (Decimal("1.2500"), 3)], "p decimal(14,4), q long")
    assert [str(r[0]) for r in df.select(money.line_total(F.col("p"), F.col("q"))).collect()] == ["0.34", "3.75"]


def test_messages_show_two_decimals(spark):
    df = spark.range(1).select(
        money.ticket_message(F.lit(Decimal("10")), F.lit(3.14159)).alias("a"),
        money.buyers_message(F.lit("café"), F.lit("té")).alias("b"),
    )
    row = df.first()
    assert row.a == "Ticket con valor 10.00 vs promedio 3.14"
    assert row.b == "Clientes que compran café también compran té"


def test_ratio_by_zero_is_null(spark):
    assert spark.range(1).select(money.ratio(F.lit(3), F.lit(0)).alias("r")).first().r is None


def monday_week(day):
    """Monday weeks 0-53, from the ISO calendar."""
    year, week, _ = day.isocalendar()
    if year < day.year:
        return 0
    return week if year == day.year else monday_week(day - dt.timedelta(days=7)) + 1


def test_monday_week_over_thirty_years(spark):
    days = spark.sql("SELECT explode(sequence(date'2000-01-01', date'2029-12-31')) AS d")
    rows = days.select("d", cal.monday_week(F.col("d")).alias("w")).collect()
    assert [(r.d, r.w) for r in rows if r.w != monday_week(r.d)] == []
    weeks = {str(r.d): r.w for r in rows}
    assert weeks["2021-01-01"] == 0 and weeks["2024-12-30"] == 53


def test_seasons_and_names(spark):
    dates = ["2024-02-29", "2024-03-01", "2024-06-01", "2024-09-01", "2024-12-01", "2024-11-30", "2023-01-01"]
    df = spark.createDataFrame([(d,) for d in dates], "s string").select(F.to_date("s").alias("d"))
    d = F.col("d")
    rows = df.select(
        cal.season(d).alias("s"), cal.month_name(d).alias("m"), cal.day_name(d).alias("n"),
        cal.date_key(d).alias("k"), cal.is_weekend(d).alias("w"), cal.period(d).alias("p"),
    ).collect()
    assert [r.s for r in rows] == ["Invierno", "Primavera", "Verano", "Otoño", "Invierno", "Otoño", "Invierno"]
    assert rows[0] == ("Invierno", "Febrero", "Jueves", 20240229, 0, "2024-02")
    assert rows[6] == ("Invierno", "Enero", "Domingo", 20230101, 1, "2023-01")


def test_itemset_keys_equal_compact_json(spark):
    df = spark.createDataFrame([([12, 3, 7],), ([5],)], "items array<bigint>")
    rows = df.select(itemset_text(F.col("items")).alias("t"), itemset_hash(F.col("items")).alias("h")).collect()
    for row, items in zip(rows, ([3, 7, 12], [5])):
        text = json.dumps(items, separators=(",", ":"))
        assert (row.t, row.h) == (text, hashlib.md5(text.encode()).hexdigest())
    assert spark.range(5, 6).select(item_hash(F.col("id"))).first()[0] == rows[1].h


def test_seeded_fraction_is_repeatable_and_even(spark):
    df = spark.range(20_000).select("id", seeded_fraction(F.col("id"), 7).alias("x"))
    first = {r.id: r.x for r in df.collect()}
    again = {r.id: r.x for r in df.repartition(3).collect()}
    assert first == again
    assert abs(sum(first.values()) / len(first) - 0.5) < 0.01 and max(first.values()) < 1
