import pytest
from pyspark.sql import functions as F

from basketlab.operators import joins


@pytest.fixture
def skewed(spark):
    """A third of the rows under one key, some keys without partner on either side."""
    big = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50 + 100).cast("long").alias("k"),
        F.col("id").alias("v"),
    )
    other = spark.createDataFrame([(7, "hot"), (7, "hot again"), (105, "x"), (999, "none")], "k long, name string")
    return big, other


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, how):
    big, other = skewed
    hot = joins.hot_keys(big, ["k"], fraction=0.1, sample=1.0, min_rows=2)
    assert [r.k for r in hot] == [7]
    salted = joins.salted_join(big, other, ["k"], how, hot=hot, salts=5)
    plain = big.join(other, ["k"], how)
    assert salted.columns == plain.columns
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salted_rows_spread(skewed):
    big, other = skewed
    hot = joins.hot_keys(big, ["k"], fraction=0.1, sample=1.0, min_rows=2)
    plan = joins.salted_join(big, other, ["k"], hot=hot, salts=5)._jdf.queryExecution().toString()
    assert "_salt" in plan


def test_keys_of_half_a_percent_are_hot_and_equal_rows_spread(spark):
    big = spark.range(1_000_000).select(F.when(F.col("id") < 4500, -1).otherwise(F.col("id")).alias("k"), F.lit("x").alias("v"))
    assert [r["k"] for r in joins.hot_keys(big, ["k"], fraction=0.25 / 200)] == [-1]
    equal = spark.createDataFrame([(1, "same")], "k long, v string").select(F.explode(F.array_repeat(F.struct("k", "v"), 4000))).select("col.*")
    other = spark.createDataFrame([(1, "w"), (2, "z")], "k long, w string")
    plan = joins.salted_join(equal, other, ["k"], hot=[(1,)], salts=8)
    assert plan.count() == 4000 and plan.select("w").distinct().count() == 1
    placed = equal.sortWithinPartitions("k", "v").withColumn("s", F.pmod(F.monotonically_increasing_id(), F.lit(8)))
    assert placed.select("s").distinct().count() == 8


def test_hot_keys_are_bounded(spark):
    every = spark.range(1000).select((F.col("id") % 4).alias("k"))
    found = joins.hot_keys(every, ["k"], fraction=0.2, sample=1.0, min_rows=2)
    assert sorted(r.k for r in found) == [0, 1, 2, 3]
    assert joins.hot_keys(every, ["k"], fraction=0.3, sample=1.0, min_rows=2) == []


def test_lookup_join_both_ways(skewed):
    big, other = skewed
    small = joins.lookup_join(big, other, ["k"])
    large = joins.lookup_join(big, other, ["k"], max_bytes=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_measured_bytes_grows_with_text(spark):
    df = spark.createDataFrame([("a" * 100,), ("b",), (None,)], "t string")
    assert joins.measured_bytes(df) == 16 * 3 + 101
    assert not joins.fits_broadcast(df, 100) and joins.fits_broadcast(df)
    assert joins.measured_bytes(df.filter("false")) == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("fraction", [0.1, 0.9])  # one hot key, none
def test_joins_of_many_rows_take_more_parts(skewed, how, fraction, monkeypatch):
    monkeypatch.setattr(joins, "JOIN_ROWS", 100)
    big, other = skewed
    hot = joins.hot_keys(big, ["k"], fraction=fraction, sample=1.0, min_rows=2)
    assert hot.rows == 3000 and len(hot) == (fraction < 0.5)
    monkeypatch.setattr(joins, "hot_keys", lambda df, on: hot)
    found = joins.salted_join(big, other, ["k"], how)
    assert ", 30), REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, found.collect())) == sorted(map(str, big.join(other, ["k"], how).collect()))


def test_an_empty_sample_has_no_hot_keys(skewed):
    big, other = skewed
    empty = big.filter("k < 0")
    hot = joins.hot_keys(empty, ["k"])
    assert (list(hot), hot.rows) == ([], 0)
    assert joins.salted_join(empty, other, ["k"]).count() == 0
