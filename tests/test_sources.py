"""The derived feed and exact amounts."""

from pyspark.sql import functions as F

from strata.functions import exact_avg, exact_sum, round_half_up
from strata.operators import profile
from strata.plans import catalog
from strata.sources.feed import subscriber_feed


def test_feed_fixture_counts(spark):
    raw = catalog.feed(spark, "/root/testdata/sf0.01")
    assert raw.count() == 15000
    assert raw.select("customerID").distinct().count() == 15000
    assert raw.filter("tenure = '0'").count() == 206
    assert raw.filter("TotalCharges = ' '").count() == 103


def test_long_keys_keep_all_their_digits(spark):
    orders = spark.range(10).select(
        (F.lit(120_000_000_000) + F.col("id")).alias("o_orderkey"), F.lit(10.0).alias("o_totalprice"),
        F.lit("F").alias("o_orderstatus"), F.lit("1-URGENT").alias("o_orderpriority"))
    ids = {r[0] for r in subscriber_feed(orders).select("customerID").collect()}
    assert ids == {f"C{120_000_000_000 + i}" for i in range(10)}


def test_sums_round_once_and_lose_nothing(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert small.agg(round_half_up(exact_sum("x"))).first()[0] == 4.0
    large = spark.createDataFrame([(1e30,), (1.5,), (None,)], "x double")
    total, mean = large.agg(exact_sum("x"), exact_avg("x")).first()
    assert total == 1e30 and mean == 5e29
    assert spark.range(1).select(round_half_up(F.lit(1.00499999999996))).first()[0] == 1.0


def test_numeric_profile_takes_any_size(spark):
    text = spark.createDataFrame([("1e30",), ("1e-11",), (" 7 ",), ("x",), ("",), ("NaN",)], "t string")
    row = profile.numeric_profile(text, ["t"]).first()
    assert (row["invalid_or_blank"], row["min_value"], row["max_value"]) == (3, 1e-11, 1e30)
