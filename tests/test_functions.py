"""CASE chains and the numeric contract on boundary fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillroll.functions import labels
from tillroll.functions.numeric import growth_pct, pct, pct_scaled, rnd


def _apply(spark, values, fn, dtype="double"):
    conv = float if dtype == "double" else int
    df = spark.createDataFrame([(i, conv(v)) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_tier5_boundaries(spark):
    got = _apply(spark, [10, 9.99, 5, 4.99, -5, -5.01, -15, -15.01], labels.performance_tier5)
    assert got == ["Strong Performer", "Above Average", "Above Average", "Average", "Average",
                   "Below Average", "Below Average", "Underperforming"]


def test_recommendation_boundaries(spark):
    got = _apply(spark, [-10.01, -10, -5.01, -5, 10], labels.recommendation)
    assert [g.split()[0] for g in got] == ["Immediate", "Monitor", "Monitor", "Maintain", "Replicate"]


def test_tier3_boundaries(spark):
    assert _apply(spark, [5, 4.99, -4.99, -5], labels.performance_tier3) == [
        "Above Average", "Average", "Average", "Below Average"]


def test_tier_on_rounded_value_differs(spark):
    # 4.996 rounds to 5.00: the dataframe KPI tier says "Above Average",
    # the SQL variant (unrounded) says "Average".
    assert _apply(spark, [4.996], lambda x: labels.performance_tier3(rnd(x))) == ["Above Average"]
    assert _apply(spark, [4.996], labels.performance_tier3) == ["Average"]


def test_growth_class(spark):
    df = spark.createDataFrame([(0, None, None), (1, 20.0, 1.0), (2, 5.0, 1.0), (3, -5.0, 1.0),
                                (4, -20.0, 1.0), (5, -20.01, 1.0)], "i int, g double, prev double")
    got = [r.c for r in df.select("i", labels.growth_class(F.col("g"), F.col("prev")).alias("c"))
           .orderBy("i").collect()]
    assert got == ["Baseline Quarter", "Strong Growth", "Moderate Growth", "Stable", "Declining",
                   "Significant Decline"]


def test_rfm_segments(spark):
    got = _apply(spark, [15, 13, 12, 10, 9, 7, 6, 5, 4, 3], labels.rfm_segment, "int")
    assert got == ["Champions"] * 2 + ["Loyal Customers"] * 2 + ["Potential Loyalists"] * 2 + \
        ["At Risk"] * 2 + ["Lost"] * 2


def test_discount_bands(spark):
    got = _apply(spark, [0, 1, 5, 6, 10, 11, 15], labels.discount_band, "int")
    assert got == ["No Discount", "1-5% Discount", "1-5% Discount", "6-10% Discount", "6-10% Discount",
                   "11%+ Discount", "11%+ Discount"]


def test_region_flag(spark):
    assert _apply(spark, [-10.01, -10, -0.01, 0], labels.region_flag) == ["red", "yellow", "yellow", "green"]


def test_round_half_away_after_snapping(spark):
    # binary 1.005 is 1.00499999...; the contract snaps to 8 decimals first
    assert _apply(spark, [1.005, 2.675, -1.005, 0.125], rnd) == [1.01, 2.68, -1.01, 0.13]


def test_zero_denominators_give_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    r = df.select(pct("a", "b").alias("p"), pct_scaled("a", "b").alias("s"),
                  growth_pct("a", "b").alias("g")).first()
    assert (r.p, r.s, r.g) == (None, None, None)


def test_lag_growth_fixture(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([(1, 100.0), (2, 120.0), (3, 0.0), (4, 50.0)], "m int, rev double")
    w = Window.orderBy("m")
    got = [r.g for r in df.select("m", growth_pct("rev", F.lag("rev").over(w)).alias("g"))
           .orderBy("m").collect()]
    assert got == [None, 20.0, -100.0, None]
