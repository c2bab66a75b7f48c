"""Distributed ordering equals Spark's own windows, ties and hot keys included."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators.ordering import bucket_of, cut_points, materialize, ranked, ranked_by

OUTPUTS = {"rk": "rank", "dr": "dense_rank", "rn": "row_number", "pr": "percent_rank",
           "ar": "average_rank", "n": "count", "nt": "ntile5", "cm": "cum_m"}


def _expected(df, part, asc):
    w = Window.partitionBy(*part) if part else Window.partitionBy()
    ordx = F.col("x").asc() if asc else F.col("x").desc()
    wo, wt = w.orderBy(ordx), w.orderBy(ordx, "id")
    rank = F.rank().over(wo)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*part, "x"))
    return df.select(
        "id", rank.alias("rk"), F.dense_rank().over(wo).alias("dr"), F.row_number().over(wt).alias("rn"),
        F.percent_rank().over(wo).alias("pr"), F.floor((2 * rank + ties - 1) / 2).alias("ar"),
        F.count(F.lit(1)).over(w).alias("n"), F.ntile(5).over(wt).alias("nt"),
        F.sum("m").over(wt.rowsBetween(Window.unboundedPreceding, 0)).alias("cm"))


def _compare(got, exp):
    g = {r.id: r for r in got.collect()}
    e = {r.id: r for r in exp.collect()}
    assert g.keys() == e.keys()
    for i, er in e.items():
        gr = g[i]
        assert (gr.rk, gr.dr, gr.rn, gr.ar, gr.n, gr.nt, gr.cm) == (er.rk, er.dr, er.rn, er.ar, er.n, er.nt, er.cm), i
        assert gr.pr == pytest.approx(er.pr, abs=0, rel=1e-15)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(2500):
        p = rnd.choice(["A", "B", "C"]) if rnd.random() < 0.8 else "D"
        x = 7 if rnd.random() < 0.34 else rnd.randint(0, 40)      # one key holds a third
        rows.append((i, p, x, float(rnd.randint(1, 9))))
    return spark.createDataFrame(rows, "id long, p string, x long, m double")


@pytest.mark.parametrize("part", [[], ["p"]])
@pytest.mark.parametrize("asc", [True, False])
@pytest.mark.parametrize("buckets", [1, 5, 13])
def test_distributed_matches_window(skewed, part, asc, buckets):
    got = ranked(skewed, [("x", asc)], tie=["id"], partition=part, sums=["m"], buckets=buckets,
                 outputs=OUTPUTS)
    _compare(got, _expected(skewed, part, asc))


def test_hot_key_is_split_across_buckets(skewed):
    """A key with a third of the rows lies in several buckets, none of which
    holds much more than its share, and is ranked as one group."""
    order = [("x", True), ("id", True)]
    cuts = cut_points([(r.x, r.id) for r in skewed.collect()], order, 8)
    rows = skewed.withColumn("_b", bucket_of(skewed, order, cuts))
    per_bucket = {r._b: (r["count"], r.hot) for r in rows.groupBy("_b").agg(
        F.count("*").alias("count"), F.sum((F.col("x") == 7).cast("int")).alias("hot")).collect()}
    assert sum(1 for _, hot in per_bucket.values() if hot) >= 3
    assert max(n for n, _ in per_bucket.values()) < 2 * 2500 / 8
    g = ranked(skewed, [("x", True)], tie=["id"], outputs={"rk": "rank"}, buckets=8)
    assert g.where("x = 7").select("rk").distinct().count() == 1


def test_buckets_follow_sparks_order(spark):
    """Nulls, NaN and both directions: buckets ascend with Spark's sort."""
    rows = [(i, v) for i, v in enumerate([None, 1.0, float("nan"), -0.5, None, float("inf"), 3.0, 1.0, float("nan"), 2.0] * 4)]
    df = spark.createDataFrame(rows, "id long, x double")
    for asc in (True, False):
        order = [("x", asc), ("id", True)]
        cuts = cut_points([(v, i) for i, v in rows], order, 7)
        placed = df.withColumn("b", bucket_of(df, order, cuts)).orderBy(F.col("x").asc() if asc else F.col("x").desc(), "id").collect()
        assert len(cuts) == 6 and [r.b for r in placed] == sorted(r.b for r in placed) and {r.b for r in placed} == set(range(7))


@pytest.mark.parametrize("asc", [True, False])
def test_orders_that_share_buckets_and_one_that_does_not(skewed, asc):
    """Several specs of one order, of another, and sums over a partition, at once."""
    got = ranked_by(skewed, ["id"], [
        dict(order=[("x", asc)], outputs={"rk": "rank", "ar": "average_rank", "dr": "dense_rank", "pr": "percent_rank"}),
        dict(order=[("x", asc)], partition=["p"], outputs={"prk": "rank", "from_end": "rank_desc"}),
        dict(order=[("m", True), ("x", False)], partition=["p"], sums=["m"], outputs={"rn": "row_number", "cm": "cum_m", "nt": "ntile5"})], 9)
    x = F.col("x").asc() if asc else F.col("x").desc()
    back = F.col("x").desc() if asc else F.col("x").asc()
    w, p, q = Window.orderBy(x), Window.partitionBy("p"), Window.partitionBy("p").orderBy("m", F.col("x").desc(), "id")
    ties = F.count(F.lit(1)).over(Window.partitionBy("x"))
    exp = skewed.withColumns({
        "rk": F.rank().over(w), "dr": F.dense_rank().over(w), "pr": F.percent_rank().over(w), "prk": F.rank().over(p.orderBy(x)),
        "from_end": F.rank().over(p.orderBy(back)), "rn": F.row_number().over(q), "nt": F.ntile(5).over(q),
        "cm": F.sum("m").over(q.rowsBetween(Window.unboundedPreceding, 0))}).withColumn("ar", F.floor((2 * F.col("rk") + ties - 1) / 2))
    names = ["id", "rk", "dr", "prk", "from_end", "rn", "nt", "cm", "ar", "pr"]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, exp.select(*names).collect()))


def test_counts_beyond_the_broadcast_bound_are_joined(skewed, monkeypatch):
    from tillroll.operators import ordering
    monkeypatch.setattr(ordering, "BROADCAST_ROWS", 0)
    got = ranked(skewed, [("x", False)], tie=["id"], partition=["p"], sums=["m"], buckets=5, outputs=OUTPUTS)
    _compare(got, _expected(skewed, ["p"], False))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 6)), min_size=1, max_size=60),
       st.integers(1, 6))
def test_property_random_ties(spark, data, buckets):
    rows = [(i, "P" + str(p), x, float(x)) for i, (p, x) in enumerate(data)]
    df = spark.createDataFrame(rows, "id long, p string, x long, m double")
    got = ranked(df, [("x", False)], tie=["id"], partition=["p"], sums=["m"], buckets=buckets, outputs=OUTPUTS)
    _compare(got, _expected(df, ["p"], False))


def test_ntile_seven_rows(spark):
    df = spark.createDataFrame([(i, i) for i in range(1, 8)], "id long, x long")
    got = ranked(df, [("x", True)], tie=["id"], outputs={"t": "ntile5"}, buckets=3)
    assert [r.t for r in got.orderBy("x").collect()] == [1, 1, 2, 2, 3, 4, 5]


def test_average_rank_fixture(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 5, 4, 3, 3, 3, 1])], "id long, x long")
    got = ranked(df, [("x", False)], tie=["id"], outputs={"a": "average_rank"}, buckets=2)
    assert [r.a for r in got.orderBy("id").collect()] == [1, 1, 3, 5, 5, 5, 7]


def test_percent_rank_single_row(spark):
    df = spark.createDataFrame([(1, "r", 3)], "id long, p string, x long")
    got = ranked(df, [("x", True)], tie=["id"], partition=["p"], outputs={"pr": "percent_rank"}, buckets=2)
    assert got.first().pr == 0.0


def test_materialize_counts_rows(spark, skewed):
    df, n = materialize(skewed.where("x > 3"), "t")
    assert n == skewed.where("x > 3").count() == df.count()


@pytest.mark.parametrize("part", [[], ["p"]])
def test_distributed_without_group_ends(skewed, part):
    # rank / dense rank / row number / running sum only: no reverse pass
    outs = {"rk": "rank", "dr": "dense_rank", "rn": "row_number", "cm": "cum_m"}
    got = {r.id: r for r in ranked(skewed, [("x", False)], tie=["id"], partition=part, sums=["m"],
                                   buckets=7, outputs=outs).collect()}
    assert "_n" not in ranked(skewed, [("x", False)], tie=["id"], sums=["m"], buckets=3, outputs=outs).columns
    exp = {r.id: r for r in _expected(skewed, part, False).collect()}
    assert all((got[i].rk, got[i].dr, got[i].rn, got[i].cm) == (e.rk, e.dr, e.rn, e.cm) for i, e in exp.items())


@pytest.mark.parametrize("asc", [True, False])
def test_nulls_in_keys_and_partitions(spark, asc):
    rnd = random.Random(11)
    rows = [(i, rnd.choice(["A", "B", None]), rnd.choice([None, None, 1, 2, 3, 7, 7, 7]), 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, p string, x long, m double")
    got = ranked(df, [("x", asc)], tie=["id"], partition=["p"], sums=["m"], buckets=6, outputs=OUTPUTS)
    _compare(got, _expected(df, ["p"], asc))


@pytest.mark.parametrize("rows", [None, 0])
def test_empty_input(spark, rows):
    from tillroll.operators.quantiles import quintile_score
    df = spark.createDataFrame([], "id long, p string, x long, m double")
    got = ranked(df, [("x", False)], tie=["id"], partition=["p"], sums=["m"], buckets=3, rows=rows,
                 outputs=OUTPUTS)
    assert got.count() == 0 and "nt" in got.columns
    assert quintile_score(df, "x", "s").count() == 0
