"""Insert-or-ignore decides by keys and order alone, and leaves full rows that are read from files where they are."""

from __future__ import annotations

import random
import tempfile

import pytest
from pyspark.sql import functions as F
from tillroll.operators import dedupe
from tillroll.operators.dedupe import insert_or_ignore
from tillroll.plans import registry
from tillroll.plans.star import load_star

from conftest import SF_SMALL

DDL = "k string, n int, a int, b int, v string"


@pytest.fixture
def no_small_broadcasts(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def _below(plan: str, node: str) -> str:
    """The part of a plan's text under the first line with ``node``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if node in line)
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    end = next((i for i in range(at + 1, len(lines)) if depth[i] <= depth[at]), len(lines))
    return "\n".join(lines[at + 1:end])


@pytest.mark.parametrize("key", ["fact_insert_or_ignore", "fact_redelivery"])
def test_lines_of_the_fact_are_not_shuffled(spark, no_small_broadcasts, key):
    plan = registry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_f#" not in line]


@pytest.mark.parametrize("key", ["fact_insert_or_ignore", "fact_redelivery"])
def test_lines_joined_by_block_are_the_same(spark, no_small_broadcasts, monkeypatch, key):
    def rows():
        return sorted(map(tuple, registry.queries()[key](spark, SF_SMALL).collect()))

    marked = rows()
    monkeypatch.setattr(dedupe, "BROADCAST_BLOCKS", 0, raising=False)
    joined = registry.queries()[key](spark, SF_SMALL)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, joined.collect())) == marked and len(marked) == len({r[:2] for r in marked})


def test_target_meets_keys_and_order_only(spark):
    batch = spark.createDataFrame([("K1", 1, 1, 1, "x")], DDL)
    plan = insert_or_ignore(batch.where("a = 2"), batch, ["k", "n"], ["a"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1 and "v#" not in _below(plan, "Join LeftAnti").split("LogicalRDD")[0]


def test_rows_of_keys_and_order_alone_are_not_joined_again(spark):
    batch = spark.createDataFrame([(3, "K1"), (1, "K1"), (2, None), (None, "K4"), (5, "K2"), (4, None)], "_arrival int, k string")
    new = insert_or_ignore(spark.createDataFrame([("K2",)], "k string"), batch, ["k"], ["_arrival"])
    assert new.columns == ["_arrival", "k"] and "LeftSemi" not in new._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, new.collect()), key=str) == [(1, "K1"), (2, None), (None, "K4")]


def test_placed_rows_are_reduced_before_they_meet_the_target(spark, no_small_broadcasts, monkeypatch):
    """Only bits of places are written, and a hot key is one row a task in the anti join's shuffle."""
    seen, plain = [], dedupe.materialize
    monkeypatch.setattr(dedupe, "materialize", lambda df, label="table": seen.append(df) or plain(df, label))
    star = load_star(spark, SF_SMALL)
    registry.fact_redelivery(star)
    assert [df.columns for df in seen] == [["_block", "_bits"]]
    assert "Aggregate [order_id" in _below(seen[0]._jdf.queryExecution().optimizedPlan().toString(), "Join LeftAnti")


@pytest.mark.parametrize("blocks", [500_000, 0])
@pytest.mark.parametrize("order", [["a"], ["a", "b"]])
def test_placed_rows_match_python(spark, monkeypatch, blocks, order):
    """Several files in small row groups, hot and null keys, null orders, held keys."""
    monkeypatch.setattr(dedupe, "BROADCAST_BLOCKS", blocks)
    rnd, at = random.Random(7), list(range(6000))
    rnd.shuffle(at)
    rows = [(None if i % 50 == 0 else "HOT" if i % 3 == 0 else f"K{rnd.randrange(900)}", None if i % 41 == 0 else i % 4,
             None if i % 97 == 0 else a, i, f"v{i}") for i, a in enumerate(at)]
    folder = tempfile.mkdtemp(prefix="placed-")
    spark.createDataFrame(rows, DDL).repartition(5).write.option("parquet.block.size", 4096).mode("overwrite").parquet(folder)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        batch = spark.read.schema(DDL).parquet(folder)
        assert batch.rdd.getNumPartitions() > 5
        places = dedupe.number_places(batch).select("_place", "v")
        assert places.select("_place").distinct().count() == len(rows)
        assert places.exceptAll(places.repartition(3)).count() == 0
        held = {("K1", 1), ("HOT", 2), ("K2", None)}
        target = spark.createDataFrame(list(held), "k string, n int")
        got = insert_or_ignore(target, dedupe.number_places(batch.withColumn("w", F.length("v"))), ["k", "n"], order)
        assert got.columns == ["k", "n", "a", "b", "v", "w"]
        got = sorted(r.b for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    # one order column: nulls come last; a struct of several: first, as Spark sorts them
    late = len(order) == 1
    first = {}
    for k, n, a, b, v in sorted(rows, key=lambda r: ((r[2] is None) == late, r[2] or 0, r[3])):
        first.setdefault((k, n), b)
    exp = sorted(b for key, b in first.items() if None in key or key not in held)
    assert got == exp and len(got) > 900
