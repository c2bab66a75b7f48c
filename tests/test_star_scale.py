"""The star's build moves little: few bytes a line through the shuffles, no sort by year, tasks by rows."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from tillroll.plans.star import load_star
from tillroll.sources import adapter

from conftest import SF_SMALL


def _exchanged(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_lines_are_shuffled_without_what_can_be_derived(spark):
    plan = adapter.sales_lines(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Join", 1)[1]          # all that the last join takes
    for late in ("date_format", "quarter(", "discount_amt", "month_name"):
        assert late not in below, late


def test_fact_is_written_without_a_sort_by_year(spark):
    fact = load_star(spark, SF_SMALL, refresh=True).fact
    assert not any("year=" in f for f in fact.inputFiles())
    assert fact.where(F.col("year") != F.year("order_date")).count() == 0 and fact.schema["year"].dataType.simpleString() == "int"


def test_tasks_of_the_large_joins_follow_the_lines(spark, monkeypatch):
    before = adapter.sales_lines(spark, SF_SMALL)
    assert _exchanged(before) == [] or all(", 8" in e for e in _exchanged(before))
    monkeypatch.setattr(adapter, "TASK_LINES", 200)
    after = adapter.sales_lines(spark, SF_SMALL)
    tasks = -(-spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count() // 200)
    assert [e for e in _exchanged(after) if f", {tasks}" in e]
    assert after.exceptAll(before).count() == 0 and after.count() == before.count()
