"""Physical-plan properties: no Python in any plan, pruned scans, bounded
broadcasts, partial top-k, distributed ordering keyed by bucket."""

from __future__ import annotations

import contextlib
import io

import pytest

from conftest import SF_SMALL
from tillroll.operators.ordering import ranked_by
from tillroll.plans import registry, reports
from tillroll.plans.star import load_star

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                "MapInPandas", "PythonMapInArrow")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_no_python_or_pairwise_joins_in_plans(spark, key):
    plan = _plan(registry.queries()[key](spark, SF_SMALL))
    assert not any(n in plan for n in PYTHON_NODES), key
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, key


def test_monthly_scan_is_pruned_and_dates_broadcast(spark):
    star = load_star(spark, SF_SMALL)
    plan = _plan(reports.monthly_growth(star))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema:") and "net_revenue" in line]
    assert schemas and all("product_name" not in s and "gross_revenue" not in s for s in schemas)
    assert "BroadcastHashJoin" in plan


def test_top_customers_limits_before_the_shuffle(spark):
    plan = _plan(reports.top_customers(load_star(spark, SF_SMALL)))
    assert "WindowGroupLimit" in plan


def test_orders_share_one_exchange_by_bucket(spark):
    df = spark.range(0, 500).selectExpr("id", "id % 7 as x", "id % 3 as p")
    plan = _plan(ranked_by(df, ["id"], [
        dict(order=[("x", True)], outputs={"rk": "rank", "nt": "ntile5"}),
        dict(order=[("x", True)], partition=["p"], outputs={"prk": "rank_desc", "n": "count"})], buckets=4, rows=500))
    tree = plan.split("\n\n\n")[0]
    # one exchange of the rows, by bucket; the counts of the buckets come by broadcast
    assert tree.count("Exchange") - tree.count("BroadcastExchange") == 1 and tree.count("BroadcastExchange") == 2
    assert "Exchange hashpartitioning" not in tree or "_b0" in plan
    assert "SinglePartition" not in plan and "SortAggregate" not in tree


def test_customer_report_writes_counts_and_no_ordered_table(spark, monkeypatch):
    """R5 writes the customers and a count for each bucket of its three orders, no rows in order."""
    from tillroll.operators import ordering
    written = []
    plain = ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda df, label="table": written.append(label) or plain(df, label))
    registry.queries()["rpt_customer_ltv_rfm"](spark, SF_SMALL)
    assert written == ["bucket_counts"] * 5


@pytest.mark.parametrize("key", ["rpt_monthly_growth", "rpt_region_vs_average", "rpt_product_ranking", "rpt_category_share",
                                 "rpt_quarterly_growth", "rpt_payment_discount", "var_monthly", "kpi_monthly"])
def test_distinct_counts_do_not_expand_the_rows(spark, key):
    assert "Expand" not in _plan(registry.queries()[key](spark, SF_SMALL))
