"""A warehouse load writes the raw rows of rejects once, and shuffles the lines once, to their buckets."""

from __future__ import annotations

import tempfile

import pytest
from tillroll.plans import warehouse
from tillroll.plans.warehouse import Warehouse


def _lines(spark, rows):
    return spark.createDataFrame(rows, "order_id string, line_number int, customer_id string, product_id string, date_id string, "
                                       "region string, quantity bigint, net_revenue double")


@pytest.fixture
def wh(spark):
    w = Warehouse(spark, tempfile.mkdtemp(prefix="wh-"))
    w.create_tables()
    w.load_dimension("dim_customer", spark.createDataFrame([("c1",), ("c2",)], "customer_id string"))
    w.load_dimension("dim_product", spark.createDataFrame([("p1",)], "product_id string"))
    return w


ROWS = [("o1", 1, "c1", "p1", "2025-01-05", "N", 1, 10.0), ("o1", 1, "c2", "p1", "2025-01-06", "S", 2, 20.0),
        ("o2", 1, "c9", "p1", "2025-01-05", "N", 1, 30.0), ("o2", 2, "c1", "p9", "2025-01-07", "N", 1, 40.0),
        ("o3", 1, "c9", "p9", "2025-01-05", "N", 1, 50.0), ("o4", 1, None, "p1", "2025-01-05", "N", 1, 60.0),
        ("o5", 1, "c2", "p1", "5 Jan", "N", 1, 70.0), ("o6", 1, "c2", "p1", "2025-01-08", "W", 1, None)]
REASONS = {"o2/1": "unknown customer_id", "o2/2": "unknown product_id", "o3/1": "unknown customer_id", "o4/1": "missing or invalid customer_id",
           "o5/1": "missing or invalid date_id", "o6/1": "missing or invalid net_revenue"}


@pytest.mark.parametrize("few", [True, False])
def test_rejects_and_lines_whatever_the_number_of_unknown_keys(spark, wh, monkeypatch, few):
    if not few:
        monkeypatch.setattr(warehouse, "BROADCAST_ROWS", 0, raising=False)
    assert wh.load_fact(_lines(spark, ROWS).coalesce(1), batch_id="b") == 1
    assert [(r.order_id, r.customer_id) for r in wh.table("fact_sales").collect()] == [("o1", "c1")]
    found = {f"{r.o}/{r.n}": r.reason for r in wh.table("fact_rejects").selectExpr(
        "reason", "get_json_object(row, '$.order_id') o", "get_json_object(row, '$.line_number') n").collect()}
    assert found == REASONS
    texts = [r.row for r in wh.table("fact_rejects").where("reason = 'missing or invalid date_id'").collect()]
    assert texts == ['{"order_id":"o5","line_number":1,"customer_id":"c2","product_id":"p1","date_id":"5 Jan","region":"N","quantity":1,"net_revenue":70.0}']
    assert wh.load_fact(_lines(spark, ROWS), batch_id="b") == 0 and wh.table("fact_rejects").count() == len(REASONS)
    assert sorted(r.date_id for r in wh.table("dim_date").collect()) == ["2025-01-05", "2025-01-06"]


def test_what_a_load_writes(spark, wh, monkeypatch):
    """The batch once, without raw rows when its rejects are there; keys and order of the lines to add; no table of the checked lines."""
    written, plain = [], warehouse._materialize
    monkeypatch.setattr(warehouse, "_materialize", lambda df, label="table": written.append((label, df.columns)) or plain(df, label))
    for _ in range(2):
        wh.load_fact(_lines(spark, ROWS).coalesce(1), batch_id="b")
    batches = [c for label, c in written if label == "fact_batch"]
    assert ["_raw" in c for c in batches] == [True, False]
    assert [c for label, c in written if label == "fact_winners"] == 2 * [["order_id", "line_number", "_arrival"]]
    assert "fact_keys" not in [label for label, _ in written]
