from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tillroll.plans.star import FACT_COLUMNS, Star  # noqa: E402
from tillroll.session import drop_work, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8)
    yield s
    drop_work(s)   # this session's stars and intermediate tables
    s.stop()


FACT_DDL = (
    "order_id bigint, line_number int, customer_id bigint, product_id bigint, order_date date, "
    "date_id string, year int, month int, month_name string, quarter string, region string, "
    "segment string, category string, product_name string, payment_method string, quantity bigint, "
    "unit_price decimal(18,2), discount_pct int, discount_amt decimal(18,2), gross_revenue decimal(18,2), "
    "net_revenue decimal(18,2), cost decimal(18,2), profit decimal(18,2), is_returned int")


def fact_row(order_id=1, line_number=1, customer_id=1, product_id=1, day="2025-03-15", region="West",
             segment="Regular", category="Beauty", product_name="p", payment_method="Card",
             quantity=1, net="100.00", profit="10.00", gross=None, discount="0.00", discount_pct=0,
             cost=None, is_returned=0):
    d = dt.date.fromisoformat(day)
    net_d = Decimal(net) if net is not None else None
    gross_d = Decimal(gross) if gross is not None else (net_d + Decimal(discount) if net_d is not None else None)
    return (order_id, line_number, customer_id, product_id, d, day, d.year, d.month, d.strftime("%B"),
            f"Q{(d.month - 1) // 3 + 1}", region, segment, category, product_name, payment_method, quantity,
            gross_d, discount_pct, Decimal(discount), gross_d, net_d,
            Decimal(cost) if cost else Decimal("0.00"), Decimal(profit) if profit is not None else None,
            is_returned)


def make_star(spark, rows, customers=None, products=None) -> Star:
    """A small star from hand-made fact rows (dimensions derived if absent)."""
    fact = spark.createDataFrame(rows, FACT_DDL).select(*FACT_COLUMNS)
    if customers is None:
        customers = (fact.groupBy("customer_id").agg({"segment": "first", "region": "first"})
                     .toDF("customer_id", "segment", "region"))
    if products is None:
        products = (fact.groupBy("product_id").agg({"product_name": "first", "category": "first"})
                    .toDF("product_id", "product_name", "category")
                    .selectExpr("*", "cast(10 as decimal(18,2)) as unit_price"))
    dim_date = fact.select("date_id", "month", "month_name", "quarter", "year").distinct()
    return Star(fact=fact, dim_customer=customers, dim_product=products, dim_date=dim_date,
                dim_region=fact.selectExpr("region as region_name").distinct())
