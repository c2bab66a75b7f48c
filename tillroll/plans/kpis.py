"""KPI datasets of the transformation stage (K1-K7).

These follow the dataframe-library definitions rather than the SQL
reports: average order value is revenue over distinct orders (monthly),
return rate divides by distinct orders, performance tiers test the
*rounded* percentage, product rank is the average rank truncated to an
integer, RFM scores are quintiles.  Rows with a NULL group key are dropped
before grouping, as a dataframe ``groupby`` does.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.numeric import (dbl, growth_pct, long_out, mean, money_out, pct, ratio, rnd, whole, whole_mean,
                                 with_totals)
from ..operators.clean import clean_transactions
from ..operators.distinct import orders_and_customers
from ..operators.ordering import materialize, ranked
from ..operators.quantiles import apply_quintile, quintile_edges
from .reports import ROWS_TO_HERE
from .star import Star


def _keys_present(df: DataFrame, keys) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def monthly_kpis(sales: DataFrame) -> DataFrame:
    keys = ["year", "month", "month_name", "quarter"]
    m = orders_and_customers(_keys_present(sales, keys), keys, {
        "rev": "net_revenue", "prof": "profit", "units": "quantity", "returns": "is_returned"})
    w = Window.orderBy("year", "month")  # months: bounded by the calendar
    m = (m.withColumn("prev", F.lag("rev").over(w))
         .withColumn("ytd", F.sum("rev").over(w.rowsBetween(*ROWS_TO_HERE))))
    return m.select(
        long_out("year").alias("year"), long_out("month").alias("month"), "month_name", "quarter",
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("orders").alias("total_orders"), long_out("units").alias("total_units"),
        long_out("returns").alias("total_returns"), long_out("custs").alias("unique_customers"),
        rnd(ratio("rev", "orders")).alias("avg_order_value"),
        pct("prof", "rev").alias("profit_margin_pct"),
        pct("returns", "orders").alias("return_rate_pct"),
        money_out("prev").alias("prev_month_revenue"),
        growth_pct("rev", "prev").alias("mom_growth_pct"),
        money_out("ytd").alias("ytd_revenue"),
    ).orderBy("year", "month")


def regional_kpis(sales: DataFrame) -> DataFrame:
    r = orders_and_customers(_keys_present(sales, ["region"]), ["region"], {
        "rev": "net_revenue", "prof": "profit", "returns": "is_returned"}, {"avg_net": "net_revenue"})
    x = r.withColumn("avg_rev", whole_mean("rev"))
    vs_avg = rnd(F.try_divide(dbl("rev") - F.col("avg_rev"), F.col("avg_rev")) * F.lit(100.0))
    return x.select(
        "region", money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("orders").alias("total_orders"), long_out("custs").alias("unique_customers"),
        rnd("avg_net").alias("avg_order_value"), long_out("returns").alias("total_returns"),
        vs_avg.alias("vs_avg_pct"), pct("prof", "rev").alias("profit_margin"),
        labels.performance_tier3(vs_avg).alias("performance"),   # tier of the rounded %
    ).orderBy(F.desc("total_revenue"))


def product_kpis(sales: DataFrame, buckets: int | None = None) -> DataFrame:
    keys = ["product_id", "product_name", "category"]
    p = _keys_present(sales, keys).groupBy(*keys).agg(
        F.sum("net_revenue").alias("rev"), F.sum("profit").alias("prof"),
        F.sum("quantity").alias("units"), F.countDistinct("order_id").alias("orders"),
        F.sum("is_returned").alias("returns"), mean("unit_price").alias("avg_price"))
    p, n = materialize(p, "product_kpis")
    p = ranked(p, [("rev", False)], tie=["product_id"], outputs={"revenue_rank": "average_rank"},
               buckets=buckets, rows=n)
    return p.select(
        "product_id", "product_name", "category",
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("units").alias("total_units"), long_out("orders").alias("total_orders"),
        long_out("returns").alias("return_count"), rnd("avg_price").alias("avg_unit_price"),
        pct("prof", "rev").alias("profit_margin_pct"), pct("returns", "orders").alias("return_rate_pct"),
        long_out("revenue_rank").alias("revenue_rank"),
    ).orderBy(F.desc("total_revenue"), "product_id")


def category_kpis(sales: DataFrame) -> DataFrame:
    c = orders_and_customers(_keys_present(sales, ["category"]), ["category"], {
        "rev": "net_revenue", "prof": "profit", "units": "quantity"}, {"avg_net": "net_revenue"})
    return c.withColumn("all_rev", whole(F.sum, "rev")).select(
        "category", money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("orders").alias("total_orders"), long_out("units").alias("total_units"),
        long_out("custs").alias("unique_customers"), rnd("avg_net").alias("avg_order_value"),
        pct("prof", "rev").alias("profit_margin_pct"), pct("rev", "all_rev").alias("revenue_share_pct"),
    ).orderBy(F.desc("total_revenue"))


def rfm_quintiles(sales: DataFrame, mode: str = "collapse") -> DataFrame:
    """K5: recency in days before the latest sale date, distinct orders,
    revenue; each scored by quintile (recency reversed)."""
    s = _keys_present(sales, ["customer_id"])
    c = s.groupBy("customer_id").agg(
        F.max("order_date").alias("last"), F.countDistinct("order_id").alias("frequency"),
        F.sum("net_revenue").alias("monetary_dec"))
    c, _ = materialize(c, "rfm_customers")
    # the snapshot (latest sale) is the latest of the customers' last dates:
    # a scalar subquery over the small written table, not a second fact pass
    c = (with_totals(c, c, snapshot=F.max("last"))
         .select("customer_id", F.datediff("snapshot", "last").cast("long").alias("recency"),
                 long_out("frequency").alias("frequency"), money_out("monetary_dec").alias("monetary")))
    # the three selections are independent small jobs: submit them together
    with ThreadPoolExecutor(max_workers=3) as pool:
        r_e, f_e, m_e = pool.map(lambda col: quintile_edges(c, col, mode), ["recency", "frequency", "monetary"])
    c = apply_quintile(c, "recency", r_e, "r_score", reverse=True)
    c = apply_quintile(c, "frequency", f_e, "f_score")
    c = apply_quintile(c, "monetary", m_e, "m_score")
    score = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return c.select(
        "customer_id", "recency", "frequency", "monetary", "r_score", "f_score", "m_score",
        long_out(score).alias("rfm_score"), labels.rfm_segment(score).alias("rfm_segment"))


def customer_kpis(sales: DataFrame, rfm: DataFrame) -> DataFrame:
    keys = ["customer_id", "segment", "region"]
    c = _keys_present(sales, keys).groupBy(*keys).agg(
        F.sum("net_revenue").alias("rev"), F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("units"), mean("net_revenue").alias("avg_net"),
        F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    c = c.join(rfm.select("customer_id", "rfm_segment", "rfm_score"), "customer_id", "left")   # J8
    return c.select(
        "customer_id", "segment", "region", money_out("rev").alias("total_revenue"),
        long_out("orders").alias("total_orders"), long_out("units").alias("total_units"),
        rnd("avg_net").alias("avg_order_value"),
        F.date_format("first", "yyyy-MM-dd").alias("first_order"),
        F.date_format("last", "yyyy-MM-dd").alias("last_order"),
        "rfm_segment", "rfm_score",
    ).orderBy(F.desc("total_revenue"), "customer_id")


def run_transformation(star: Star) -> dict[str, DataFrame]:
    """K7: clean once, then the six KPI datasets (lazy plans)."""
    sales = clean_transactions(star.fact)
    rfm = rfm_quintiles(sales)
    return {
        "monthly_kpis": monthly_kpis(sales),
        "regional": regional_kpis(sales),
        "products": product_kpis(sales),
        "categories": category_kpis(sales),
        "rfm": rfm,
        "customers": customer_kpis(sales, rfm),
        "transactions": sales,
    }
