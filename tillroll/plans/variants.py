"""The slimmer report variants (V1-V8) and the load-stage region summary.

They share aggregates with the main reports but keep their own output
columns and definitions (3-tier performance, order share by row count,
row-count return rate, segment lifetime value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.numeric import (dbl, growth_pct, long_out, mean, money_out, pct, pct_scaled, rnd,
                                 whole, whole_mean, with_totals)
from ..operators.distinct import orders_and_customers
from ..operators.ordering import materialize, ranked_by
from .reports import ROWS_TO_HERE, _calendar, customer_transactions, known_products, product_stats
from .star import Star


def monthly_slim(star: Star) -> DataFrame:
    """V1: monthly revenue with running total and growth (no returns)."""
    f = _calendar(star, ["order_id", "customer_id", "net_revenue", "profit"])
    m = orders_and_customers(f, ["year", "month", "month_name", "quarter"], {"rev": "net_revenue", "prof": "profit"},
                           {"avg_net": "net_revenue"})
    w = Window.orderBy("year", "month")
    m = (m.withColumn("prev", F.lag("rev").over(w))
         .withColumn("ytd", F.sum("rev").over(w.rowsBetween(*ROWS_TO_HERE))))
    return m.select(
        long_out("year").alias("year"), long_out("month").alias("month"), "month_name", "quarter",
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("orders").alias("total_orders"), long_out("custs").alias("unique_customers"),
        rnd("avg_net").alias("avg_order_value"), money_out("ytd").alias("ytd_revenue"),
        growth_pct("rev", "prev").alias("mom_growth_pct"),
        pct("prof", "rev").alias("profit_margin_pct"),
    ).orderBy("year", "month")


def regional_3tier(star: Star) -> DataFrame:
    """V2: regions against the average with three tiers on the unrounded %."""
    r = orders_and_customers(star.fact, ["region"], {"rev": "net_revenue", "prof": "profit", "returns": "is_returned"},
                           {"avg_net": "net_revenue"})
    x = r.withColumn("avg_rev", whole_mean("rev"))     # the one-row average (J6)
    vs_avg = F.try_divide(dbl("rev") - F.col("avg_rev"), F.col("avg_rev")) * F.lit(100.0)
    return x.select(
        "region", money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("orders").alias("total_orders"), long_out("custs").alias("unique_customers"),
        rnd("avg_net").alias("avg_order_value"), long_out("returns").alias("total_returns"),
        pct("prof", "rev").alias("profit_margin_pct"), rnd(vs_avg).alias("vs_avg_pct"),
        labels.performance_tier3(vs_avg).alias("performance_tier"),
    ).orderBy(F.desc("total_revenue"))


def products_slim(star: Star, buckets: int | None = None) -> DataFrame:
    """V3: product ranking without list price, shares or running totals."""
    ps, n = materialize(product_stats(star, with_list_price=False), "product_stats")
    ps = ranked_by(ps, ["product_id"], [
        dict(order=[("rev", False)], outputs={"revenue_rank": "rank"}),
        dict(order=[("prof", False)], outputs={"profit_rank": "rank"}),
        dict(order=[("rev", False)], partition=["category"], outputs={"category_rank": "rank"})], buckets, n)
    return ps.select(
        "product_id", "product_name", "category",
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("units").alias("total_units"), long_out("orders").alias("total_orders"),
        rnd("avg_price").alias("avg_unit_price"),
        pct("prof", "rev").alias("profit_margin_pct"),
        pct_scaled("returns", "orders").alias("return_rate_pct"),
        long_out("revenue_rank").alias("revenue_rank"), long_out("profit_rank").alias("profit_rank"),
        long_out("category_rank").alias("category_rank"),
    ).orderBy("revenue_rank", "product_id")


def categories_slim(star: Star) -> DataFrame:
    """V4: category totals with revenue share and rank."""
    c = orders_and_customers(known_products(star, ["net_revenue", "profit", "quantity"]), ["category"],
                           {"rev": "net_revenue", "prof": "profit", "units": "quantity"})
    x = c.withColumn("grand_rev", whole(F.sum, "rev")).withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("rev"))))
    return x.select(
        "category", money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("orders").alias("total_orders"), long_out("units").alias("total_units"),
        long_out("custs").alias("unique_customers"),
        pct("rev", "grand_rev").alias("revenue_share_pct"),
        pct("prof", "rev").alias("profit_margin_pct"),
        long_out("revenue_rank").alias("revenue_rank"),
    ).orderBy("revenue_rank", "category")


def ltv_by_segment(star: Star) -> DataFrame:
    """V5: customer lifetime value rolled up to segments (A11), with the
    segment's share of all net revenue (scalar subquery, J7)."""
    cs = customer_transactions(star, with_returns=False)
    # customer-level averages are rounded to cents before being averaged
    cs = cs.withColumn("aov", F.round(F.col("avg_net").cast("decimal(28,8)"), 2))
    seg = cs.groupBy("segment").agg(
        F.count("customer_id").alias("customers"), mean("spend").alias("avg_spend"),
        F.sum("spend").alias("seg_rev"), mean("orders").alias("avg_orders"),
        mean("aov").alias("avg_aov"))
    x = with_totals(seg, star.fact, all_rev=F.sum("net_revenue"))
    return x.select(
        "segment", long_out("customers").alias("customer_count"), rnd("avg_spend").alias("avg_ltv"),
        money_out("seg_rev").alias("segment_revenue"), rnd("avg_orders").alias("avg_orders_per_customer"),
        rnd("avg_aov").alias("avg_order_value"),
        pct_scaled("seg_rev", "all_rev").alias("revenue_share_pct"),
    ).orderBy(F.desc("avg_ltv"), "segment")


def quarterly_slim(star: Star) -> DataFrame:
    """V6: quarter totals with the previous quarter and growth."""
    f = _calendar(star, ["order_id", "net_revenue", "profit"])
    q = f.groupBy("year", "quarter").agg(
        F.sum("net_revenue").alias("rev"), F.sum("profit").alias("prof"),
        F.countDistinct("order_id").alias("orders"))
    q = q.withColumn("prev", F.lag("rev").over(Window.orderBy("year", "quarter")))
    return q.select(
        "quarter", long_out("year").alias("year"),
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("orders").alias("total_orders"), pct("prof", "rev").alias("profit_margin_pct"),
        money_out("prev").alias("prev_quarter_revenue"), growth_pct("rev", "prev").alias("qoq_growth_pct"),
    ).orderBy("year", "quarter")


def payment_share(star: Star) -> DataFrame:
    """V7: payment methods; return rate and order share count sales lines."""
    p = star.fact.groupBy("payment_method").agg(
        F.countDistinct("order_id").alias("orders"), F.sum("net_revenue").alias("rev"),
        mean("net_revenue").alias("avg_net"), F.sum("is_returned").alias("returns"),
        F.count("order_id").alias("lines"))
    x = p.withColumn("all_lines", whole(F.sum, "lines"))   # every line has one payment method
    return x.select(
        "payment_method", long_out("orders").alias("total_orders"), money_out("rev").alias("total_revenue"),
        rnd("avg_net").alias("avg_order_value"), long_out("returns").alias("total_returns"),
        pct_scaled("returns", "lines").alias("return_rate_pct"),
        pct_scaled("lines", "all_lines").alias("order_share_pct"),
    ).orderBy(F.desc("total_revenue"))


def region_summary(star: Star) -> DataFrame:
    """V8: the load stage's validation summary per region."""
    r = star.fact.groupBy("region").agg(
        F.countDistinct("customer_id").alias("custs"), F.count("order_id").alias("lines"),
        F.sum("net_revenue").alias("rev"), mean("net_revenue").alias("avg_net"),
        F.sum("profit").alias("prof"), F.sum("is_returned").alias("returns"))
    return r.select(
        "region", long_out("custs").alias("unique_customers"), long_out("lines").alias("total_orders"),
        money_out("rev").alias("total_revenue"), rnd("avg_net").alias("avg_order_value"),
        pct("prof", "rev", 1).alias("profit_margin_pct"), long_out("returns").alias("total_returns"),
    ).orderBy(F.desc("total_revenue"))
