"""The eight analytic reports (R1-R8), as DataFrame plans over a :class:`Star`.

Conventions shared by every report:

* totals are exact decimal sums, output as double; counts/ranks as bigint;
* averages are exact sum / count in double, rounded by the numeric contract;
* windows over calendar periods, categories, payment methods or discount
  bands run as plain windows -- their row count is bounded by the calendar or
  by the dimension's domain, not by the data;
* rankings, tiles and running totals over customers or products go through
  :func:`~tillroll.operators.ordering.ranked_by`, which never gathers all rows
  (or a handful of huge regions) into one task;
* reports that count distinct orders and distinct customers have a roll-up for
  each (:mod:`~tillroll.operators.distinct`), so the fact rows are not expanded
  and an order may name several customers;
* ties in ROWS frames and NTILE are broken by the entity key so results are
  deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.numeric import (dbl, growth_pct, long_out, mean, money_out, pct, pct_scaled, ratio,
                                 rnd, whole, whole_mean, with_totals)
from ..operators.distinct import orders_and_customers
from ..operators.ordering import materialize, ranked_by
from .star import Star

ROWS_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def _calendar(star: Star, cols) -> DataFrame:
    """Fact joined to the date dimension (J1).  The dimension has one row per
    calendar day with sales; the loads refuse any date_id that is no ISO day.
    Spark broadcasts it by its measured size."""
    dd = star.dim_date.select("date_id", "year", "month", "month_name", "quarter")
    return star.fact.select("date_id", *cols).join(dd, "date_id")


# ---------------------------------------------------------------- R1 monthly
def monthly_growth(star: Star, reset_per_year: bool = False) -> DataFrame:
    f = _calendar(star, ["order_id", "customer_id", "net_revenue", "profit", "is_returned"])
    m = orders_and_customers(f, ["year", "month", "month_name", "quarter"],
                           {"rev": "net_revenue", "prof": "profit", "returns": "is_returned"}, {"avg_net": "net_revenue"})
    w = (Window.partitionBy("year").orderBy("month") if reset_per_year
         else Window.orderBy("year", "month"))
    m = (m.withColumn("prev", F.lag("rev").over(w))
         .withColumn("ytd", F.sum("rev").over(w.rowsBetween(*ROWS_TO_HERE))))
    return m.select(
        long_out("year").alias("year"), long_out("month").alias("month"), "month_name", "quarter",
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("orders").alias("total_orders"), long_out("custs").alias("unique_customers"),
        rnd("avg_net").alias("avg_order_value"), long_out("returns").alias("total_returns"),
        money_out("ytd").alias("ytd_revenue"), money_out("prev").alias("prev_month_revenue"),
        growth_pct("rev", "prev").alias("mom_growth_pct"),
        pct("prof", "rev").alias("profit_margin_pct"),
        pct_scaled("returns", "orders").alias("return_rate_pct"),
    ).orderBy("year", "month")


# ----------------------------------------------------------- R2 region vs avg
def region_vs_average(star: Star) -> DataFrame:
    r = orders_and_customers(star.fact, ["region"], {
        "rev": "net_revenue", "prof": "profit", "gross": "gross_revenue", "disc": "discount_amt",
        "units": "quantity", "returns": "is_returned"}, {"avg_net": "net_revenue"})
    # the company row (J5): average and total over the handful of region rows
    x = r.withColumns({"avg_rev": whole_mean("rev"), "company_total": whole(F.sum, "rev")})
    vs_avg = F.try_divide(dbl("rev") - F.col("avg_rev"), F.col("avg_rev")) * F.lit(100.0)
    return x.select(
        "region",
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        money_out("gross").alias("gross_revenue"), money_out("disc").alias("total_discounts"),
        long_out("orders").alias("total_orders"), long_out("custs").alias("unique_customers"),
        rnd("avg_net").alias("avg_order_value"), long_out("units").alias("total_units"),
        long_out("returns").alias("total_returns"),
        pct("prof", "rev").alias("profit_margin_pct"),
        pct_scaled("returns", "orders").alias("return_rate_pct"),
        pct("rev", "company_total").alias("revenue_share_pct"),
        rnd("avg_rev").alias("company_avg_revenue"),
        rnd(dbl("rev") - F.col("avg_rev")).alias("variance_from_avg"),
        rnd(vs_avg).alias("vs_avg_pct"),
        labels.performance_tier5(vs_avg).alias("performance_tier"),
        labels.recommendation(vs_avg).alias("recommendation"),
    ).orderBy(F.desc("total_revenue"))


# ---------------------------------------------------------- R3 product ranks
def product_stats(star: Star, with_list_price: bool = True) -> DataFrame:
    """Per-product aggregates joined to the product dimension.

    Aggregating by ``product_id`` before the join is exact because the join
    is on the dimension's key (each line matches at most one product); the
    join then moves one row per product instead of one per sales line."""
    agg = orders_and_customers(star.fact, ["product_id"], {
        "rev": "net_revenue", "prof": "profit", "gross": "gross_revenue", "disc": "discount_amt",
        "units": "quantity", "returns": "is_returned"},
        {"avg_price": "unit_price", "avg_disc": "discount_pct"}, customers="buyers")
    dim = star.dim_product.select("product_id", "product_name", "category",
                                  F.col("unit_price").alias("list_price"))
    out = agg.join(dim, "product_id")
    return out if with_list_price else out.drop("list_price")


def product_ranking(star: Star, buckets: int | None = None) -> DataFrame:
    # one row per product, written once: the rollup, the total and the four rankings read it
    ps, n = materialize(product_stats(star), "product_stats")
    cat = ps.groupBy("category").agg(F.sum("rev").alias("cat_rev"))
    ranks = ranked_by(ps, ["product_id"], [
        dict(order=[("rev", False)], outputs={"revenue_rank": "rank"}),
        dict(order=[("prof", False)], outputs={"profit_rank": "rank"}),
        dict(order=[("units", False)], outputs={"volume_rank": "rank"}),
        dict(order=[("rev", False)], partition=["category"], sums=["rev"],
             outputs={"category_rank": "rank", "cat_cum": "cum_rev"})], buckets, n)
    ps = with_totals(ranks.join(cat, "category"), ps, grand_total=F.sum("rev"))   # J4: Spark picks the join by size
    return ps.select(
        "product_id", "product_name", "category",
        money_out("list_price").alias("list_price"), rnd("avg_price").alias("avg_selling_price"),
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        money_out("gross").alias("gross_revenue"), money_out("disc").alias("total_discounts"),
        long_out("units").alias("total_units_sold"), long_out("orders").alias("total_orders"),
        long_out("buyers").alias("unique_buyers"), rnd("avg_disc").alias("avg_discount_pct"),
        long_out("returns").alias("return_count"),
        pct("prof", "rev").alias("profit_margin_pct"),
        pct_scaled("returns", "orders").alias("return_rate_pct"),
        pct("rev", "grand_total").alias("company_revenue_share_pct"),
        pct("rev", "cat_rev").alias("category_revenue_share_pct"),
        long_out("revenue_rank").alias("revenue_rank"), long_out("profit_rank").alias("profit_rank"),
        long_out("volume_rank").alias("volume_rank"), long_out("category_rank").alias("category_rank"),
        money_out("cat_cum").alias("category_cumulative_revenue"),
    ).orderBy("revenue_rank", "product_id")


# --------------------------------------------------------- R4 category share
def known_products(star: Star, cols) -> DataFrame:
    """Sales lines joined to the product dimension (J2), whose category they
    take; lines of products it does not hold drop out."""
    return (star.fact.select("product_id", "order_id", "customer_id", *cols)
            .join(star.dim_product.select("product_id", "category"), "product_id"))


def category_metrics(star: Star) -> DataFrame:
    f = known_products(star, ["net_revenue", "profit", "gross_revenue", "discount_amt", "quantity", "is_returned", "unit_price"])
    return orders_and_customers(f, ["category"], {
        "rev": "net_revenue", "prof": "profit", "gross": "gross_revenue", "disc": "discount_amt",
        "units": "quantity", "returns": "is_returned"}, {"avg_net": "net_revenue", "avg_price": "unit_price"})


def category_share(star: Star) -> DataFrame:
    cm = category_metrics(star)
    x = cm.withColumns({"c_rev": whole(F.sum, "rev"), "c_prof": whole(F.sum, "prof"),
                        "c_orders": whole(F.sum, "orders"), "margin": ratio("prof", "rev")})
    # categories: a handful of rows, bounded by the product-type domain
    w_rev = Window.orderBy(F.desc("rev"))
    x = (x.withColumn("revenue_rank", F.rank().over(w_rev))
         .withColumn("profit_rank", F.rank().over(Window.orderBy(F.desc("prof"))))
         .withColumn("margin_rank", F.rank().over(Window.orderBy(F.desc("margin"))))
         .withColumn("cum_rev", F.sum("rev").over(
             Window.orderBy(F.desc("rev"), "category").rowsBetween(*ROWS_TO_HERE))))
    return x.select(
        "category",
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        money_out("gross").alias("gross_revenue"), money_out("disc").alias("total_discounts"),
        long_out("orders").alias("total_orders"), long_out("custs").alias("unique_customers"),
        long_out("units").alias("total_units"), rnd("avg_net").alias("avg_order_value"),
        rnd("avg_price").alias("avg_unit_price"), long_out("returns").alias("total_returns"),
        pct("rev", "c_rev").alias("revenue_share_pct"),
        pct("prof", "c_prof").alias("profit_share_pct"),
        pct("orders", "c_orders").alias("order_share_pct"),
        pct("prof", "rev").alias("profit_margin_pct"),
        pct("disc", "gross").alias("discount_rate_pct"),
        pct_scaled("returns", "orders").alias("return_rate_pct"),
        long_out("revenue_rank").alias("revenue_rank"), long_out("profit_rank").alias("profit_rank"),
        long_out("margin_rank").alias("margin_rank"),
        pct("cum_rev", "c_rev").alias("cumulative_revenue_share_pct"),
    ).orderBy("revenue_rank", "category")


# ------------------------------------------------------- R5 customer LTV+RFM
def customer_transactions(star: Star, with_returns: bool = True) -> DataFrame:
    """Per-customer aggregates joined to the customer dimension (J3); the
    aggregate runs first, which is exact because the join is on the key."""
    aggs = [F.sum("net_revenue").alias("spend"), F.sum("profit").alias("prof"),
            F.countDistinct("order_id").alias("orders"), F.sum("quantity").alias("units"),
            mean("net_revenue").alias("avg_net"),
            # dates aggregate as ``date`` (hash aggregation); ISO text at the edge
            F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")]
    if with_returns:
        aggs.append(F.sum("is_returned").alias("returns"))
    agg = (star.fact.groupBy("customer_id").agg(*aggs)
           .withColumn("first_date", F.date_format("first_day", "yyyy-MM-dd"))
           .withColumn("last_date", F.date_format("last_day", "yyyy-MM-dd"))
           .drop("first_day", "last_day"))
    return agg.join(star.dim_customer.select("customer_id", "segment", "region"), "customer_id")


def customer_ltv_rfm(star: Star, recency_mode: str = "as_published", buckets: int | None = None) -> DataFrame:
    """``as_published``: recency tiles over the newest date first, so the most
    recent customers score 1 (the report's SQL); ``corrected``: most recent
    score 5, as the report's comment intends."""
    if recency_mode not in ("as_published", "corrected"):
        raise ValueError(recency_mode)
    ct, n = materialize(customer_transactions(star), "customer_tx")
    # one ascending order on spend gives the monetary tile and, counted from
    # its end, the descending ranks of all customers and of each segment and region
    ct = ranked_by(ct, ["customer_id"], [
        dict(order=[("last_date", recency_mode == "corrected")], outputs={"recency_score": "ntile5"}),
        dict(order=[("orders", True)], outputs={"frequency_score": "ntile5"}),
        dict(order=[("spend", True)], outputs={"monetary_score": "ntile5", "spend_rank": "rank_desc"}),
        dict(order=[("spend", True)], partition=["segment"], outputs={"segment_spend_rank": "rank_desc"}),
        dict(order=[("spend", True)], partition=["region"], outputs={"region_spend_rank": "rank_desc"})], buckets, n)
    score = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return ct.select(
        "customer_id", "segment", "region",
        money_out("spend").alias("total_spend"), money_out("prof").alias("total_profit_generated"),
        long_out("orders").alias("total_orders"), long_out("units").alias("total_units"),
        rnd("avg_net").alias("avg_order_value"),
        F.col("first_date").alias("first_order_date"), F.col("last_date").alias("last_order_date"),
        long_out("returns").alias("total_returns"),
        long_out("recency_score").alias("recency_score"),
        long_out("frequency_score").alias("frequency_score"),
        long_out("monetary_score").alias("monetary_score"),
        long_out(score).alias("rfm_total_score"),
        labels.rfm_segment(score).alias("rfm_segment"),
        long_out("spend_rank").alias("spend_rank"),
        long_out("segment_spend_rank").alias("segment_spend_rank"),
        long_out("region_spend_rank").alias("region_spend_rank"),
    ).orderBy(F.desc("total_spend"), "customer_id")


# ---------------------------------------------------------- R6 quarterly
def quarterly_growth(star: Star) -> DataFrame:
    f = _calendar(star, ["order_id", "customer_id", "net_revenue", "profit", "gross_revenue",
                         "discount_amt", "quantity", "is_returned"])
    q = orders_and_customers(f, ["year", "quarter"], {
        "rev": "net_revenue", "prof": "profit", "gross": "gross_revenue", "disc": "discount_amt",
        "units": "quantity", "returns": "is_returned"}, {"avg_net": "net_revenue"})
    w = Window.orderBy("year", "quarter")  # quarters: bounded by the calendar
    q = (q.withColumn("prev", F.lag("rev").over(w))
         .withColumn("prev_orders", F.lag("orders").over(w))
         .withColumn("cum", F.sum("rev").over(w.rowsBetween(*ROWS_TO_HERE))))
    growth = F.try_divide(dbl(F.col("rev") - F.col("prev")), dbl("prev")) * F.lit(100.0)
    return q.select(
        long_out("year").alias("year"), "quarter",
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        money_out("gross").alias("gross_revenue"), money_out("disc").alias("total_discounts"),
        long_out("orders").alias("total_orders"), long_out("custs").alias("unique_customers"),
        long_out("units").alias("total_units"), long_out("returns").alias("total_returns"),
        rnd("avg_net").alias("avg_order_value"),
        money_out("cum").alias("cumulative_revenue"), money_out("prev").alias("prev_quarter_revenue"),
        rnd(growth).alias("qoq_revenue_growth_pct"),
        pct_scaled(F.col("orders") - F.col("prev_orders"), "prev_orders").alias("qoq_orders_growth_pct"),
        pct("prof", "rev").alias("profit_margin_pct"),
        pct("disc", "gross").alias("discount_rate_pct"),
        labels.growth_class(growth, F.col("prev")).alias("growth_classification"),
    ).orderBy("year", "quarter")


# -------------------------------------------------- R7 payment and discount
def payment_discount(star: Star) -> DataFrame:
    f = star.fact
    ps = orders_and_customers(f.withColumnRenamed("payment_method", "dimension"), ["dimension"],
                            {"rev": "net_revenue", "prof": "profit", "returns": "is_returned"},
                            {"avg_net": "net_revenue", "avg_disc": "discount_pct"})
    db = f.groupBy(labels.discount_band(F.col("discount_pct")).alias("dimension")).agg(   # A9
        F.sum("net_revenue").alias("rev"), F.sum("profit").alias("prof"),
        F.countDistinct("order_id").alias("orders"), mean("net_revenue").alias("avg_net"),
        F.sum("is_returned").alias("returns"))
    def shape(df: DataFrame, kind: str, custs, avg_disc) -> DataFrame:
        # a few payment methods / four bands: plain window
        # every sales line falls in exactly one payment method and one band,
        # so each half's own total equals the payment-method grand total
        df = df.withColumn("grand_total", whole(F.sum, "rev")).withColumn(
            "revenue_rank", F.rank().over(Window.orderBy(F.desc("rev"))))
        return df.select(
            F.lit(kind).alias("analysis_type"), "dimension",
            money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
            long_out("orders").alias("total_orders"), custs.alias("unique_customers"),
            rnd("avg_net").alias("avg_order_value"), avg_disc.alias("avg_discount_pct"),
            long_out("returns").alias("total_returns"),
            pct("prof", "rev").alias("profit_margin_pct"),
            pct_scaled("returns", "orders").alias("return_rate_pct"),
            pct("rev", "grand_total").alias("revenue_share_pct"),
            long_out("revenue_rank").alias("revenue_rank"))

    pay = shape(ps, "PAYMENT_METHOD", long_out("custs"), rnd("avg_disc"))
    band = shape(db, "DISCOUNT_BAND", F.lit(None).cast("bigint"), F.lit(None).cast("double"))
    return pay.unionByName(band).orderBy("analysis_type", "revenue_rank", "dimension")


# ------------------------------------------------- R8 top customers / region
def top_customers(star: Star, k: int = 5) -> DataFrame:
    """Top ``k`` customers per region by revenue (ties may return more).

    Scalable form: the region rank is computed alone and filtered, which
    Spark plans as a partial top-k before the shuffle (``WindowGroupLimit``),
    so only about ``k`` rows per region and task cross the network.  The
    remaining columns need only those rows plus small aggregates:

    * running total and tie counts: every row ahead of a kept row (and every
      row tied with it) has rank <= k, so it was kept too;
    * region size and total: one ``groupBy('region')``;
    * ascending percent rank = (n - rank + 1 - ties) / (n - 1);
    * dense rank on order count: from the distinct (region, total_orders)
      pairs -- at most sqrt(2 * orders) values per region.
    """
    agg = star.fact.groupBy("customer_id", "region").agg(
        F.sum("net_revenue").alias("rev"), F.sum("profit").alias("prof"),
        F.countDistinct("order_id").alias("orders"), mean("net_revenue").alias("avg_net"),
        F.sum("is_returned").alias("returns"), F.max("order_date").alias("last_day"))
    # one row per customer, written once and read by the three steps below
    # (instead of aggregating the fact three times)
    cr, _ = materialize(agg.join(star.dim_customer.select("customer_id", "segment"), "customer_id")
                        .withColumn("last_date", F.date_format("last_day", "yyyy-MM-dd")).drop("last_day"),
                        "customer_revenue")
    top = (cr.withColumn("region_rank", F.rank().over(Window.partitionBy("region").orderBy(F.desc("rev"))))
           .where(F.col("region_rank") <= k))
    sizes = cr.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("rev").alias("region_total"))
    dense = (cr.select("region", "orders").distinct()
             .withColumn("order_frequency_rank",
                         F.dense_rank().over(Window.partitionBy("region").orderBy(F.desc("orders")))))
    w_top = Window.partitionBy("region").orderBy(F.desc("rev"), "customer_id")
    t = (top.join(sizes, "region").join(dense, ["region", "orders"])
         .withColumn("ties", F.count(F.lit(1)).over(Window.partitionBy("region", "rev")))
         .withColumn("cum", F.sum("rev").over(w_top.rowsBetween(*ROWS_TO_HERE))))
    prank = F.when(F.col("n") <= 1, F.lit(0.0)).otherwise(
        dbl(F.col("n") - F.col("region_rank") + 1 - F.col("ties")) / dbl(F.col("n") - 1))
    return t.select(
        "region", long_out("region_rank").alias("region_rank"), "customer_id", "segment",
        money_out("rev").alias("total_revenue"), money_out("prof").alias("total_profit"),
        long_out("orders").alias("total_orders"), rnd("avg_net").alias("avg_order_value"),
        long_out("returns").alias("total_returns"), F.col("last_date").alias("last_purchase_date"),
        long_out("order_frequency_rank").alias("order_frequency_rank"),
        rnd(prank * F.lit(100.0), 1).alias("revenue_percentile_in_region"),
        money_out("cum").alias("region_cumulative_revenue"),
        pct("rev", "region_total").alias("region_revenue_share_pct"),
        pct("prof", "rev").alias("profit_margin_pct"),
    ).orderBy("region", "region_rank", "customer_id")
