"""Business insights as small long-form tables.

The reference only logs these lines; here each is a DataFrame with
``insight, subject, value, label`` built from a report, so it can be saved,
tested and compared like any other result.  Arg-max picks use ``max_by`` (a
single aggregate pass) with explicit tie-breaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.numeric import long_out, money_out, pct, rnd
from .reports import product_stats

COLS = ["insight", "subject", "value", "label"]


def _row(insight: str, subject, value, label) -> list:
    return [F.lit(insight).alias("insight"), subject.cast("string").alias("subject"),
            value.cast("double").alias("value"), label.cast("string").alias("label")]


def best_month(monthly: DataFrame) -> DataFrame:
    """Best month by revenue (earliest wins a tie), final running total,
    growth of the latest December."""
    m = monthly
    name = F.concat_ws(" ", "month_name", F.col("year").cast("string"))
    best = m.agg(F.max_by(F.struct(name.alias("s"), F.col("total_revenue").alias("v")),
                          F.struct("total_revenue", -F.col("year"), -F.col("month"))).alias("r"))
    last = m.agg(F.max_by(F.struct(name.alias("s"), F.col("ytd_revenue").alias("v")),
                          F.struct("year", "month")).alias("r"))
    dec = (m.where(F.col("month_name") == "December")
           .agg(F.max_by(F.struct(name.alias("s"), F.col("mom_growth_pct").alias("v")), "year").alias("r")))
    none = F.lit(None)
    return (best.select(*_row("best_month", F.col("r.s"), F.col("r.v"), none))
            .unionByName(last.select(*_row("final_ytd", F.col("r.s"), F.col("r.v"), none)))
            .unionByName(dec.where(F.col("r").isNotNull())
                         .select(*_row("december_growth", F.col("r.s"), F.col("r.v"), none))))


def region_flags(regional: DataFrame) -> DataFrame:
    """Traffic-light flag and tier per region."""
    label = F.concat(labels.region_flag(F.col("vs_avg_pct")), F.lit(": "), F.col("performance_tier"))
    return regional.select(*_row("region_flag", F.col("region"), F.col("vs_avg_pct"), label))


def underperformers(regional_kpis: DataFrame, below: float = -5) -> DataFrame:
    """Regions more than 5% below the average (or under ``below`` %)."""
    return (regional_kpis.where(F.col("vs_avg_pct") < below)
            .select(*_row("underperforming_region", F.col("region"), F.col("vs_avg_pct"),
                          F.col("performance"))))


def category_ranks(categories: DataFrame) -> DataFrame:
    """I4: every category's rank and share, plus the top category."""
    per = categories.select(*_row("category_rank", F.col("category"), F.col("revenue_share_pct"),
                                  F.col("revenue_rank")))
    top = categories.agg(F.min_by(F.struct("category", "revenue_share_pct"),
                                  F.struct("revenue_rank", "category")).alias("t"))
    return per.unionByName(top.select(*_row("top_category", F.col("t.category"),
                                            F.col("t.revenue_share_pct"), F.lit(None))))


def quarter_growth(quarterly: DataFrame) -> DataFrame:
    """Growth per quarter; the first quarter is the baseline."""
    subject = F.concat_ws("-", F.col("year").cast("string"), "quarter")
    label = F.when(F.col("qoq_revenue_growth_pct").isNull(), F.lit("Baseline")).otherwise(
        F.col("growth_classification"))
    return quarterly.select(*_row("quarter_growth", subject, F.col("qoq_revenue_growth_pct"), label))


def rfm_mix(customers: DataFrame) -> DataFrame:
    """Customers and mean spend per RFM segment."""
    g = customers.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.sum(F.col("total_spend").cast("decimal(18,2)")).cast("double"),
                     F.count("total_spend").cast("double")).alias("avg_spend"))
    return g.select(*_row("rfm_segment", F.col("rfm_segment"), rnd("avg_spend"), F.col("n")))


def top_products(star, n: int = 10) -> DataFrame:
    """The ``n`` best-selling products (ties broken by id).  A top-k sort
    keeps at most ``n`` rows per task; ranks are exact because every product
    with more revenue than a kept one is kept as well."""
    ps = product_stats(star, with_list_price=False)
    top = ps.orderBy(F.desc("rev"), "product_id").limit(n)
    top = top.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("rev"))))
    return top.select(
        "product_id", "product_name", "category", money_out("rev").alias("total_revenue"),
        pct("prof", "rev").alias("profit_margin_pct"), long_out("revenue_rank").alias("revenue_rank"),
    ).orderBy("revenue_rank", "product_id")
