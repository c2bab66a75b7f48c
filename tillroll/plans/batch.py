"""One batch run end to end: KPIs, warehouse load, reports, exports.

The data steps of the reference's run, chained as plain function calls
(no scheduler): each step is a set of Spark jobs over the star, and every
write lands under ``root`` (a shared folder on a cluster).
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.clean import clean_transactions, new_clean_counts
from ..sources.files import REPORT_EXPORTS, export_for_bi, save_all
from . import insights, kpis, reports
from .star import load_star
from .warehouse import Warehouse


@dataclass
class BatchResult:
    kpi_paths: dict[str, str]
    fact_rows_added: int
    exports: dict[str, str]
    rows_dropped: int
    insights: dict[str, DataFrame] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)


def run_batch(spark: SparkSession, sf_dir: str, root: str, ts: str | None = None,
              save_transactions: bool = False) -> BatchResult:
    """``save_transactions`` also writes the cleaned sales lines with the KPI
    datasets; off by default because the star already holds them (at scale
    it would be a second full copy of the fact)."""
    ts = ts or time.strftime("%Y%m%d_%H%M%S")
    secs: dict[str, float] = {}
    t = time.time()
    star = load_star(spark, sf_dir)
    secs["star"] = time.time() - t

    t = time.time()
    dfs = kpis.run_transformation(star)
    to_save = {k: v for k, v in dfs.items() if save_transactions or k != "transactions"}
    kpi_paths = save_all(to_save, f"{root}/processed", ts)
    secs["transform"] = time.time() - t

    t = time.time()
    wh = Warehouse(spark, f"{root}/warehouse")
    counts = new_clean_counts()   # P6: filled in by the load's own pass
    added = wh.run_load(sales=clean_transactions(star.fact, counts), customers=star.dim_customer, products=star.dim_product,
                        monthly=dfs["monthly_kpis"], regional=dfs["regional"])
    secs["load"] = time.time() - t

    t = time.time()
    results = {
        "monthly_growth": reports.monthly_growth(star),
        "regional": reports.region_vs_average(star),
        "product_ranking": reports.product_ranking(star),
        "category": reports.category_share(star),
        "customer_ltv": reports.customer_ltv_rfm(star),
        "qoq": reports.quarterly_growth(star),
        "payment": reports.payment_discount(star),
        "top_customers": reports.top_customers(star),
    }
    exports = export_for_bi(results, f"{root}/outputs", ts, REPORT_EXPORTS)
    found = {
        "best_month": insights.best_month(results["monthly_growth"]),
        "region_flags": insights.region_flags(results["regional"]),
        "underperformers": insights.underperformers(dfs["regional"]),
        "categories": insights.category_ranks(results["category"].select(
            "category", "revenue_share_pct", "revenue_rank")),
        "quarters": insights.quarter_growth(results["qoq"]),
        "rfm_mix": insights.rfm_mix(results["customer_ltv"]),
    }
    secs["report"] = time.time() - t
    return BatchResult(kpi_paths, added, exports, counts.dropped(), found, {k: round(v, 2) for k, v in secs.items()})
