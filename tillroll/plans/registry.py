"""Query keys -> callables ``(spark, sf_dir) -> DataFrame``.

Each callable reads the driver tables under ``sf_dir`` (through the star,
materialised once per state of its input files) and returns a DataFrame whose
columns match the oracle SQL of the same key.  The returned plan is lazy, but
queries that rank or score (R3, R5, R8, V3, K3, K5, K6 and the ``rank_*``,
``ntile_*`` and ``running_*`` keys), and fact_insert_or_ignore and fact_redelivery,
write intermediate tables while it is built.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import long_out, money_out
from ..operators.clean import clean_transactions, dropped_rows
from ..operators.dedupe import ARRIVAL, insert_or_ignore, number_places
from ..operators.ordering import materialize, ranked_by
from ..session import unique_name, work_path
from . import insights, kpis, reports, variants
from .star import FACT_COLUMNS, Star, load_star
from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]


def fact_output(fact: DataFrame) -> DataFrame:
    """The fact at the output edge: money as double, date as ISO text."""
    money = {"unit_price", "discount_amt", "gross_revenue", "net_revenue", "cost", "profit"}
    cols = []
    for c in FACT_COLUMNS:
        if c == "date_id":
            continue
        if c == "order_date":
            cols.append(F.col("date_id").alias("order_date"))
        elif c in ("year", "month"):
            cols.append(long_out(c).alias(c))
        elif c in money:
            cols.append(money_out(c).alias(c))
        else:
            cols.append(F.col(c))
    return fact.select(*cols)


def fact_totals(star: Star) -> DataFrame:
    f = star.fact
    return f.agg(
        F.count(F.lit(1)).alias("transactions"), money_out(F.sum("net_revenue")).alias("net_revenue"),
        money_out(F.sum("gross_revenue")).alias("gross_revenue"),
        money_out(F.sum("discount_amt")).alias("total_discounts"),
        money_out(F.sum("profit")).alias("total_profit"), long_out(F.sum("is_returned")).alias("total_returns"))


def revenue_by_region(star: Star) -> DataFrame:
    return (star.fact.groupBy("region").agg(money_out(F.sum("net_revenue")).alias("net_revenue"))
            .orderBy(F.desc("net_revenue")))


def with_defects(star: Star) -> DataFrame:
    """Sales lines with defects injected by rule: net revenue missing on line
    7, zero quantity on line 6, missing profit on line 5."""
    ln = F.col("line_number")
    return star.fact.withColumns({
        "net_revenue": F.when(ln != 7, F.col("net_revenue")),
        "quantity": F.when(ln == 6, F.lit(0).cast("bigint")).otherwise(F.col("quantity")),
        "profit": F.when(ln != 5, F.col("profit"))})


def clean_with_defects(star: Star) -> DataFrame:
    """The cleaner on sales lines with defects."""
    c = clean_transactions(with_defects(star))
    return c.select("order_id", "line_number", "customer_id", "product_id",
                    F.date_format("order_date", "yyyy-MM-dd").alias("order_date"), "quantity",
                    money_out("net_revenue").alias("net_revenue"), money_out("profit").alias("profit"))


def _empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def dim_customer_load(star: Star) -> DataFrame:
    batch = star.dim_customer.withColumn(ARRIVAL, F.col("customer_id"))
    out = insert_or_ignore(_empty_like(batch), batch, ["customer_id"], [ARRIVAL]).drop(ARRIVAL)
    return out.withColumn("joined_date", F.date_format("joined_date", "yyyy-MM-dd"))


def dim_customer_redelivery(star: Star) -> DataFrame:
    """Every customer twice, the renamed row first, against a dimension that
    holds a third of them: the renamed rows of the others are to be added."""
    d = star.dim_customer
    batch = (d.withColumn(ARRIVAL, F.col("customer_id") * 2 + 1)
             .unionByName(d.withColumns({"customer_name": F.concat("customer_name", F.lit(" (later)")),
                                         ARRIVAL: F.col("customer_id") * 2})))
    out = insert_or_ignore(d.where("customer_id % 3 = 0"), batch, ["customer_id"], [ARRIVAL])
    return out.select("customer_id", "customer_name", "segment", "region", "city",
                      F.date_format("joined_date", "yyyy-MM-dd").alias("joined_date"))


def dim_customer_two_files(star: Star) -> DataFrame:
    """Customers delivered as files of two folders: every third, renamed, in the
    first, all in the second, whose files are larger.  The first by file
    path wins, whatever order Spark reads them in."""
    spark = star.dim_customer.sparkSession
    folder = work_path(spark, "tables", unique_name("deliveries"))
    renamed = star.dim_customer.where("customer_id % 3 = 0").withColumn("customer_name", F.concat("customer_name", F.lit(" (first)")))
    for name, df in (("1-first", renamed), ("2-all", star.dim_customer)):
        df.write.option("header", True).csv(f"{folder}/{name}")
    wh = Warehouse(spark, work_path(spark, "tables", unique_name("warehouse")))
    wh.create_tables()
    wh.load_dimension("dim_customer", spark.read.schema(star.dim_customer.schema).option("header", True).csv([f"{folder}/2-all", f"{folder}/1-first"]))
    return wh.table("dim_customer").select(F.col("customer_id").cast("bigint").alias("customer_id"), "customer_name", "segment", "region")


def dim_product_load(star: Star) -> DataFrame:
    batch = star.dim_product.withColumn(ARRIVAL, F.col("product_id"))
    out = insert_or_ignore(_empty_like(batch), batch, ["product_id"], [ARRIVAL])
    return out.select("product_id", "product_name", "category", money_out("unit_price").alias("unit_price"),
                      money_out("cost_price").alias("cost_price"), "margin_pct")


#: An arrival number that both sides of the check can form; unique among the lines of a key.
LINE_ARRIVAL = "product_id * 1000 + quantity"


def fact_insert_or_ignore(star: Star) -> DataFrame:
    """Load the sales lines into an empty fact keyed by (order_id,
    line_number): the key repeats in the data, the first to arrive wins."""
    batch = star.fact.withColumn(ARRIVAL, F.expr(LINE_ARRIVAL))
    return fact_output(insert_or_ignore(_empty_like(batch), number_places(batch), ["order_id", "line_number"], [ARRIVAL]))


def fact_redelivery(star: Star) -> DataFrame:
    """Lines to add when all sales arrive again, the last product first, and
    the fact already holds the keys of early days."""
    batch = star.fact.withColumn(ARRIVAL, -F.expr(LINE_ARRIVAL))
    target = batch.where((F.col("order_date") < F.lit("1997-01-01").cast("date")) & (F.col("line_number") <= 3))
    return fact_output(insert_or_ignore(target, number_places(batch), ["order_id", "line_number"], [ARRIVAL]))


def fact_load_outcomes(star: Star) -> DataFrame:
    """A warehouse load of sales lines with injected defects, twice: lines by
    outcome (reject reasons, lines loaded, lines loaded the second time).  Line
    7 names an unknown product, line 6 no customer, line 5 a text date."""
    spark = star.fact.sparkSession
    wh = Warehouse(spark, work_path(spark, "tables", unique_name("warehouse")))
    wh.create_tables()
    ln = F.col("line_number")
    wh.load_dimension("dim_customer", star.dim_customer)
    wh.load_dimension("dim_product", star.dim_product)
    sales = star.fact.withColumns({
        "product_id": F.when(ln == 7, F.lit(-1)).otherwise(F.col("product_id")),
        "customer_id": F.when(ln != 6, F.col("customer_id")),
        "date_id": F.when(ln == 5, F.lit("garbage")).otherwise(F.col("date_id"))})
    added = [wh.load_fact(sales, batch_id="first"), wh.load_fact(sales, batch_id="first")]
    loaded = spark.createDataFrame(list(zip(("loaded", "loaded again"), added, strict=True)), "outcome string, lines long")
    return wh.table("fact_rejects").groupBy(F.col("reason").alias("outcome")).agg(F.count(F.lit(1)).alias("lines")).unionByName(loaded)


def new_keys_only(star: Star) -> DataFrame:
    """Customers arriving in a full re-delivery, against a dimension that
    already holds the customers first seen before 1998."""
    early = star.fact.where(F.col("order_date") < F.lit("1998-01-01").cast("date")).select("customer_id")
    target = star.dim_customer.join(early, "customer_id", "left_semi")
    out = insert_or_ignore(target, star.dim_customer.withColumn(ARRIVAL, F.col("customer_id")), ["customer_id"], [ARRIVAL]).drop(ARRIVAL)
    return out.withColumn("joined_date", F.date_format("joined_date", "yyyy-MM-dd"))


def _customers(star: Star) -> tuple[DataFrame, int]:
    return materialize(reports.customer_transactions(star).select("customer_id", "region", "spend", "orders"), "customers")


def rank_distributed(star: Star) -> DataFrame:
    c, n = _customers(star)
    c = ranked_by(c, ["customer_id"], [
        dict(order=[("spend", False)], outputs={"spend_rank": "rank", "spend_dense_rank": "dense_rank",
                                                "spend_row_number": "row_number", "spend_percent_rank": "percent_rank"}),
        dict(order=[("orders", False)], partition=["region"], outputs={
            "region_orders_rank": "rank", "region_orders_dense_rank": "dense_rank", "region_customers": "count"})], rows=n)
    return c.select("customer_id", "region", money_out("spend").alias("total_spend"),
                    long_out("orders").alias("total_orders"), "spend_rank", "spend_dense_rank",
                    "spend_row_number", "spend_percent_rank", "region_orders_rank",
                    "region_orders_dense_rank", "region_customers")


def ntile_distributed(star: Star) -> DataFrame:
    c, n = _customers(star)
    c = ranked_by(c, ["customer_id"], [
        dict(order=[("spend", True)], outputs={"spend_quintile": "ntile5"}),
        dict(order=[("orders", False)], outputs={"orders_quartile": "ntile4"}),
        dict(order=[("spend", False)], partition=["region"], outputs={"region_spend_decile": "ntile10"})], rows=n)
    return c.select("customer_id", "region", money_out("spend").alias("total_spend"),
                    long_out("orders").alias("total_orders"), "spend_quintile", "orders_quartile",
                    "region_spend_decile")


def running_total_distributed(star: Star) -> DataFrame:
    c, n = _customers(star)
    c = ranked_by(c, ["customer_id"], [
        dict(order=[("spend", False)], sums=["spend"], outputs={"cum": "cum_spend"}),
        dict(order=[("orders", False)], partition=["region"], sums=["spend"], outputs={"region_cum": "cum_spend"})], rows=n)
    return c.select("customer_id", "region", money_out("spend").alias("total_spend"),
                    money_out("cum").alias("running_spend"), money_out("region_cum").alias("region_running_spend"))


def rank_average_method(star: Star) -> DataFrame:
    p, n = materialize(star.fact.groupBy("product_id").agg(F.sum("net_revenue").alias("rev")), "product_revenue")
    p = ranked_by(p, ["product_id"], [dict(order=[("rev", False)], outputs={
        "revenue_rank_average": "average_rank", "revenue_rank_min": "rank"})], rows=n)
    return p.select("product_id", money_out("rev").alias("total_revenue"), "revenue_rank_average",
                    "revenue_rank_min")


def shared_orders(star: Star) -> Star:
    """The star with orders that name several customers: odd lines go to the
    customer with the next number."""
    customer = F.col("customer_id") + F.col("line_number") % 2
    return replace(star, fact=star.fact.withColumn("customer_id", customer.cast("bigint")))


#: Reports that count distinct orders and customers, run over shared orders as ``shared_<key>`` too.
COUNTS_BOTH = ("rpt_monthly_growth", "rpt_region_vs_average", "rpt_product_ranking", "rpt_category_share", "rpt_quarterly_growth",
               "rpt_payment_discount", "var_monthly", "var_regional_3tier", "var_categories", "var_quarterly", "kpi_monthly",
               "kpi_regional", "kpi_categories")


def _kpi_sales(star: Star) -> DataFrame:
    return clean_transactions(with_defects(star))


def kpi_dropped_rows(star: Star) -> DataFrame:
    """Lines that the transformation read, kept and dropped."""
    return dropped_rows(with_defects(star))


def _kpi_customers(star: Star) -> DataFrame:
    sales = _kpi_sales(star)
    return kpis.customer_kpis(sales, kpis.rfm_quintiles(sales))


def _on_star(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_star(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.on_star = fn
    return run


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "fact_sales": _on_star(lambda s: fact_output(s.fact)),
        "fact_totals": _on_star(fact_totals),
        "revenue_by_region": _on_star(revenue_by_region),
        "rpt_monthly_growth": _on_star(reports.monthly_growth),
        "rpt_monthly_ytd_reset": _on_star(lambda s: reports.monthly_growth(s, reset_per_year=True)),
        "rpt_region_vs_average": _on_star(reports.region_vs_average),
        "rpt_product_ranking": _on_star(reports.product_ranking),
        "rpt_category_share": _on_star(reports.category_share),
        "rpt_customer_ltv_rfm": _on_star(reports.customer_ltv_rfm),
        "rpt_customer_ltv_rfm_corrected": _on_star(
            lambda s: reports.customer_ltv_rfm(s, recency_mode="corrected")),
        "rpt_quarterly_growth": _on_star(reports.quarterly_growth),
        "rpt_payment_discount": _on_star(reports.payment_discount),
        "rpt_top_customers": _on_star(reports.top_customers),
        "var_monthly": _on_star(variants.monthly_slim),
        "var_regional_3tier": _on_star(variants.regional_3tier),
        "var_products": _on_star(variants.products_slim),
        "var_categories": _on_star(variants.categories_slim),
        "var_ltv_by_segment": _on_star(variants.ltv_by_segment),
        "var_quarterly": _on_star(variants.quarterly_slim),
        "var_payment_share": _on_star(variants.payment_share),
        "var_region_summary": _on_star(variants.region_summary),
        "clean_transactions": _on_star(clean_with_defects),
        "dim_date": _on_star(lambda s: s.dim_date.select("date_id", "month", "month_name", "quarter",
                                                         "year", "is_holiday")),
        "dim_region": _on_star(lambda s: s.dim_region),
        "dim_customer": _on_star(dim_customer_load),
        "dim_product": _on_star(dim_product_load),
        "fact_insert_or_ignore": _on_star(fact_insert_or_ignore),
        "fact_redelivery": _on_star(fact_redelivery),
        "dim_customer_redelivery": _on_star(dim_customer_redelivery),
        "dim_customer_two_files": _on_star(dim_customer_two_files),
        "fact_load_outcomes": _on_star(fact_load_outcomes),
        "new_keys_only": _on_star(new_keys_only),
        "kpi_dropped_rows": _on_star(kpi_dropped_rows),
        "kpi_monthly": _on_star(lambda s: kpis.monthly_kpis(_kpi_sales(s))),
        "kpi_regional": _on_star(lambda s: kpis.regional_kpis(_kpi_sales(s))),
        "kpi_products": _on_star(lambda s: kpis.product_kpis(_kpi_sales(s))),
        "kpi_categories": _on_star(lambda s: kpis.category_kpis(_kpi_sales(s))),
        "kpi_rfm_quintile": _on_star(lambda s: kpis.rfm_quintiles(_kpi_sales(s))),
        "kpi_customers": _on_star(_kpi_customers),
        "ins_best_month": _on_star(lambda s: insights.best_month(reports.monthly_growth(s))),
        "ins_region_flags": _on_star(lambda s: insights.region_flags(reports.region_vs_average(s))),
        "ins_underperformers": _on_star(
            lambda s: insights.underperformers(kpis.regional_kpis(_kpi_sales(s)))),
        "ins_below_average": _on_star(
            lambda s: insights.underperformers(kpis.regional_kpis(_kpi_sales(s)), below=0)),
        "ins_category": _on_star(lambda s: insights.category_ranks(variants.categories_slim(s))),
        "ins_quarters": _on_star(lambda s: insights.quarter_growth(reports.quarterly_growth(s))),
        "ins_rfm_mix": _on_star(lambda s: insights.rfm_mix(reports.customer_ltv_rfm(s))),
        "top_products": _on_star(insights.top_products),
        "rank_distributed": _on_star(rank_distributed),
        "ntile_distributed": _on_star(ntile_distributed),
        "running_total_distributed": _on_star(running_total_distributed),
        "rank_average_method": _on_star(rank_average_method),
    }
    for key in COUNTS_BOTH:
        q[f"shared_{key}"] = _on_star(lambda s, report=q[key].on_star: report(shared_orders(s)))
    return q
