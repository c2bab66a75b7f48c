"""Map the driver's TPC-H-style tables onto the retail sales model.

One sales line per ``lineitem`` row:

=================  ==========================================================
order_id           l_orderkey            (an order has up to 7+ lines)
line_number        l_linenumber          ((order_id, line_number) is *not* unique)
customer_id        o_custkey
product_id         l_partkey
order_date         o_orderdate as date; ``date_id`` is its ISO text
region / segment   r_name via customer -> nation -> region / c_mktsegment
category           p_type;  product_name = p_name;  list price = p_retailprice
payment_method     o_orderpriority
quantity           l_quantity as bigint
gross_revenue      l_extendedprice as decimal(18,2)
unit_price         gross / quantity, rounded to cents
discount_pct       round(l_discount * 100) as int (0..10)
discount_amt       round(gross * discount_pct / 100, 2)
cost               round(gross * cost factor of the category, 2)
net_revenue        gross - discount_amt
profit             gross - cost - discount_amt
is_returned        1 when l_returnflag = 'R'
=================  ==========================================================

Join order is chosen for scale (Spark does not reorder joins without CBO
statistics): the two large fact-side inputs are each joined to their own
dimension first -- orders to customers, line items to parts -- so that the
line-item-sized data is shuffled only twice (by part key, then by order key),
as keys and base measures in small types; what can be derived from them (money
columns, calendar) is derived after the last shuffle.
Nation and region are fixed-size (25 and 5 rows); Spark broadcasts them on
its own from the file statistics, so no hint is needed anywhere here.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns, iso_date
from ..functions.numeric import MONEY, SNAP
from ..session import shuffle_partitions
from .tables import read_table

# ---------------------------------------------------------------------------
# Cost as a share of gross revenue per product category
# (1 - margin).  The categories are the p_type values of the test data.
# ---------------------------------------------------------------------------
COST_FACTORS = [
    ("ECONOMY", "0.78"),
    ("SMALL", "0.52"),
    ("MEDIUM", "0.62"),
    ("LARGE", "0.65"),
    ("PROMO", "0.45"),
]
COST_FACTOR_OTHER = "0.70"  # STANDARD and anything else
RETURNED_FLAG = "R"
# ---------------------------------------------------------------------------


def cost_factor(category) -> F.Column:
    out = None
    for name, f in COST_FACTORS:
        cond = category == F.lit(name)
        lit = F.lit(Decimal(f))
        out = F.when(cond, lit) if out is None else out.when(cond, lit)
    return out.otherwise(F.lit(Decimal(COST_FACTOR_OTHER)))


def customer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, customer_name, segment, region, city (= nation name)."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return (c.join(geo, c.c_nationkey == geo.n_nationkey)
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_name").alias("customer_name"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("r_name").alias("region"),
                    F.col("n_name").alias("city")))


def product_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """product_id, product_name, category, list_price, cost_price, margin_pct."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"])
    f = cost_factor(F.col("p_type"))
    price = F.col("p_retailprice").cast(MONEY)
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        price.alias("unit_price"),
        F.round(price * f, 2).cast(MONEY).alias("cost_price"),
        ((F.lit(1) - f) * 100).cast("double").alias("margin_pct"),
    )


#: Lines that one task of the large joins sorts, at most on average.
TASK_LINES = 1_000_000


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide sales fact (lazy).  See the module docstring for the mapping."""
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    cust = customer_attributes(spark, sf_dir).select("customer_id", "segment", "region")
    order_side = (orders.join(cust, orders.o_custkey == cust.customer_id)
                  .select(F.col("o_orderkey").alias("order_id"), "customer_id", "segment", "region",
                          F.col("o_orderdate").cast("date").alias("order_date"),
                          F.col("o_orderpriority").alias("payment_method")))

    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_returnflag"])
    prod = product_attributes(spark, sf_dir).select("product_id", "product_name", "category")
    tasks = join_tasks(spark, li)
    line_side = dealt(base_measures(li), "l_partkey", tasks).join(
        dealt(prod, "product_id", tasks), F.col("l_partkey") == F.col("product_id")).drop("l_partkey")

    joined = dealt(line_side, "l_orderkey", tasks).join(
        dealt(order_side, "order_id", tasks), F.col("l_orderkey") == F.col("order_id"))
    return enrich_lines(joined)


def join_tasks(spark: SparkSession, lines: DataFrame) -> int | None:
    """How many tasks the large joins need so that none sorts more than about
    TASK_LINES lines (more would spill); None if the session's partitions
    are enough.  The count comes from the files' footers."""
    need = -(-lines.count() // TASK_LINES)
    return need if need > shuffle_partitions(spark) else None


def dealt(df: DataFrame, key: str, tasks: int | None) -> DataFrame:
    return df.repartition(tasks, key) if tasks else df


def base_measures(lines: DataFrame) -> DataFrame:
    """Keys and base measures of the line items in their final types, which are
    smaller in a shuffle than the given doubles and texts."""
    return lines.select(
        "l_orderkey", "l_partkey", F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.round(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        F.col("l_extendedprice").cast(MONEY).alias("gross_revenue"),
        F.when(F.col("l_returnflag") == RETURNED_FLAG, 1).otherwise(0).alias("is_returned"))


def enrich_lines(df: DataFrame) -> DataFrame:
    """Derived measures and calendar columns for joined line rows (P24 on this
    data), after the last shuffle, so that none of them is moved."""
    gross, disc_pct = F.col("gross_revenue"), F.col("discount_pct")
    disc_amt = F.round(gross * disc_pct * F.lit(Decimal("0.01")), 2).cast(MONEY)
    cost = F.round(gross * cost_factor(F.col("category")), 2).cast(MONEY)
    unit_price = F.round((gross.cast("double") / F.col("quantity")).cast(SNAP), 2).cast(MONEY)
    d = F.col("order_date")
    cal = calendar_columns(d)
    return df.select(
        "order_id", "line_number", "customer_id", "product_id", "order_date",
        iso_date(d).alias("date_id"),
        *[v.alias(k) for k, v in cal.items()],
        "region", "segment", "category", "product_name", "payment_method", "quantity",
        unit_price.alias("unit_price"),
        "discount_pct",
        disc_amt.alias("discount_amt"),
        "gross_revenue",
        (gross - disc_amt).cast(MONEY).alias("net_revenue"),
        cost.alias("cost"),
        (gross - cost - disc_amt).cast(MONEY).alias("profit"),
        "is_returned",
    )
