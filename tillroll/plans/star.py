"""The star schema every report reads: one wide fact plus four dimensions.

``build_star`` is the lazy definition straight from the source tables.
``load_star`` materialises it once per session and state of the source files as Parquet
under the session's shared checkpoint folder, so the large joins of the
adapter run once and every report afterwards is a scan plus aggregation.
The written tables also cut the lineage: a lost executor re-reads files
instead of recomputing the joins.
"""

from __future__ import annotations

import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import files_state, path_exists, unique_name, work_path
from ..sources import adapter
from ..sources.tables import table_path

FACT_COLUMNS = [
    "order_id", "line_number", "customer_id", "product_id", "order_date", "date_id",
    "year", "month", "month_name", "quarter", "region", "segment", "category",
    "product_name", "payment_method", "quantity", "unit_price", "discount_pct",
    "discount_amt", "gross_revenue", "net_revenue", "cost", "profit", "is_returned",
]


@dataclass(frozen=True)
class Star:
    fact: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    dim_region: DataFrame


def date_dimension(fact: DataFrame) -> DataFrame:
    """One row per day that has a sale (S9).  Rows sharing a date_id are
    identical, so a distinct on all calendar columns is deterministic; the
    partial aggregate keeps at most one row per day per task."""
    return (fact.select("date_id", "month", "month_name", "quarter", "year")
            .distinct()
            .withColumn("is_holiday", F.lit(0)))


def region_dimension(fact: DataFrame) -> DataFrame:
    """Distinct regions (S10); ``performance`` is never filled."""
    return (fact.select(F.col("region").alias("region_name")).distinct()
            .withColumn("performance", F.lit(None).cast("string")))


def customer_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (adapter.customer_attributes(spark, sf_dir)
            .withColumn("joined_date", F.lit(None).cast("date")))


def build_star(spark: SparkSession, sf_dir: str) -> Star:
    fact = adapter.sales_lines(spark, sf_dir)
    return Star(
        fact=fact,
        dim_customer=customer_dimension(spark, sf_dir),
        dim_product=adapter.product_attributes(spark, sf_dir),
        dim_date=date_dimension(fact),
        dim_region=region_dimension(fact),
    )


#: Star and its folder, by application, source folder and the state of its files.
_MEMO: dict[tuple[str, str, str], tuple[Star, str]] = {}
_LOCK = threading.Lock()
SOURCE_TABLES = ("region", "nation", "customer", "orders", "lineitem", "part")


def load_star(spark: SparkSession, sf_dir: str, refresh: bool = False) -> Star:
    """Materialised star for ``sf_dir``: built on first use and reused while
    the source files stay as they are (names, sizes, times) and the written
    star is still there; ``refresh=True`` rebuilds it anyway."""
    state = files_state(spark, [table_path(sf_dir, t) for t in SOURCE_TABLES])
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), state)
    with _LOCK:
        star, root = (None, "") if refresh else _MEMO.get(key, (None, ""))
        if star is None or not path_exists(spark, root):
            root = work_path(spark, "star", unique_name(hashlib.sha1(key[1].encode()).hexdigest()[:10]))
            star = write_star(build_star(spark, sf_dir), root)
            _MEMO[key] = (star, root)
        return star


def write_star(star: Star, root: str) -> Star:
    """Write all five tables under ``root`` and return readers over them.
    No folder by year: each task would sort its joined rows by it, and spill,
    while no reader filters on it.  zstd takes less disk than the default."""
    spark = star.fact.sparkSession
    schemas: dict = {}

    def write(df: DataFrame, name: str) -> None:
        df.write.mode("errorifexists").option("compression", "zstd").parquet(f"{root}/{name}")
        schemas[name] = df.schema

    # Independent writes are separate Spark jobs submitted together, so they
    # share the executors instead of queueing.  The date and region dimensions
    # come from the written fact, so the adapter's joins run exactly once.
    with ThreadPoolExecutor(max_workers=3) as pool:
        done = [pool.submit(write, star.fact.select(*FACT_COLUMNS), "fact_sales"),
                pool.submit(write, star.dim_customer, "dim_customer"),
                pool.submit(write, star.dim_product, "dim_product")]
        [f.result() for f in done]
        fact = read_fact(spark, root, schemas)
        done = [pool.submit(write, date_dimension(fact), "dim_date"),
                pool.submit(write, region_dimension(fact), "dim_region")]
        [f.result() for f in done]
    return read_star(spark, root, schemas)


def _read(spark: SparkSession, root: str, name: str, schemas: dict | None) -> DataFrame:
    """With the schema it was written with, if known, so that no file is opened for it."""
    reader = spark.read.schema(schemas[name]) if schemas else spark.read
    return reader.parquet(f"{root}/{name}")


def read_fact(spark: SparkSession, root: str, schemas: dict | None = None) -> DataFrame:
    return _read(spark, root, "fact_sales", schemas).select(*FACT_COLUMNS)


def read_star(spark: SparkSession, root: str, schemas: dict | None = None) -> Star:
    return Star(
        fact=read_fact(spark, root, schemas),
        dim_customer=_read(spark, root, "dim_customer", schemas),
        dim_product=_read(spark, root, "dim_product", schemas),
        dim_date=_read(spark, root, "dim_date", schemas),
        dim_region=_read(spark, root, "dim_region", schemas),
    )


def register_views(star: Star, prefix: str = "") -> list[str]:
    """Expose the star to Spark SQL as temp views ``fact_sales``,
    ``dim_customer``, ``dim_product``, ``dim_date`` and ``dim_region``.
    Their columns follow the star schema's names, so SQL written against
    that schema runs on Spark SQL over the written tables."""
    views = {"fact_sales": star.fact, "dim_customer": star.dim_customer, "dim_product": star.dim_product,
             "dim_date": star.dim_date, "dim_region": star.dim_region}
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
