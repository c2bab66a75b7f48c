"""File sources and sinks.

Raw batches are written as ``{raw}/{name}/batch_ts={ts}/part-*.csv``: the
batch stamp is a partition column for readers of all batches, and "the
latest batch" is found from the folder names alone, so older batches are
never read.  Flat files named ``{name}_{ts}.csv`` are handled the same way.
Report exports are written in parts and end as one named file each.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists, remove_path, unique_name

BATCH_COL = "batch_ts"

RAW_TRANSACTIONS = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()), T.StructField("order_date", T.StringType()),
    T.StructField("month", T.IntegerType()), T.StructField("month_name", T.StringType()),
    T.StructField("quarter", T.StringType()), T.StructField("year", T.IntegerType()),
    T.StructField("region", T.StringType()), T.StructField("segment", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("product_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("unit_price", T.DecimalType(18, 2)),
    T.StructField("discount_pct", T.IntegerType()), T.StructField("discount_amt", T.DecimalType(18, 2)),
    T.StructField("gross_revenue", T.DecimalType(18, 2)), T.StructField("net_revenue", T.DecimalType(18, 2)),
    T.StructField("cost", T.DecimalType(18, 2)), T.StructField("profit", T.DecimalType(18, 2)),
    T.StructField("is_returned", T.IntegerType()), T.StructField("payment_method", T.StringType()),
])


def write_raw_batch(df: DataFrame, raw_dir: str, name: str, ts: str) -> str:
    """One raw table batch as headered CSV; an existing batch is an error."""
    path = f"{raw_dir.rstrip('/')}/{name}/{BATCH_COL}={ts}"
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path


def read_batches(spark: SparkSession, raw_dir: str, name: str, schema: T.StructType) -> DataFrame:
    """All batches of a raw table, with the ``batch_ts`` partition column."""
    full = T.StructType(list(schema.fields) + [T.StructField(BATCH_COL, T.StringType())])
    return spark.read.schema(full).option("header", True).csv(f"{raw_dir.rstrip('/')}/{name}")


def read_latest_batch(spark: SparkSession, raw_dir: str, name: str, schema: T.StructType) -> DataFrame:
    """Only the newest batch (largest stamp).  The stamp is read from the
    folder names (a listing, no data), and only that folder is scanned."""
    folder = latest_file(spark, f"{raw_dir.rstrip('/')}/{name}/{BATCH_COL}=*")
    if folder is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(folder)


def latest_file(spark: SparkSession, pattern: str) -> str | None:
    """The last path, by name, matching a glob such as
    ``raw/transactions_*.csv``.  Only names are listed, through the cluster's
    file system; no file is opened."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path)
    names = sorted(str(st.getPath().toString()) for st in (found or []))
    return names[-1] if names else None


def read_latest_csv(spark: SparkSession, raw_dir: str, name: str, schema: T.StructType) -> DataFrame:
    """S1 for flat files named ``{name}_{timestamp}.csv``: read only the
    newest one (timestamps sort as text)."""
    path = latest_file(spark, f"{raw_dir.rstrip('/')}/{name}_*.csv")
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def save_all(dfs: dict[str, DataFrame], out_dir: str, ts: str, fmt: str = "parquet") -> dict[str, str]:
    """S3: write each dataset to ``{out}/{name}_{ts}``; returns the paths."""
    paths = {}
    for name, df in dfs.items():
        path = f"{out_dir.rstrip('/')}/{name}_{ts}"
        w = df.write.mode("errorifexists")
        (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))
        paths[name] = path
    return paths


def _merge_parts(spark: SparkSession, folder: str, target: str, header: str) -> None:
    """One file ``target``: the header, then the folder's parts in their order.
    File systems that can join files (HDFS) are told to; on others the parts are
    copied one after another through a small buffer."""
    jvm = spark.sparkContext._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted(st.getPath().toString() for st in fs.listStatus(path(folder)) if st.getPath().getName().startswith("part-") and st.getLen())
    rough = path(f"{folder}/_merged")
    out = fs.create(rough, True)
    out.write(f"{header}\n".encode())
    out.close()
    try:
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
        for n, part in enumerate(parts):
            array[n] = path(part)
        if parts:
            fs.concat(rough, array)
    except UnsupportedOperationException:
        out = fs.create(rough, True)
        out.write(f"{header}\n".encode())
        for part in parts:
            given = fs.open(path(part))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(given, out, 1 << 20, False)
            given.close()
        out.close()
    if fs.exists(path(target)) or not fs.rename(rough, path(target)):
        raise FileExistsError(target)


def export_report(df: DataFrame, out_dir: str, output_name: str, ts: str) -> str | None:
    """A report as one CSV file ``{output_name}_{ts}.csv`` with a header;
    skipped (None) when the result is empty; an existing file is an error.  The
    report is evaluated once, in parallel: its parts are written to a
    folder beside it, which counts the rows, and then merged in their order."""
    spark = df.sparkSession
    target = f"{out_dir.rstrip('/')}/{output_name}_{ts}.csv"
    if path_exists(spark, target):
        raise FileExistsError(target)
    folder = f"{out_dir.rstrip('/')}/_{unique_name(output_name)}"
    rows = Observation(unique_name("export"))
    df.observe(rows, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").option("header", False).csv(folder)
    try:
        if not int(rows.get["rows"]):
            return None
        _merge_parts(spark, folder, target, ",".join(df.columns))
        return target
    finally:
        remove_path(spark, folder)


# Output names of the eight reports' export, in report order.
REPORT_EXPORTS = [
    ("monthly_growth", "PowerBI_01_Monthly_Revenue"),
    ("regional", "PowerBI_02_Regional_KPIs"),
    ("product_ranking", "PowerBI_03_Product_Ranking"),
    ("category", "PowerBI_04_Category_Analysis"),
    ("customer_ltv", "PowerBI_05_Customer_LTV_RFM"),
    ("qoq", "PowerBI_06_Quarterly_Growth"),
    ("payment", "PowerBI_07_Payment_Discounts"),
    ("top_customers", "PowerBI_08_Top_Customers"),
]

# Output names of the slim reports' export, in report order.
BI_EXPORTS = [
    ("monthly_growth", "PowerBI_Monthly_Revenue"),
    ("regional", "PowerBI_Regional_KPIs"),
    ("product_ranking", "PowerBI_Product_Ranking"),
    ("category", "PowerBI_Category_Analysis"),
    ("customer_ltv", "PowerBI_Customer_LTV"),
    ("qoq", "PowerBI_Quarterly_KPIs"),
    ("payment", "PowerBI_Payment_Methods"),
]


def export_for_bi(results: dict[str, DataFrame], out_dir: str, ts: str, names=BI_EXPORTS) -> dict[str, str]:
    """S4 (``names=REPORT_EXPORTS``) and S5: export the named report set;
    missing or empty results are skipped.  The exports are independent jobs,
    submitted together."""
    todo = [(name, results[key]) for key, name in names if results.get(key) is not None]
    with ThreadPoolExecutor(max_workers=4) as pool:
        paths = list(pool.map(lambda t: export_report(t[1], out_dir, t[0], ts), todo))
    return {name: path for (name, _), path in zip(todo, paths, strict=True) if path}
