"""Data-quality rules for sales lines.

Rows need an order, customer, product, date and net revenue; net revenue
and quantity must be positive; a missing profit counts as 0.  Input and
kept row counts are reported through :class:`pyspark.sql.Observation`s,
which the first action on the result fills in -- no extra pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import unique_name

REQUIRED = ("order_id", "customer_id", "product_id", "order_date", "net_revenue")


@dataclass
class CleanCounts:
    seen: Observation
    kept: Observation

    def dropped(self) -> int:
        return int(self.seen.get["rows"]) - int(self.kept.get["rows"])


def parse_order_date(df: DataFrame) -> DataFrame:
    """Dates arriving as text become ``date``; unparsable text becomes NULL."""
    if isinstance(df.schema["order_date"].dataType, T.StringType):
        return df.withColumn("order_date", F.try_to_date(F.col("order_date")))
    if isinstance(df.schema["order_date"].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn("order_date", F.col("order_date").cast("date"))
    return df


def _kept():
    """The rows that stay (on a parsed order date)."""
    cond = (F.col("net_revenue") > 0) & (F.col("quantity") > 0)
    for c in REQUIRED:
        cond = cond & F.col(c).isNotNull()
    return cond


def clean_transactions(df: DataFrame, counts: CleanCounts | None = None) -> DataFrame:
    if counts is not None:
        df = df.observe(counts.seen, F.count(F.lit(1)).alias("rows"))
    df = parse_order_date(df)
    out = df.where(_kept()).withColumn("profit", F.coalesce(F.col("profit"), F.lit(0).cast(df.schema["profit"].dataType)))
    if counts is not None:
        out = out.observe(counts.kept, F.count(F.lit(1)).alias("rows"))
    return out


def dropped_rows(df: DataFrame) -> DataFrame:
    """One row: ``rows_seen, rows_kept, rows_dropped`` by :func:`clean_transactions`."""
    kept = F.count_if(_kept())
    seen = F.count(F.lit(1))
    return parse_order_date(df).agg(seen.alias("rows_seen"), kept.alias("rows_kept"), (seen - kept).alias("rows_dropped"))


def new_clean_counts() -> CleanCounts:
    return CleanCounts(Observation(unique_name("clean_seen")), Observation(unique_name("clean_kept")))
