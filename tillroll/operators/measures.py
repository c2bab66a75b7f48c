"""Sales measures and calendar columns for raw transaction lines.

For lines that arrive with a unit price, quantity, discount percentage and
the product's cost price, every money column is derived exactly in
decimal and rounded to cents; calendar columns come from the order date.
(The driver's test tables take another route to the same columns, see
:func:`tillroll.sources.adapter.enrich_lines`.)
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..functions.numeric import MONEY


def derive_measures(df: DataFrame) -> DataFrame:
    """Needs ``unit_price, quantity, discount_pct, cost_price, order_date``;
    adds gross/discount/net revenue, cost, profit and year, month,
    month_name, quarter.  ``is_returned`` becomes 0/1 when present."""
    price = F.col("unit_price").cast(MONEY)
    cost_price = F.col("cost_price").cast(MONEY)
    qty = F.col("quantity")
    gross = F.round(price * qty, 2).cast(MONEY)
    discount = F.round(gross * F.col("discount_pct") / F.lit(Decimal("100")), 2).cast(MONEY)
    d = F.to_date(F.col("order_date"))
    cal = calendar_columns(d)
    out = df.withColumns({
        "gross_revenue": gross,
        "discount_amt": discount,
        "net_revenue": F.round(gross - discount, 2).cast(MONEY),
        "cost": F.round(cost_price * qty, 2).cast(MONEY),
        "profit": F.round((price - cost_price) * qty - discount, 2).cast(MONEY),
        "year": cal["year"], "month": cal["month"], "month_name": cal["month_name"], "quarter": cal["quarter"],
    })
    if "is_returned" in df.columns:
        out = out.withColumn("is_returned", F.when(F.col("is_returned").cast("boolean"), 1).otherwise(0))
    return out
