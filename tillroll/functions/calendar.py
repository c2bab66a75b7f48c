"""Calendar attributes derived from a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(d: Column) -> Column:
    """``YYYY-MM-DD`` text, the reference's ``date_id``."""
    return F.date_format(d, "yyyy-MM-dd")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def calendar_columns(d: Column) -> dict[str, Column]:
    """year, month, month_name, quarter for a date."""
    return {
        "year": F.year(d),
        "month": F.month(d),
        "month_name": month_name(d),
        "quarter": quarter_label(d),
    }
