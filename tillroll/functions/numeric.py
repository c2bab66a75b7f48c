"""Numeric contract shared by every report.

* Money is summed exactly as ``decimal(18,2)``.
* Ratios are taken in double on exact operands, with a zero denominator
  giving NULL (Spark's ANSI mode would raise; SQLite gives NULL).
* Rounding snaps the double to 8 decimals first and then rounds half away
  from zero on the decimal; this removes binary noise (``1.005``) so every
  engine that follows the same recipe lands on the same cents.
* Output edge: money and percentages as double, counts and ranks as bigint.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
SNAP = "decimal(28,8)"


def dbl(c) -> Column:
    return _col(c).cast("double")


def rnd(c, places: int = 2) -> Column:
    """Round a double (or decimal) the engine-independent way; returns double."""
    return F.round(_col(c).cast(SNAP), places).cast("double")


def r2(c) -> Column:
    return rnd(c, 2)


def ratio(num, den) -> Column:
    """num / den in double; NULL when den is 0 or NULL."""
    return F.try_divide(dbl(num), dbl(den))


def pct(num, den, places: int = 2) -> Column:
    """round(num / den * 100) -- the "divide, then scale" form."""
    return rnd(ratio(num, den) * F.lit(100.0), places)


def pct_scaled(num, den, places: int = 2) -> Column:
    """round(num * 100.0 / den) -- the "scale, then divide" form."""
    return rnd(F.try_divide(dbl(num) * F.lit(100.0), dbl(den)), places)


def growth_pct(cur, prev, places: int = 2) -> Column:
    """round((cur - prev) / prev * 100); NULL without a previous value."""
    return rnd(F.try_divide(dbl(_col(cur) - _col(prev)), dbl(prev)) * F.lit(100.0), places)


def mean(c) -> Column:
    """Average as exact sum over count, in double (never avg(decimal))."""
    return F.try_divide(dbl(F.sum(c)), dbl(F.count(c)))


def money_out(c) -> Column:
    return _col(c).cast("double")


def long_out(c) -> Column:
    return _col(c).cast("bigint")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_totals(df, source, **aggs):
    """Attach one-row aggregates of ``source`` to every row of ``df`` as
    scalar subqueries (evaluated once, merged when they share a source) --
    the company totals and averages the reports divide by, without a join."""
    return df.withColumns({name: source.select(expr).scalar() for name, expr in aggs.items()})


def whole(expr_fn, *cols):
    """``expr_fn`` (``F.sum``/``F.count``...) over all rows of a small,
    domain-bounded aggregate (regions, categories, payment methods): a
    window without partition, so the totals come from rows already
    aggregated instead of a second pass over the fact."""
    from pyspark.sql import Window
    return expr_fn(*cols).over(Window.partitionBy())


def whole_mean(c) -> Column:
    return F.try_divide(dbl(whole(F.sum, c)), dbl(whole(F.count, c)))
