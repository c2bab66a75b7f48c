"""Distinct orders and distinct customers together, without ``Expand``.

Two ``count(distinct ...)`` in one aggregate make Spark write every input row
once per distinct column at the first exchange, with all sums beside them.
Here the sums have an aggregate of their own, reduced before its shuffle to a
row for each key and task, and each distinct column has a roll-up that
reads the key and that column alone: (key, id), then key.  The three results, a
row for each key, meet by key.  Nothing is assumed about which customers
an order names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orders_and_customers(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str], means: Mapping[str, str] | None = None,
                         orders: str = "orders", customers: str = "custs") -> DataFrame:
    """By ``keys``: ``sums`` and ``means`` (name -> column), distinct
    ``order_id`` as ``orders`` and distinct ``customer_id`` as ``customers``.
    Null ids are not counted, as in ``count(distinct)``; null keys are a group;
    means are exact sums over counts of the non-null values, as double."""
    out = df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()], *[
        F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double")).alias(n) for n, c in (means or {}).items()])
    for i, (name, column) in enumerate(((orders, "order_id"), (customers, "customer_id"))):
        own = [f"_k{i}_{j}" for j in range(len(keys))]
        ids = df.select(*[F.col(k).alias(o) for k, o in zip(keys, own, strict=True)], column).distinct()
        counts = ids.groupBy(*own).agg(F.count(column).alias(name))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, own, strict=True)])
        out = out.join(counts, same)
    return out.select(*keys, *sums, orders, customers, *(means or {}))
