"""Exact quantiles and quintile scoring without a sort of the rows.

``percentile`` keeps every distinct value of the group in one buffer, and
the scoring here is over all customers.  Only the (at most two) values at each
quantile's position are wanted, so they are *selected*: a bounded sample
brackets each position, one aggregate counts the rows below, at and between
the bracket's ends, and the rows strictly inside are bracketed again, until
few enough are left to fetch (or an end is the value itself).  Each round
keeps some four percent of the rows and none is sorted, moved or written.
Interpolation is linear on the 0-based position ``h = (n - 1) * p``:
``v[floor h] + (v[ceil h] - v[floor h]) * (h - floor h)``, which returns
the value itself when both neighbours are equal.

Quintile scores follow pandas ``qcut(x, 5)``: right-closed bins, lowest
value included.  When ties make two edges equal pandas cannot label the
bins; ``mode='collapse'`` scores ``1 + (number of inner edges < x)`` which
is pandas' answer whenever pandas has one, ``mode='strict'`` raises.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUINTILES = (0.2, 0.4, 0.6, 0.8)
FETCH = 20_000     # values that one step may bring to the driver


@dataclass
class _Open:
    """The values strictly between ``low`` and ``high`` (null: unbounded),
    ``below`` rows before them and ``inside`` rows among them."""
    low: object
    high: object
    below: int
    inside: int

    def holds(self, x: Column) -> Column:
        inside = x.isNotNull()
        if self.low is not None:
            inside &= x > F.lit(self.low)
        return inside if self.high is None else inside & (x < F.lit(self.high))


def values_at(df: DataFrame, col: str, positions: Sequence[int], rows: int, fetch: int = FETCH) -> dict[int, object]:
    """The values at the given 1-based ``positions`` of the ascending order of
    ``col``'s ``rows`` non-null values."""
    x, kind = F.col(col), df.schema[col].dataType
    df = df.select(col)
    found: dict[int, object] = {}
    left = {p: _Open(None, None, 0, rows) for p in set(positions)}
    while left:
        small = {(b.low, b.high): b for b in left.values() if b.inside <= fetch}
        for span, b in small.items():
            seen, at = b.below, sorted(p for p, o in left.items() if (o.low, o.high) == span)
            for value, n in df.where(b.holds(x)).groupBy(col).agg(F.count(F.lit(1))).orderBy(col).collect():
                while at and at[0] <= seen + n:
                    found[at.pop(0)] = value
                seen += n
        left = {p: b for p, b in left.items() if p not in found}
        if not left:
            break
        spans = {(b.low, b.high): b for b in left.values()}
        ends: dict[int, tuple] = {}
        for span, b in spans.items():
            sample = sorted(r[0] for r in df.where(b.holds(x)).sample(min(1.0, fetch / b.inside), 11).collect())
            margin = ceil(3 * len(sample) ** 0.5)
            for p, o in left.items():
                if (o.low, o.high) == span and sample:
                    at = (p - b.below) * len(sample) // b.inside
                    ends[p] = (sample[max(0, at - margin)], sample[min(len(sample) - 1, at + margin)])
        asked = sorted(ends)
        tests = []
        for p in asked:
            inside = left[p].holds(x)
            for end in ends[p]:
                v = F.lit(end).cast(kind)
                tests += [F.count_if(inside & (x < v)), F.count_if(inside & (x == v))]
        if not tests:      # an unlucky empty sample: once more
            continue
        counts = df.agg(*[t.alias(f"c{i}") for i, t in enumerate(tests)]).first()
        for i, p in enumerate(asked):
            b, (low, high) = left[p], ends[p]
            under, at_low, under_high, at_high = counts[4 * i:4 * i + 4]
            place = p - b.below
            if place <= under:
                left[p] = _Open(b.low, low, b.below, under)
            elif place <= under + at_low:
                found[p] = low
            elif place <= under_high:
                left[p] = _Open(low, high, b.below + under + at_low, under_high - under - at_low)
            elif place <= under_high + at_high:
                found[p] = high
            else:
                left[p] = _Open(high, b.high, b.below + under_high + at_high, b.inside - under_high - at_high)
        left = {p: b for p, b in left.items() if p not in found}
    return found


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], fetch: int = FETCH) -> tuple[list[float | None], float | None, float | None]:
    """The quantiles of ``col``'s non-null values, the least and the largest
    (all null if there are none)."""
    n, least, most = df.agg(F.count(col), F.min(col), F.max(col)).first()
    if not n:
        return [None] * len(probs), None, None
    at = [(n - 1) * float(p) for p in probs]
    held = values_at(df, col, [x for h in at for x in (floor(h) + 1, ceil(h) + 1)], n, fetch)
    out = []
    for h in at:
        low, high = float(held[floor(h) + 1]), float(held[ceil(h) + 1])
        out.append(low + (high - low) * (h - floor(h)))
    return out, float(least), float(most)


def quintile_edges(df: DataFrame, col: str, mode: str = "collapse", fetch: int = FETCH) -> list[float | None]:
    """The four inner quintile edges of ``col``."""
    if mode not in ("collapse", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    edges, least, most = exact_quantiles(df, col, QUINTILES, fetch)
    if mode == "strict":
        vals = [least, *edges, most]
        if len(set(vals)) != len(vals):
            raise ValueError(f"quintile edges of {col!r} are not unique: {vals}")
    return edges


def apply_quintile(df: DataFrame, col: str, edges: Sequence[float | None], out: str,
                   reverse: bool = False) -> DataFrame:
    """Score 1 + (inner edges below the value), reversed to 5..1 if asked;
    the edges are literals, so scoring is a plain projection."""
    x = F.col(col).cast("double")
    below = F.lit(0)
    for e in edges:
        if e is not None:
            below = below + F.when(x > F.lit(float(e)), 1).otherwise(0)
    score = (F.lit(5) - below) if reverse else (below + 1)
    return df.withColumn(out, score.cast("long"))


def quintile_score(df: DataFrame, col: str, out: str, reverse: bool = False, mode: str = "collapse", fetch: int = FETCH) -> DataFrame:
    """Add a 1..5 score (5..1 when ``reverse``) of ``col`` over all rows."""
    return apply_quintile(df, col, quintile_edges(df, col, mode, fetch), out, reverse)
