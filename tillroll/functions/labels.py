"""Classification columns (searched CASE chains) used by the reports.

Every function takes a Column holding the measure and returns a string
Column; NULL inputs fall through to the final arm exactly as SQL CASE does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Label texts and thresholds that must equal the reference's
# output. Kept together, in their natural order.
# ---------------------------------------------------------------------------
TIER5 = [  # vs-average %, first matching lower bound wins
    (10, "Strong Performer"),
    (5, "Above Average"),
    (-5, "Average"),
    (-15, "Below Average"),
]
TIER5_ELSE = "Underperforming"

RECOMMEND_IMMEDIATE = "Immediate action required — review pricing and marketing strategy"
RECOMMEND_MONITOR = "Monitor closely — targeted campaigns recommended"
RECOMMEND_REPLICATE = "Replicate strategy in other regions"
RECOMMEND_MAINTAIN = "Maintain current strategy"

TIER3_ABOVE = "Above Average"
TIER3_BELOW = "Below Average"
TIER3_MID = "Average"

RFM_SEGMENTS = [  # total RFM score, first matching lower bound wins
    (13, "Champions"),
    (10, "Loyal Customers"),
    (7, "Potential Loyalists"),
    (5, "At Risk"),
]
RFM_ELSE = "Lost"

GROWTH_CLASSES = [  # quarter-over-quarter growth %
    (20, "Strong Growth"),
    (5, "Moderate Growth"),
    (-5, "Stable"),
    (-20, "Declining"),
]
GROWTH_BASELINE = "Baseline Quarter"
GROWTH_ELSE = "Significant Decline"

DISCOUNT_NONE = "No Discount"
DISCOUNT_LOW = "1-5% Discount"
DISCOUNT_MID = "6-10% Discount"
DISCOUNT_HIGH = "11%+ Discount"

FLAG_RED = "red"
FLAG_YELLOW = "yellow"
FLAG_GREEN = "green"
# ---------------------------------------------------------------------------


def _lower_bound_chain(x: Column, arms, otherwise: str) -> Column:
    out = None
    for bound, label in arms:
        cond = x >= F.lit(bound)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(otherwise)


def performance_tier5(vs_avg_pct: Column) -> Column:
    """Five tiers on the *unrounded* percentage difference from the average."""
    return _lower_bound_chain(vs_avg_pct, TIER5, TIER5_ELSE)


def recommendation(vs_avg_pct: Column) -> Column:
    x = vs_avg_pct
    return (F.when(x < -10, RECOMMEND_IMMEDIATE)
            .when(x < -5, RECOMMEND_MONITOR)
            .when(x >= 10, RECOMMEND_REPLICATE)
            .otherwise(RECOMMEND_MAINTAIN))


def performance_tier3(vs_avg_pct: Column) -> Column:
    """Three tiers: >= 5 above, <= -5 below, otherwise average."""
    x = vs_avg_pct
    return F.when(x >= 5, TIER3_ABOVE).when(x <= -5, TIER3_BELOW).otherwise(TIER3_MID)


def rfm_segment(score: Column) -> Column:
    return _lower_bound_chain(score, RFM_SEGMENTS, RFM_ELSE)


def growth_class(growth_pct: Column, prev: Column) -> Column:
    """Growth class; a NULL growth falls through to the IS NULL arm."""
    out = None
    for bound, label in GROWTH_CLASSES:
        cond = growth_pct >= F.lit(bound)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.when(prev.isNull(), GROWTH_BASELINE).otherwise(GROWTH_ELSE)


def discount_band(discount_pct: Column) -> Column:
    x = discount_pct
    return (F.when(x == 0, DISCOUNT_NONE)
            .when(x <= 5, DISCOUNT_LOW)
            .when(x <= 10, DISCOUNT_MID)
            .otherwise(DISCOUNT_HIGH))


def region_flag(vs_avg_pct: Column) -> Column:
    x = vs_avg_pct
    return F.when(x < -10, FLAG_RED).when(x < 0, FLAG_YELLOW).otherwise(FLAG_GREEN)
