"""Business rules as labelled bands. Cut-offs are parameters; the defaults are the fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwright.functions.columns import ratio, round_half_up

# ---- fixed values: labels and cut-offs the marts must reproduce -------------------------------
ORDER_STATUSES = ("pending", "processing", "shipped", "completed", "cancelled")
COMPLETED_STATUSES = ("completed", "shipped")
CANCELLED_STATUS = "cancelled"

# Label, highest stock in the band.
STOCK_BANDS = (("Out of Stock", 0), ("Low Stock", 50), ("Medium Stock", 150))
STOCK_ABOVE = "High Stock"

LINE_TOLERANCE = 0.01

CUSTOMER_SEGMENTS = ("No Orders", "New", "Active", "At Risk", "Churned")
NEW_DAYS, ACTIVE_DAYS, AT_RISK_DAYS = 30, 90, 365

# Label, most completed orders in the band.
FREQUENCY_BANDS = (
    ("Never Purchased", 0),
    ("One-Time Buyer", 1),
    ("Occasional Buyer", 5),
    ("Regular Buyer", 10),
)
FREQUENCY_ABOVE = "VIP Buyer"

# Label, lowest lifetime revenue of the tier.
VALUE_TIERS = (("Platinum", 1000), ("Gold", 500), ("Silver", 250))
TIER_ABOVE_ZERO, TIER_NONE = "Bronze", "No Purchase"

# Label, range of recency, frequency and monetary scores; the first match wins.
RFM_SEGMENTS = (
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("Promising", (4, 5), (1, 2), (1, 5)),
    ("Potential Loyalists", (3, 5), (1, 2), (1, 5)),
    ("At Risk", (1, 2), (3, 5), (1, 5)),
    ("Lost", (1, 2), (1, 2), (1, 5)),
)
RFM_OTHER = "Need Attention"

# Label, fewest units sold.
VELOCITY_BANDS = (("Best Seller", 10), ("Good Seller", 5), ("Moderate Seller", 2))
VELOCITY_BELOW, VELOCITY_NEVER = "Slow Mover", "Never Sold"

INVENTORY_HEALTH = ("Out of Stock", "Overstock Risk", "Reorder Soon", "Monitor Stock", "Healthy")
REORDER_STOCK, REORDER_UNITS = 50, 10
MONITOR_STOCK, MONITOR_UNITS = 100, 5

TOP_RANKS = 5
SCORE_SCALE, REVENUE_WEIGHT, PROFIT_WEIGHT, VOLUME_WEIGHT = 1000, 0.4, 0.4, 0.2
# -----------------------------------------------------------------------------------------------


def first_match(branches: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    """CASE over (condition, value) pairs; an unknown condition counts as false."""
    result = F.when(branches[0][0], branches[0][1])
    for condition, value in branches[1:]:
        result = result.when(condition, value)
    return result.otherwise(otherwise)


def band_up_to(value: Column, bands: Sequence[tuple[str, object]], above: str) -> Column:
    """Label of the first band whose upper end the value does not pass."""
    return first_match([(value <= top, label) for label, top in bands], above)


def band_from(value: Column, bands: Sequence[tuple[str, object]], below: object) -> Column:
    """Label of the first band whose lower end the value reaches."""
    return first_match([(value >= floor, label) for label, floor in bands], below)


def flag(condition: Column) -> Column:
    """The condition as a boolean that is never NULL."""
    return F.coalesce(condition, F.lit(False))


def inventory_status(stock: Column) -> Column:
    """Stock band. Below zero is 'Low Stock', unknown stock is 'High Stock'."""
    empty, *rest = STOCK_BANDS
    steps = [(stock == empty[1], empty[0])] + [(stock <= top, label) for label, top in rest]
    return first_match(steps, STOCK_ABOVE)


def is_completed(raw_status: Column) -> Column:
    """Looks at the status before blanks are removed: ' completed' is not completed."""
    return flag(F.lower(raw_status).isin(*COMPLETED_STATUSES))


def is_cancelled(raw_status: Column) -> Column:
    return flag(F.lower(raw_status) == CANCELLED_STATUS)


def customer_segment(first_order_age: Column, last_order_age: Column) -> Column:
    """Life-cycle segment from the days since the first and the last order of any status."""
    none, new, active, at_risk, churned = CUSTOMER_SEGMENTS
    return first_match(
        [
            (first_order_age.isNull(), none),
            (first_order_age <= NEW_DAYS, new),
            (last_order_age <= ACTIVE_DAYS, active),
            (last_order_age <= AT_RISK_DAYS, at_risk),
        ],
        churned,
    )


def purchase_frequency_segment(completed_orders: Column) -> Column:
    return band_up_to(completed_orders, FREQUENCY_BANDS, FREQUENCY_ABOVE)


def customer_value_tier(revenue: Column, tiers=VALUE_TIERS) -> Column:
    return first_match(
        [(revenue >= floor, label) for label, floor in tiers] + [(revenue > 0, TIER_ABOVE_ZERO)],
        TIER_NONE,
    )


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """Marketing segment; customers without scores get the last label."""
    scores = (recency, frequency, monetary)
    branches = []
    for label, *ranges in RFM_SEGMENTS:
        # A range that spans every score only asks for nothing, so it is left out.
        tests = [s.between(*r) for s, r in zip(scores, ranges) if r != (1, 5)]
        condition = tests[0]
        for test in tests[1:]:
            condition = condition & test
        branches.append((condition, label))
    return first_match(branches, RFM_OTHER)


def sales_velocity(units: Column, bands=VELOCITY_BANDS) -> Column:
    """Pace of sales; NULL units mean the product was never sold."""
    return F.when(units.isNull(), VELOCITY_NEVER).otherwise(
        band_from(units, bands, VELOCITY_BELOW)
    )


def inventory_health(
    stock: Column, units: Column, reorder_units: int = REORDER_UNITS, monitor_units: int = MONITOR_UNITS
) -> Column:
    empty, overstock, reorder, monitor, healthy = INVENTORY_HEALTH
    return first_match(
        [
            (stock == 0, empty),
            ((stock > 0) & units.isNull(), overstock),
            ((stock <= REORDER_STOCK) & (units >= reorder_units), reorder),
            ((stock <= MONITOR_STOCK) & (units >= monitor_units), monitor),
        ],
        healthy,
    )


def performance_score(revenue_rank: Column, profit_rank: Column, volume_rank: Column) -> Column:
    """Weighted sum of inverse ranks, in doubles; 0 for a product without ranks."""
    weighted = (
        ratio(F.lit(REVENUE_WEIGHT), revenue_rank)
        + ratio(F.lit(PROFIT_WEIGHT), profit_rank)
        + ratio(F.lit(VOLUME_WEIGHT), volume_rank)
    )
    return F.coalesce(round_half_up(weighted * SCORE_SCALE), F.lit(0.0))


def is_top(rank: Column, top: int = TOP_RANKS) -> Column:
    return flag(rank <= top)
