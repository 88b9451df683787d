"""The checks declared for the silver and gold tables, and two business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import rules
from martwright.operators.quality import (
    AcceptedValues,
    Check,
    NotNull,
    Relationship,
    Unique,
    violations,
)

# Which column of which table must hold what.
SILVER_CHECKS: dict[str, list[Check]] = {
    "int_orders_enriched": [
        Unique("order_id"),
        NotNull("order_id"),
        NotNull("customer_id"),
        Relationship("customer_id", "dim_customers", "customer_id"),
        NotNull("grand_total"),
        AcceptedValues("order_status", rules.ORDER_STATUSES),
    ],
    "int_customer_orders": [
        Unique("order_item_id"),
        NotNull("order_item_id"),
        NotNull("customer_id"),
        NotNull("is_line_total_valid"),
    ],
    "dim_customers": [
        Unique("customer_id"),
        NotNull("customer_id"),
        NotNull("email"),
        NotNull("customer_segment"),
        AcceptedValues("customer_segment", rules.CUSTOMER_SEGMENTS),
        AcceptedValues(
            "purchase_frequency_segment",
            (*[label for label, _ in rules.FREQUENCY_BANDS], rules.FREQUENCY_ABOVE),
        ),
    ],
}

GOLD_CHECKS: dict[str, list[Check]] = {
    "mart_sales_daily": [
        Unique("date_day"),
        NotNull("date_day"),
        NotNull("net_revenue"),
        NotNull("total_orders"),
    ],
    "mart_customer_lifetime_value": [
        Unique("customer_id"),
        NotNull("customer_id"),
        NotNull("customer_lifetime_value"),
        NotNull("rfm_segment"),
        AcceptedValues(
            "rfm_segment", (*[label for label, *_ in rules.RFM_SEGMENTS], rules.RFM_OTHER)
        ),
        AcceptedValues(
            "customer_value_tier",
            (*[label for label, _ in rules.VALUE_TIERS], rules.TIER_ABOVE_ZERO, rules.TIER_NONE),
        ),
    ],
    "mart_product_performance": [
        Unique("product_id"),
        NotNull("product_id"),
        NotNull("product_name"),
        NotNull("total_revenue"),
        NotNull("total_profit"),
        AcceptedValues(
            "sales_velocity",
            (
                rules.VELOCITY_NEVER,
                rules.VELOCITY_BELOW,
                *[label for label, _ in rules.VELOCITY_BANDS],
            ),
        ),
        AcceptedValues("inventory_health", rules.INVENTORY_HEALTH),
    ],
}

DECLARED_CHECKS = {**SILVER_CHECKS, **GOLD_CHECKS}


def positive_order_totals(enriched: DataFrame) -> DataFrame:
    """Completed orders that do not bring in money."""
    return violations(
        enriched,
        F.col("is_completed") & (F.col("grand_total") <= 0),
        ["order_id", "customer_id", "order_date", "grand_total"],
        "Grand total must be positive for completed orders",
    )


def profit_within_revenue(performance: DataFrame) -> DataFrame:
    """Sold products that earn more than they sell for."""
    revenue, profit = F.col("total_revenue"), F.col("total_profit")
    return violations(
        performance,
        (revenue > 0) & (profit > revenue),
        ["product_id", "product_name", "total_revenue", "total_profit"],
        "Profit cannot exceed revenue",
    )
