"""Which products, orders and customers are too large for one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from martwright.operators.skew import NO_HOT_KEYS, HotKeys, find_hot_keys


@dataclass(frozen=True)
class SkewProfile:
    products: HotKeys = NO_HOT_KEYS
    orders: HotKeys = NO_HOT_KEYS
    customers: HotKeys = NO_HOT_KEYS


EVEN = SkewProfile()


def profile_skew(
    order_items: DataFrame,
    orders: DataFrame,
    product: str = "product_id",
    order: str = "order_id",
    customer: str = "customer_id",
) -> SkewProfile:
    """Two narrow passes: product and order over the lines, customer over the orders."""
    lines = find_hot_keys(order_items, product, order)
    heads = find_hot_keys(orders, customer)
    return SkewProfile(lines[product], lines[order], heads[customer])
