"""Staging: one tidy row per raw row. No join, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import rules
from martwright.functions.columns import percent, period_start, surrogate_key, tidy


def stg_customers(raw: DataFrame) -> DataFrame:
    """Customers with a full name and a tidy e-mail; the key hashes the e-mail as it came."""
    first, last, email = F.col("first_name"), F.col("last_name"), F.col("email")
    return raw.select(
        "customer_id",
        surrogate_key(first, last, email).alias("customer_key"),
        first,
        last,
        F.concat(first, F.lit(" "), last).alias("full_name"),
        tidy(email).alias("email"),
        "phone",
        "city",
        "state",
        "country",
        "postal_code",
        "created_at",
        "updated_at",
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    """Orders with calendar columns, tidy codes and the two status flags."""
    ordered, status = F.col("order_date"), F.col("order_status")
    periods = [
        period_start(ordered, unit).alias(f"order_{unit}")
        for unit in ("week", "month", "quarter", "year")
    ]
    return raw.select(
        "order_id",
        surrogate_key(F.col("order_id")).alias("order_key"),
        "customer_id",
        "order_date",
        F.to_date(ordered).alias("order_date_day"),
        *periods,
        tidy(status).alias("order_status"),
        rules.is_completed(status).alias("is_completed"),
        rules.is_cancelled(status).alias("is_cancelled"),
        tidy(F.col("shipping_method")).alias("shipping_method"),
        tidy(F.col("payment_method")).alias("payment_method"),
        "shipping_cost",
        "tax_amount",
        "discount_amount",
        "created_at",
        "updated_at",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    """Products with margin and stock band."""
    price, cost, stock = F.col("price"), F.col("cost"), F.col("stock_quantity")
    return raw.select(
        "product_id",
        surrogate_key(F.col("product_id")).alias("product_key"),
        *[F.trim(c).alias(c) for c in ("product_name", "category", "subcategory", "brand")],
        price.alias("unit_price"),
        cost.alias("unit_cost"),
        (price - cost).alias("unit_profit"),
        percent(price - cost, price).alias("profit_margin_pct"),
        stock,
        rules.inventory_status(stock).alias("inventory_status"),
        "created_at",
        "updated_at",
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    """Lines with the recomputed total, its distance from the given one, and whether they agree."""
    expected = F.round(F.col("quantity") * F.col("unit_price"), 2)
    distance = F.abs(F.col("line_total") - expected)
    return raw.select(
        "order_item_id",
        surrogate_key(F.col("order_item_id")).alias("order_item_key"),
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        "line_total",
        expected.alias("calculated_line_total"),
        distance.alias("line_total_variance"),
        rules.flag(distance < F.lit(rules.LINE_TOLERANCE).cast("decimal(4,2)")).alias(
            "is_line_total_valid"
        ),
        "created_at",
    )
