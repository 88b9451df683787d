"""Silver: enriched orders, order lines with their context, and the customer dimension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions import rules
from martwright.functions.columns import as_of_day, day_count, percent, ratio, surrogate_key
from martwright.operators.skew import NO_HOT_KEYS, HotKeys, fits_broadcast, skew_join
from martwright.plans.skew_profile import EVEN, SkewProfile


def count_ids(identity: str, condition: str | None = None, unique: bool = False) -> Column:
    """Number of different ids among the rows that meet a condition.

    Distinct counts of one column share one copy of the rows, whatever their FILTER conditions; a
    CASE inside each count would cost a copy per count. Where the id is known to occur once in the
    input, plain counting says the same without any copy.
    """
    count = f"count({'' if unique else 'DISTINCT '}{identity})"
    return F.expr(count if condition is None else f"{count} FILTER (WHERE {condition})")


def order_line_totals(order_items: DataFrame, unique_items: bool = False) -> DataFrame:
    """Lines summed up per order; lines that name no order are left out.

    Two distinct counts in one aggregate would copy every line three times, and an aggregate for each
    would shuffle the lines twice over. Instead one shuffle deals them by order, where the first line of
    each item and of each product is marked; windows spill, so an order may have any number of lines.
    """
    lines = order_items.where(F.col("order_id").isNotNull()).select(
        "order_item_id", "order_id", "product_id", "quantity", "line_total", "created_at"
    )
    lines = lines.repartition("order_id")

    def count_first(column: str) -> Column:
        return F.count_if(F.col(f"_first_{column}") & F.col(column).isNotNull())

    marked = ["product_id"] if unique_items else ["order_item_id", "product_id"]
    for column in marked:
        place = F.row_number().over(Window.partitionBy("order_id", column).orderBy(column))
        lines = lines.withColumn(f"_first_{column}", place == 1)
    items = count_ids("order_item_id", unique=True) if unique_items else count_first("order_item_id")
    return lines.groupBy("order_id").agg(
        items.alias("items_count"),
        count_first("product_id").alias("unique_products_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("line_total").alias("subtotal_amount"),
        F.min("created_at").alias("first_item_at"),
        F.max("created_at").alias("last_item_at"),
    )


def items_of(order_items: DataFrame, orders: DataFrame, hot_orders: HotKeys = NO_HOT_KEYS) -> DataFrame:
    """Lines of the given orders, so an incremental run sums up only what it needs."""
    wanted = orders.select("order_id").distinct()
    return skew_join(order_items, wanted, "order_id", hot=hot_orders, spread="order_item_id").select(
        *order_items.columns
    )


def affected_orders(
    orders: DataFrame,
    order_items: DataFrame,
    customers: DataFrame,
    changed: Callable[[Column], Column],
    hot_customers: HotKeys = NO_HOT_KEYS,
) -> DataFrame:
    """Ids of orders that changed, got a line, or belong to a customer that changed; each id once.

    `changed` tells by a moment whether a row is new. Its bounds are literals, so each of the three scans
    reads only the files that can hold such rows, and one key column; dates of the orders do not matter.
    """
    own = orders.where(changed(F.col("updated_at"))).select("order_id")
    by_line = order_items.where(changed(F.col("created_at"))).select("order_id")
    renewed = customers.where(changed(F.col("updated_at"))).select("customer_id").distinct()
    heads = orders.select("order_id", "customer_id")
    by_customer = skew_join(heads, renewed, "customer_id", hot=hot_customers, spread="order_id").select("order_id")
    found = own.unionByName(by_line).unionByName(by_customer)
    return found.where(F.col("order_id").isNotNull()).distinct()


def orders_with_totals(
    orders: DataFrame, order_items: DataFrame, unique_items: bool = False
) -> DataFrame:
    """Every order with its line totals, 0 where it has no lines.

    The grand total stays unknown when shipping, tax or discount is unknown.
    """
    totals = order_line_totals(order_items, unique_items)
    zero = F.lit(0)
    sums = ("items_count", "unique_products_count", "total_quantity", "subtotal_amount")
    joined = orders.join(totals, "order_id", "left").withColumns(
        {name: F.coalesce(name, zero) for name in sums}
    )
    subtotal, items = F.col("subtotal_amount"), F.col("items_count")
    discount = F.col("discount_amount")
    return joined.select(
        *[c for c in orders.columns if c not in ("created_at", "updated_at")],
        *sums,
        (subtotal + F.col("shipping_cost") + F.col("tax_amount") - discount).alias("grand_total"),
        F.when(items > 0, ratio(subtotal, items)).otherwise(0.0).alias("avg_item_value"),
        F.when(subtotal > 0, percent(discount, subtotal)).otherwise(0.0).alias("discount_percentage"),
        F.col("created_at").alias("order_created_at"),
        F.col("updated_at").alias("order_updated_at"),
        day_count(F.col("created_at"), F.col("updated_at")).alias("days_to_fulfill"),
    )


def int_orders_enriched(
    orders: DataFrame,
    order_items: DataFrame,
    customers: DataFrame,
    hot_customers: HotKeys = NO_HOT_KEYS,
    unique_items: bool = False,
) -> DataFrame:
    """One row per order: header, customer attributes, line totals."""
    attributes = customers.select(
        "customer_id",
        "customer_key",
        F.col("full_name").alias("customer_name"),
        F.col("email").alias("customer_email"),
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        F.col("country").alias("customer_country"),
    )
    totals = orders_with_totals(orders, order_items, unique_items)
    joined = skew_join(totals, attributes, "customer_id", "left", hot_customers, spread="order_id")
    lead = ["order_id", "order_key", *attributes.columns]
    return joined.select(*lead, *[c for c in totals.columns if c not in lead])


# The columns of the line table, in the order in which readers expect them.
LINE_COLUMNS = (
    "customer_id customer_key customer_name customer_email city state country "
    "order_id order_key order_date order_date_day order_status is_completed is_cancelled "
    "payment_method shipping_method order_item_id order_item_key "
    "product_id product_key product_name category subcategory brand "
    "quantity unit_price line_total unit_cost line_profit line_profit_margin_pct "
    "shipping_cost tax_amount discount_amount is_line_total_valid transaction_date line_item_created_at"
).split()


def int_customer_orders(
    order_items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    skew: SkewProfile = EVEN,
    small_catalogue: bool | None = None,
) -> DataFrame:
    """One row per line whose product, order and customer are known, with the profit of the line.

    Customers meet the orders first: that join moves orders, not lines. A catalogue measured to be
    small is broadcast to the lines where they are, last, so its texts are never shuffled; a large
    one is joined first, because its columns are narrower than those of order and customer. The
    keys of lines, orders and products follow from their ids, as in staging, so they are hashed after the
    joins and not carried through them.
    The catalogue is measured unless `small_catalogue` says what an earlier measurement found; either
    way the rows and the order of the columns are the same.
    """
    heads = skew_join(
        orders.select(
            "order_id",
            "customer_id",
            "order_date",
            "order_date_day",
            "order_status",
            "is_completed",
            "is_cancelled",
            "payment_method",
            "shipping_method",
            "shipping_cost",
            "tax_amount",
            "discount_amount",
        ),
        customers.select(
            "customer_id",
            "customer_key",
            F.col("full_name").alias("customer_name"),
            F.col("email").alias("customer_email"),
            "city",
            "state",
            "country",
        ),
        "customer_id",
        hot=skew.customers,
        spread="order_id",
    )
    lines = order_items.select(
        "order_item_id",
        "order_id",
        "product_id",
        "quantity",
        "unit_price",
        "line_total",
        "is_line_total_valid",
        F.col("created_at").alias("line_item_created_at"),
    )
    catalogue = products.select(
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "brand",
        "unit_cost",
    )
    if fits_broadcast(catalogue) if small_catalogue is None else small_catalogue:
        placed = skew_join(lines, heads, "order_id", hot=skew.orders, spread="order_item_id")
        joined = placed.join(F.broadcast(catalogue), "product_id")
    else:
        priced = skew_join(lines, catalogue, "product_id", hot=skew.products, spread="order_item_id")
        joined = skew_join(priced, heads, "order_id", hot=skew.orders, spread="order_item_id")
    profit = F.col("line_total") - F.col("unit_cost") * F.col("quantity")
    return joined.withColumns(
        {
            **{f"{name}_key": surrogate_key(F.col(f"{name}_id")) for name in ("order", "order_item", "product")},
            "line_profit": profit,
            "line_profit_margin_pct": percent(profit, F.col("line_total")),
            "transaction_date": F.col("order_date"),
        }
    ).select(*LINE_COLUMNS)


def customer_order_history(orders: DataFrame, unique_orders: bool = False) -> DataFrame:
    """Orders of any status summed up per customer."""
    return orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        count_ids("order_id", unique=unique_orders).alias("total_orders"),
        count_ids("order_id", "is_completed", unique_orders).alias("completed_orders"),
        count_ids("order_id", "is_cancelled", unique_orders).alias("cancelled_orders"),
    )


def dim_customers(
    customers: DataFrame, orders: DataFrame, as_of=None, unique_orders: bool = False
) -> DataFrame:
    """One row per customer as of a day: attributes, order history, two segmentations."""
    history = customer_order_history(orders, unique_orders)
    today = as_of_day(as_of)
    first_age = day_count(F.col("first_order_date"), today)
    last_age = day_count(F.col("last_order_date"), today)
    counts = ("total_orders", "completed_orders", "cancelled_orders")
    joined = customers.join(history, "customer_id", "left").withColumns(
        {name: F.coalesce(name, F.lit(0)) for name in counts}
    )
    return joined.select(
        *[c for c in customers.columns if c not in ("created_at", "updated_at")],
        "first_order_date",
        "last_order_date",
        *counts,
        first_age.alias("days_since_first_order"),
        last_age.alias("days_since_last_order"),
        rules.customer_segment(first_age, last_age).alias("customer_segment"),
        rules.purchase_frequency_segment(F.col("completed_orders")).alias(
            "purchase_frequency_segment"
        ),
        F.col("created_at").alias("customer_created_at"),
        F.col("updated_at").alias("customer_updated_at"),
    )
