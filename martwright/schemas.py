"""Schemas of the four raw tables as DDL. Stated, never inferred: a postal code keeps its leading zero."""

from __future__ import annotations

RAW_CUSTOMERS = (
    "customer_id BIGINT, first_name STRING, last_name STRING, email STRING, phone STRING, "
    "city STRING, state STRING, country STRING, postal_code STRING, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)

RAW_ORDERS = (
    "order_id BIGINT, customer_id BIGINT, order_date TIMESTAMP_NTZ, order_status STRING, "
    "shipping_method STRING, payment_method STRING, shipping_cost DECIMAL(12,2), "
    "tax_amount DECIMAL(12,2), discount_amount DECIMAL(12,2), "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)

RAW_PRODUCTS = (
    "product_id BIGINT, product_name STRING, category STRING, subcategory STRING, brand STRING, "
    "price DECIMAL(12,2), cost DECIMAL(12,2), stock_quantity INT, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)

RAW_ORDER_ITEMS = (
    "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
    "unit_price DECIMAL(12,2), line_total DECIMAL(12,2), created_at TIMESTAMP_NTZ"
)

RAW_SCHEMAS = {
    "raw_customers": RAW_CUSTOMERS,
    "raw_orders": RAW_ORDERS,
    "raw_products": RAW_PRODUCTS,
    "raw_order_items": RAW_ORDER_ITEMS,
}
