"""The same results in plain SQL for DuckDB, written straight from the definitions."""

from __future__ import annotations

from martwright.functions import rules
from verification.queries import (
    AS_OF,
    CUTOFF,
    FIRST_LOOK,
    MONITOR_UNITS,
    MOVED,
    REORDER_UNITS,
    SECOND_LOOK,
    TIERS,
    VELOCITY_BANDS,
)

DAY = f"DATE '{AS_OF}'"


def _round2(value: str) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), 2) AS DOUBLE)"


def _ratio(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0))"


def _pct(top: str, bottom: str) -> str:
    return _round2(f"{_ratio(top, bottom)} * 100")


def _mean(value: str, where: str = "true") -> str:
    return (
        f"CAST(sum({value}) FILTER (WHERE {where}) AS DOUBLE)"
        f" / nullif(count({value}) FILTER (WHERE {where}), 0)"
    )


def _money(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(12,2))"


# A customer that moved has two versions; one that vanished ends with the second look.
_VERSIONS = f"""
        SELECT customer_id, 'old ' || country AS country, TIMESTAMP '{FIRST_LOOK}' AS updated_at,
               TIMESTAMP '{FIRST_LOOK}' AS valid_from,
               if(customer_id % 50 = 9, TIMESTAMP '{SECOND_LOOK}', TIMESTAMP '{MOVED}') AS valid_to
        FROM sc WHERE customer_id % 3 = 0
        UNION ALL
        SELECT customer_id, country, TIMESTAMP '{MOVED}', TIMESTAMP '{MOVED}', NULL
        FROM sc WHERE customer_id % 3 = 0 AND customer_id % 50 <> 9
        UNION ALL
        SELECT customer_id, country, TIMESTAMP '{FIRST_LOOK}', TIMESTAMP '{FIRST_LOOK}',
               if(customer_id % 50 = 9, TIMESTAMP '{SECOND_LOOK}', NULL)
        FROM sc WHERE customer_id % 3 <> 0"""


# Each step reads only steps above it.
STEPS = {
    "raw_customers": """
        SELECT c_custkey AS customer_id, 'Customer' AS first_name, substr(c_name, 10) AS last_name,
               '  Cust' || c_custkey || '@Example.COM ' AS email, n_name AS city, r_name AS state,
               n_name AS country, lpad(c_nationkey::VARCHAR, 5, '0') AS postal_code
        FROM customer, nation, region
        WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey""",
    "raw_orders": f"""
        SELECT o_orderkey AS order_id,
               if(o_custkey % 25 = 3, -1 - o_custkey, o_custkey) AS customer_id,
               o_orderdate AS order_date,
               CASE WHEN o_custkey % 25 = 4 THEN 'Cancelled' WHEN o_orderkey % 97 = 0 THEN ' Completed'
                    WHEN o_orderstatus = 'F' THEN 'Completed'
                    ELSE ['shipped', 'pending', ' processing ', 'Cancelled'][o_orderkey % 4 + 1]
               END AS order_status,
               if(o_orderpriority[1] IN ('1', '2'), ' Express', 'standard') AS shipping_method,
               ['Credit_Card', 'paypal', 'debit_card'][o_orderkey % 3 + 1] AS payment_method,
               {_money("if(o_orderpriority[1] IN ('1', '2'), 12.99, 5.99)")} AS shipping_cost,
               {_money("round(o_totalprice::DECIMAL(12,2) * 0.07::DECIMAL(4,2), 2)")} AS tax_amount,
               {_money("if(o_orderkey % 211 = 7, 9000000, if(o_orderkey % 5 = 0, 10, 0))")} AS discount_amount,
               o_orderdate AS created_at,
               o_orderdate + to_days((o_orderkey % 6)::INTEGER) AS updated_at
        FROM orders""",
    "raw_products": f"""
        SELECT p_partkey AS product_id, ' ' || p_name || ' ' AS product_name, p_type AS category,
               p_type || '/' || p_size % 5 AS subcategory, p_brand AS brand,
               {_money("if(p_partkey % 499 = 0, 0, p_retailprice)")} AS price,
               {_money("round(p_retailprice::DECIMAL(12,2) * if(p_partkey % 97 = 5, -0.60, 0.60)::DECIMAL(4,2), 2)")} AS cost,
               (p_partkey * 37) % 300 AS stock_quantity
        FROM part""",
    "raw_order_items": f"""
        SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity::INTEGER)
                   AS order_item_id,
               l_orderkey AS order_id,
               if(l_partkey % 50 = 7, -1 - l_partkey, l_partkey) AS product_id,
               l_quantity::INTEGER AS quantity, {_money("p_retailprice")} AS unit_price,
               {_money("l_quantity::INTEGER * p_retailprice::DECIMAL(12,2) + (l_linenumber = 7)::INTEGER")}
                   AS line_total,
               l_shipdate AS created_at
        FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "sc": """
        SELECT customer_id,
               md5(coalesce(first_name, '_null_') || '-' || coalesce(last_name, '_null_') || '-'
                   || coalesce(email, '_null_')) AS customer_key,
               first_name, last_name, first_name || ' ' || last_name AS full_name,
               lower(trim(email)) AS email, NULL::VARCHAR AS phone, city, state, country, postal_code,
               TIMESTAMP '1995-01-01' AS created_at, TIMESTAMP '1995-01-01' AS updated_at
        FROM raw_customers""",
    "so": """
        SELECT order_id, md5(order_id::VARCHAR) AS order_key, customer_id, order_date,
               date_trunc('day', order_date)::TIMESTAMP AS order_date_day,
               date_trunc('week', order_date)::TIMESTAMP AS order_week,
               date_trunc('month', order_date)::TIMESTAMP AS order_month,
               date_trunc('quarter', order_date)::TIMESTAMP AS order_quarter,
               date_trunc('year', order_date)::TIMESTAMP AS order_year,
               lower(trim(order_status)) AS order_status,
               list_contains(['completed', 'shipped'], lower(order_status)) AS is_completed,
               lower(order_status) = 'cancelled' AS is_cancelled,
               lower(trim(shipping_method)) AS shipping_method,
               lower(trim(payment_method)) AS payment_method,
               shipping_cost, tax_amount, discount_amount, created_at, updated_at
        FROM raw_orders""",
    "sp": f"""
        SELECT product_id, md5(product_id::VARCHAR) AS product_key, trim(product_name) AS product_name,
               trim(category) AS category, trim(subcategory) AS subcategory, trim(brand) AS brand,
               price AS unit_price, cost AS unit_cost, price - cost AS unit_profit,
               {_pct("price - cost", "price")} AS profit_margin_pct, stock_quantity,
               if(stock_quantity = 0, 'Out of Stock', if(stock_quantity <= 50, 'Low Stock',
                  if(stock_quantity <= 150, 'Medium Stock', 'High Stock'))) AS inventory_status
        FROM raw_products""",
    "si": """
        SELECT *, md5(order_item_id) AS order_item_key, quantity * unit_price AS calculated_line_total,
               abs(line_total - quantity * unit_price) AS line_total_variance,
               abs(line_total - quantity * unit_price) < 0.01 AS is_line_total_valid
        FROM raw_order_items""",
    "totals": """
        SELECT order_id, count(DISTINCT order_item_id) AS items_count,
               count(DISTINCT product_id) AS unique_products_count, sum(quantity)::BIGINT AS total_quantity,
               sum(line_total) AS subtotal_amount, min(created_at) AS first_item_at,
               max(created_at) AS last_item_at
        FROM si GROUP BY ALL""",
    "heads": f"""
        SELECT so.* EXCLUDE (created_at, updated_at), ifnull(items_count, 0) AS items_count,
               ifnull(unique_products_count, 0) AS unique_products_count,
               ifnull(total_quantity, 0) AS total_quantity, ifnull(t.subtotal_amount, 0) AS subtotal_amount,
               ifnull(t.subtotal_amount, 0) + shipping_cost + tax_amount - discount_amount AS grand_total,
               ifnull({_ratio("t.subtotal_amount", "items_count")}, 0) AS avg_item_value,
               if(ifnull(t.subtotal_amount, 0) > 0, {_pct("discount_amount", "t.subtotal_amount")}, 0)
                   AS discount_percentage,
               created_at AS order_created_at, updated_at AS order_updated_at,
               updated_at::DATE - created_at::DATE AS days_to_fulfill
        FROM so LEFT JOIN totals t USING (order_id)""",
    "enriched": """
        SELECT heads.*, customer_key, full_name AS customer_name, email AS customer_email,
               city AS customer_city, state AS customer_state, country AS customer_country
        FROM heads LEFT JOIN sc USING (customer_id)""",
    "history": """
        SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
               count(DISTINCT order_id) AS total_orders,
               count(DISTINCT order_id) FILTER (WHERE is_completed) AS completed_orders,
               count(DISTINCT order_id) FILTER (WHERE is_cancelled) AS cancelled_orders
        FROM so GROUP BY ALL""",
    "dim": f"""
        SELECT sc.* EXCLUDE (created_at, updated_at), first_order_date, last_order_date,
               ifnull(total_orders, 0) AS total_orders, ifnull(completed_orders, 0) AS completed_orders,
               ifnull(cancelled_orders, 0) AS cancelled_orders,
               {DAY} - first_order_date::DATE AS days_since_first_order,
               {DAY} - last_order_date::DATE AS days_since_last_order,
               CASE WHEN total_orders IS NULL THEN 'No Orders'
                    WHEN first_order_date::DATE >= {DAY} - 30 THEN 'New'
                    WHEN last_order_date::DATE >= {DAY} - 90 THEN 'Active'
                    WHEN last_order_date::DATE >= {DAY} - 365 THEN 'At Risk'
                    ELSE 'Churned' END AS customer_segment,
               CASE ifnull(completed_orders, 0) WHEN 0 THEN 'Never Purchased' WHEN 1 THEN 'One-Time Buyer'
                    ELSE if(completed_orders <= 5, 'Occasional Buyer',
                            if(completed_orders <= 10, 'Regular Buyer', 'VIP Buyer'))
               END AS purchase_frequency_segment,
               sc.created_at AS customer_created_at, sc.updated_at AS customer_updated_at
        FROM sc LEFT JOIN history USING (customer_id)""",
    "lines": f"""
        SELECT customer_id, customer_key, full_name AS customer_name, email AS customer_email, city, state,
               country, order_id, order_key, order_date, order_date_day, order_status, is_completed,
               is_cancelled, payment_method, shipping_method, order_item_id, order_item_key, product_id,
               product_key, product_name, category, subcategory, brand, quantity, si.unit_price, line_total,
               unit_cost, line_total - unit_cost * quantity AS line_profit,
               {_pct("line_total - unit_cost * quantity", "line_total")} AS line_profit_margin_pct,
               shipping_cost, tax_amount, discount_amount, is_line_total_valid,
               order_date AS transaction_date, si.created_at AS line_item_created_at
        FROM si JOIN sp USING (product_id) JOIN so USING (order_id) JOIN sc USING (customer_id)""",
    "daily_block": f"""
        SELECT order_date_day AS date_day,
               count(DISTINCT order_id) AS total_orders,
               count(DISTINCT order_id) FILTER (WHERE is_completed) AS completed_orders,
               count(DISTINCT order_id) FILTER (WHERE is_cancelled) AS cancelled_orders,
               count(DISTINCT order_id) FILTER (WHERE order_status = 'pending') AS pending_orders,
               count(DISTINCT order_id) FILTER (WHERE order_status = 'processing') AS processing_orders,
               count(DISTINCT order_id) FILTER (WHERE order_status = 'shipped') AS shipped_orders,
               count(DISTINCT customer_id) AS unique_customers,
               count(DISTINCT customer_id) FILTER (WHERE is_completed) AS active_customers,
               ifnull(sum(subtotal_amount) FILTER (WHERE is_completed), 0) AS gross_revenue,
               ifnull(sum(shipping_cost) FILTER (WHERE is_completed), 0) AS shipping_revenue,
               ifnull(sum(tax_amount) FILTER (WHERE is_completed), 0) AS tax_collected,
               ifnull(sum(discount_amount) FILTER (WHERE is_completed), 0) AS total_discounts,
               ifnull(sum(grand_total) FILTER (WHERE is_completed), 0) AS net_revenue,
               ifnull(sum(items_count) FILTER (WHERE is_completed), 0)::BIGINT AS total_items_sold,
               ifnull(sum(total_quantity) FILTER (WHERE is_completed), 0)::BIGINT AS total_units_sold,
               {_mean("grand_total", "is_completed")} AS avg_order_value,
               {_mean("items_count", "is_completed")} AS avg_items_per_order,
               {_mean("total_quantity", "is_completed")} AS avg_units_per_order,
               count(DISTINCT order_id) FILTER (WHERE is_completed AND payment_method = 'credit_card')
                   AS credit_card_orders,
               count(DISTINCT order_id) FILTER (WHERE is_completed AND payment_method = 'paypal')
                   AS paypal_orders,
               count(DISTINCT order_id) FILTER (WHERE is_completed AND payment_method = 'debit_card')
                   AS debit_card_orders,
               count(DISTINCT order_id) FILTER (WHERE is_completed AND shipping_method = 'standard')
                   AS standard_shipping_orders,
               count(DISTINCT order_id) FILTER (WHERE is_completed AND shipping_method = 'express')
                   AS express_shipping_orders,
               {_mean("days_to_fulfill")} AS avg_days_to_fulfill,
               {_mean("discount_percentage::DECIMAL(20,2)", "is_completed")} AS avg_discount_percentage,
               count(DISTINCT order_id) FILTER (WHERE is_completed AND discount_amount > 0)
                   AS orders_with_discount
        FROM enriched GROUP BY ALL""",
    "daily": f"""
        SELECT *, date_trunc('week', date_day)::TIMESTAMP AS order_week,
               date_trunc('month', date_day)::TIMESTAMP AS order_month,
               date_trunc('quarter', date_day)::TIMESTAMP AS order_quarter,
               date_trunc('year', date_day)::TIMESTAMP AS order_year,
               {_pct("completed_orders", "total_orders")} AS order_completion_rate_pct,
               {_pct("cancelled_orders", "total_orders")} AS order_cancellation_rate_pct,
               {_round2(_ratio("net_revenue", "active_customers"))} AS revenue_per_customer,
               {_pct("orders_with_discount", "completed_orders")} AS discount_penetration_pct,
               {_pct("credit_card_orders", "completed_orders")} AS credit_card_pct,
               {_pct("paypal_orders", "completed_orders")} AS paypal_pct,
               {_pct("debit_card_orders", "completed_orders")} AS debit_card_pct
        FROM daily_block""",
    "baskets": """
        SELECT customer_id, order_id, order_date, any_value(is_completed) AS done,
               any_value(is_cancelled) AS dropped, sum(line_total) AS goods, sum(line_profit) AS profit,
               any_value(discount_amount) AS discount,
               sum(line_total) + any_value(shipping_cost + tax_amount - discount_amount) AS due
        FROM lines GROUP BY customer_id, order_id, order_date""",
    "metrics": f"""
        SELECT customer_id, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT order_id) FILTER (WHERE done) AS completed_orders,
               count(DISTINCT order_id) FILTER (WHERE dropped) AS cancelled_orders,
               ifnull(sum(due) FILTER (WHERE done), 0) AS lifetime_revenue,
               ifnull(sum(goods) FILTER (WHERE done), 0) AS lifetime_gross_revenue,
               ifnull(sum(profit) FILTER (WHERE done), 0) AS lifetime_profit,
               ifnull(sum(discount) FILTER (WHERE done), 0) AS total_discounts_received,
               {_mean("due", "done")} AS avg_order_value,
               min(due) FILTER (WHERE done) AS min_order_value,
               max(due) FILTER (WHERE done) AS max_order_value,
               max(order_date) FILTER (WHERE done) AS last_order_date,
               min(order_date) FILTER (WHERE done) AS first_order_date,
               count(DISTINCT order_id) FILTER (WHERE done) AS purchase_frequency,
               ifnull(sum(due) FILTER (WHERE done), 0) AS monetary_value,
               {_pct("count(DISTINCT order_id) FILTER (WHERE dropped)", "count(DISTINCT order_id)")}
                   AS cancellation_rate_pct
        FROM baskets GROUP BY customer_id""",
    "rfm": f"""
        SELECT *, {DAY} - last_order_date::DATE AS recency_days,
               ntile(5) OVER (ORDER BY {DAY} - last_order_date::DATE NULLS LAST, customer_id) AS recency_score,
               ntile(5) OVER (ORDER BY purchase_frequency, customer_id) AS frequency_score,
               ntile(5) OVER (ORDER BY monetary_value, customer_id) AS monetary_score
        FROM metrics""",
    "clv": f"""
        SELECT d.customer_id, customer_key, full_name, email, city, state, country, customer_segment,
               purchase_frequency_segment, d.first_order_date, d.last_order_date, days_since_first_order,
               days_since_last_order, r.total_orders, r.completed_orders, r.cancelled_orders,
               cancellation_rate_pct, lifetime_revenue, lifetime_gross_revenue, lifetime_profit,
               {_pct("lifetime_profit", "lifetime_revenue")} AS profit_margin_pct,
               total_discounts_received, avg_order_value, min_order_value, max_order_value, recency_days,
               recency_score, frequency_score, monetary_score,
               recency_score + frequency_score + monetary_score AS rfm_total_score,
               lifetime_revenue AS customer_lifetime_value,
               CASE {" ".join(f"WHEN lifetime_revenue >= {floor} THEN '{label}'" for label, floor in TIERS)}
                    WHEN lifetime_revenue > 0 THEN 'Bronze' ELSE 'No Purchase' END AS customer_value_tier,
               CASE WHEN least(recency_score, frequency_score, monetary_score) IS NULL THEN 'Need Attention'
                    WHEN least(recency_score, frequency_score, monetary_score) >= 4 THEN 'Champions'
                    WHEN least(recency_score, frequency_score, monetary_score) = 3 THEN 'Loyal Customers'
                    WHEN frequency_score <= 2 THEN
                        CASE recency_score WHEN 5 THEN 'Promising' WHEN 4 THEN 'Promising'
                             WHEN 3 THEN 'Potential Loyalists' ELSE 'Lost' END
                    ELSE if(recency_score <= 2, 'At Risk', 'Need Attention') END AS rfm_segment
        FROM dim d LEFT JOIN rfm r USING (customer_id)""",
    "sold": f"""
        SELECT product_id, count(DISTINCT order_id) AS orders_count, sum(quantity)::BIGINT AS total_units_sold,
               sum(line_total) AS total_revenue, {_mean("line_total")} AS avg_line_revenue,
               sum(line_profit) AS total_profit, {_mean("line_profit")} AS avg_line_profit,
               min(order_date) AS first_sale_date, max(order_date) AS last_sale_date,
               count(DISTINCT order_date_day) AS days_with_sales
        FROM lines WHERE is_completed GROUP BY product_id""",
    "places": """
        SELECT product_id, row_number() OVER (ORDER BY total_revenue DESC, product_id) AS revenue_rank,
               row_number() OVER (ORDER BY total_profit DESC, product_id) AS profit_rank,
               row_number() OVER (ORDER BY total_units_sold DESC, product_id) AS volume_rank
        FROM sold""",
    "perf": f"""
        SELECT sp.*, ifnull(orders_count, 0) AS orders_count, ifnull(total_units_sold, 0) AS total_units_sold,
               ifnull(total_revenue, 0) AS total_revenue, ifnull(avg_line_revenue, 0) AS avg_line_revenue,
               ifnull(total_profit, 0) AS total_profit, ifnull(avg_line_profit, 0) AS avg_line_profit,
               {_pct("total_profit", "total_revenue")} AS actual_profit_margin_pct,
               CASE WHEN s.product_id IS NULL THEN 'Never Sold'
                    {" ".join(f"WHEN s.total_units_sold >= {u} THEN '{label}'" for label, u in VELOCITY_BANDS)}
                    ELSE 'Slow Mover' END AS sales_velocity,
               CASE WHEN stock_quantity = 0 THEN 'Out of Stock'
                    WHEN s.product_id IS NULL THEN 'Overstock Risk'
                    WHEN stock_quantity <= 50 AND s.total_units_sold >= {REORDER_UNITS} THEN 'Reorder Soon'
                    WHEN stock_quantity <= 100 AND s.total_units_sold >= {MONITOR_UNITS} THEN 'Monitor Stock'
                    ELSE 'Healthy' END AS inventory_health,
               first_sale_date, last_sale_date, ifnull(days_with_sales, 0) AS days_with_sales,
               last_sale_date::DATE - first_sale_date::DATE + 1 AS days_on_market,
               revenue_rank, profit_rank, volume_rank,
               ifnull({_round2("1000 * (0.4::DOUBLE / revenue_rank + 0.4::DOUBLE / profit_rank + 0.2::DOUBLE / volume_rank)")}, 0)
                   AS performance_score,
               ifnull(revenue_rank < 6, false) AS is_top_revenue_product,
               ifnull(profit_rank < 6, false) AS is_top_profit_product,
               ifnull(volume_rank < 6, false) AS is_top_volume_product
        FROM sp LEFT JOIN sold s USING (product_id) LEFT JOIN places USING (product_id)""",
}


def _check(table: str, column: str, kind: str, failures: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{column}' AS \"column\", '{kind}' AS \"check\", "
        f"({failures})::BIGINT AS failures, 'warn' AS severity"
    )


def _twice(table: str, column: str, step: str) -> str:
    inner = f"SELECT {column} FROM {step} GROUP BY {column} HAVING count({column}) > 1"
    return _check(table, column, "unique", f"SELECT count(*) FROM ({inner})")


def _missing(table: str, column: str, step: str) -> str:
    inner = f"SELECT count(*) - count({column}) FROM {step}"
    return _check(table, column, "not_null", inner)


def _outside(table: str, column: str, step: str, values: str) -> str:
    inner = f"SELECT count(*) FROM {step} WHERE {column} NOT IN ({values})"
    return _check(table, column, "accepted_values", inner)


_ALL_STATUSES = "'pending', 'processing', 'shipped', 'completed', 'cancelled'"
_SEGMENTS = "'No Orders', 'New', 'Active', 'At Risk', 'Churned'"


def _labels(*values: str) -> str:
    return ", ".join(f"'{v}'" for v in values)


_FREQUENCIES = _labels(*[label for label, _ in rules.FREQUENCY_BANDS], rules.FREQUENCY_ABOVE)
_RFM = _labels(*[label for label, *_ in rules.RFM_SEGMENTS], rules.RFM_OTHER)
_TIERS = _labels(*[label for label, _ in rules.VALUE_TIERS], rules.TIER_ABOVE_ZERO, rules.TIER_NONE)
_VELOCITIES = _labels(
    rules.VELOCITY_NEVER, rules.VELOCITY_BELOW, *[label for label, _ in rules.VELOCITY_BANDS]
)
_HEALTH = _labels(*rules.INVENTORY_HEALTH)

FINAL = {
    "stg_customers": "SELECT * FROM sc",
    "stg_orders": "SELECT * FROM so",
    "stg_products": "SELECT *, TIMESTAMP '1995-01-01' AS created_at, TIMESTAMP '1995-01-01' AS updated_at FROM sp",
    "stg_order_items": "SELECT * FROM si",
    "int_orders_enriched": "SELECT * FROM enriched",
    "int_orders_enriched_salted": "SELECT * FROM enriched",
    "int_customer_orders": "SELECT * FROM lines",
    "dim_customers": "SELECT * FROM dim",
    "mart_sales_daily": "SELECT * FROM daily",
    "mart_customer_lifetime_value": "SELECT * FROM clv",
    "mart_product_performance": "SELECT * FROM perf",
    "revenue_trend": f"""
        SELECT date_day, net_revenue, {_mean("net_revenue").replace(" FILTER (WHERE true)", " OVER w")}
                   AS revenue_7day_ma,
               {_round2(_ratio("net_revenue - lag(net_revenue, 7) OVER (ORDER BY date_day)",
                               "lag(net_revenue, 7) OVER (ORDER BY date_day)") + " * 100")} AS wow_growth_pct,
               total_orders, avg_order_value
        FROM daily WHERE date_day >= {DAY} - 30
        WINDOW w AS (ORDER BY date_day ROWS 6 PRECEDING)""",
    "report_last_days": "SELECT * FROM daily ORDER BY date_day DESC LIMIT 7",
    "report_tier_segment": """
        SELECT customer_value_tier, rfm_segment, count(*) AS customers, sum(lifetime_revenue) AS total_revenue
        FROM clv GROUP BY ALL""",
    "report_tier_segment_rounded": """
        SELECT customer_value_tier, rfm_segment, count(*) AS customers, sum(lifetime_revenue) AS total_revenue
        FROM clv GROUP BY ALL""",
    "report_top_products": "SELECT * FROM perf WHERE is_top_revenue_product",
    "join_left_orders_items": """
        SELECT order_id, customer_id, order_status, items_count, subtotal_amount, full_name
        FROM so LEFT JOIN totals USING (order_id) LEFT JOIN sc USING (customer_id)""",
    "join_inner_lines": """
        SELECT order_item_id, order_id, product_id, customer_id, category, country, quantity
        FROM si JOIN sp USING (product_id) JOIN so USING (order_id) JOIN sc USING (customer_id)""",
    "join_inner_lines_salted": """
        SELECT order_item_id, order_id, product_id, customer_id, category, country, quantity
        FROM si JOIN sp USING (product_id) JOIN so USING (order_id) JOIN sc USING (customer_id)""",
    "join_left_customer_orders": """
        SELECT history.* REPLACE (sc.customer_id AS customer_id), full_name
        FROM sc LEFT JOIN history ON sc.customer_id = history.customer_id""",
    "agg_order_items": "SELECT * FROM totals",
    "agg_customer_orders": "SELECT * FROM history",
    "agg_customer_metrics": "SELECT * FROM metrics",
    "agg_product_metrics": "SELECT * FROM sold",
    "agg_daily": "SELECT * FROM daily_block",
    "rfm_ntile": """
        SELECT customer_id, recency_days, purchase_frequency, monetary_value, recency_score,
               frequency_score, monetary_score
        FROM rfm""",
    "product_rank": "SELECT * FROM places",
    "moving_avg": f"""
        SELECT date_day, net_revenue, {_mean("net_revenue").replace(" FILTER (WHERE true)", " OVER w")}
                   AS revenue_7day_ma
        FROM daily WINDOW w AS (ORDER BY date_day ROWS 6 PRECEDING)""",
    "wow_growth": f"""
        WITH paired AS (SELECT date_day, net_revenue, lag(net_revenue, 7) OVER (ORDER BY date_day) AS before
                        FROM daily)
        SELECT date_day, net_revenue, {_round2(_ratio("net_revenue - before", "before") + " * 100")}
                   AS wow_growth_pct
        FROM paired""",
    # An incremental run must end where one full build ends.
    "merge_orders": "SELECT * FROM enriched",
    "merge_orders_propagated": "SELECT * FROM enriched",
    "merge_sales_daily": "SELECT * FROM daily",
    # Every day of the period and the week before it, with zeros where there was nothing.
    "revenue_trend_dense": f"""
        WITH spine AS (
            SELECT unnest(generate_series({DAY} - 37, {DAY}, INTERVAL 1 DAY))::DATE AS date_day),
        filled AS (
            SELECT date_day, coalesce(net_revenue, 0) AS net_revenue, coalesce(total_orders, 0) AS total_orders,
                   avg_order_value
            FROM spine LEFT JOIN (SELECT * FROM daily WHERE dayofmonth(date_day) % 5 <> 2) USING (date_day))
        SELECT a.date_day::TIMESTAMP AS date_day, a.net_revenue,
               (SELECT CAST(sum(b.net_revenue) AS DOUBLE) / 7 FROM filled b
                WHERE b.date_day BETWEEN a.date_day - 6 AND a.date_day) AS revenue_7day_ma,
               {_round2(_ratio("a.net_revenue - w.net_revenue", "w.net_revenue") + " * 100")} AS wow_growth_pct,
               a.total_orders, a.avg_order_value
        FROM filled a JOIN filled w ON w.date_day = a.date_day - 7
        WHERE a.date_day >= {DAY} - 30""",
    "report_product_preview": """
        SELECT product_name, category, total_revenue, revenue_rank, sales_velocity, inventory_health
        FROM perf ORDER BY revenue_rank NULLS LAST, product_id LIMIT 10""",
    "customer_versions": _VERSIONS,
    # Ranges of one customer do not overlap, so an order meets one version at most.
    "orders_as_of_customer": f"""
        SELECT order_id, so.customer_id, order_date, country, valid_from, valid_to
        FROM so LEFT JOIN ({_VERSIONS}) v
          ON v.customer_id = so.customer_id AND valid_from <= order_date
         AND (valid_to IS NULL OR valid_to > order_date)""",
    # Every change of an order in the order of time; each version ends where the next begins.
    "order_status_history": f"""
        WITH known AS (
            SELECT order_id, if(updated_at >= DATE '{CUTOFF}', 'pending', order_status) AS order_status,
                   if(updated_at >= DATE '{CUTOFF}', created_at, updated_at) AS moment
            FROM so WHERE order_date_day < DATE '{CUTOFF}'),
        later AS (
            SELECT order_id, order_status, updated_at AS moment FROM so
            UNION ALL
            SELECT order_id, 'placed', created_at FROM so WHERE order_id % 3 = 0 AND updated_at > created_at),
        versions AS (
            SELECT * FROM known
            UNION ALL
            SELECT later.* FROM later LEFT JOIN known USING (order_id)
            WHERE known.moment IS NULL OR later.moment > known.moment)
        SELECT order_id, order_status, moment AS updated_at, moment AS valid_from,
               lead(moment) OVER (PARTITION BY order_id ORDER BY moment) AS valid_to
        FROM versions""",
    "compare_order_states": f"""
        SELECT if(order_date_day >= DATE '{CUTOFF}', 'only_right',
                  if(updated_at >= DATE '{CUTOFF}', 'different', 'identical')) AS status, count(*) AS keys
        FROM so GROUP BY ALL""",
    "reconcile_orders": f"""
        WITH old AS (
            SELECT *, updated_at >= DATE '{CUTOFF}' AS stale FROM so WHERE order_date_day < DATE '{CUTOFF}'),
        before AS (
            SELECT order_id, if(stale, 'pending', order_status) AS order_status,
                   is_cancelled AND NOT stale AS is_cancelled,
                   if(stale, created_at, updated_at) AS updated_at, customer_id, discount_amount FROM old),
        later AS (SELECT * FROM so WHERE order_id % 97 <> 5),
        pairs AS (SELECT b, l FROM before b JOIN later l USING (order_id))
        SELECT 'only_left' AS difference, count(*) AS keys FROM before WHERE order_id % 97 = 5
        UNION ALL SELECT 'only_right', count(*) FROM later WHERE order_date_day >= DATE '{CUTOFF}'
        UNION ALL SELECT 'repeated', 0
        """
    + " ".join(
        f"UNION ALL SELECT '{c}', count(*) FROM pairs WHERE b.{c} IS DISTINCT FROM l.{c}"
        for c in ("order_status", "is_cancelled", "updated_at", "customer_id", "discount_amount")
    ),
    "reconcile_equal": """
        SELECT difference, 0::BIGINT AS keys FROM (SELECT unnest(
            ['only_left', 'only_right', 'repeated', 'order_key', 'customer_id', 'order_date', 'order_date_day',
             'order_week', 'order_month', 'order_quarter', 'order_year', 'order_status', 'is_completed', 'is_cancelled',
             'shipping_method', 'payment_method', 'shipping_cost', 'tax_amount', 'discount_amount', 'created_at',
             'updated_at']) AS difference)""",
    **{
        f"agg_{unit}ly_from_daily": f"""
            SELECT date_trunc('{unit}', order_date_day)::TIMESTAMP AS order_{unit},
                   count(DISTINCT customer_id) AS unique_customers,
                   count(DISTINCT customer_id) FILTER (WHERE is_completed) AS active_customers
            FROM enriched GROUP BY 1"""
        for unit in ("week", "month")
    },
    "check_unique": " UNION ALL ".join(
        [
            _twice("stg_customers", "customer_id", "sc"),
            _twice("stg_orders", "order_id", "so"),
            _twice("stg_order_items", "order_item_id", "si"),
            _twice("stg_order_items", "order_id", "si"),
            _twice("stg_products", "product_id", "sp"),
            _twice("stg_products", "category", "sp"),
        ]
    ),
    "check_not_null": " UNION ALL ".join(
        [_missing("stg_customers", c, "sc") for c in ("customer_id", "email", "phone")]
        + [_missing("stg_orders", c, "so") for c in ("order_id", "customer_id", "order_status")]
        + [_missing("stg_products", c, "sp") for c in ("product_name", "profit_margin_pct")]
        + [_missing("dim_customers", c, "dim") for c in ("customer_segment", "first_order_date")]
    ),
    "check_relationships": """
        SELECT product_id AS value, count(*) AS n_records, 'order_items' AS child
        FROM si WHERE product_id NOT IN (SELECT product_id FROM sp) GROUP BY product_id
        UNION ALL
        SELECT customer_id, count(*), 'orders'
        FROM so WHERE customer_id NOT IN (SELECT customer_id FROM sc) GROUP BY customer_id""",
    "check_accepted_values": " UNION ALL ".join(
        [
            _outside("stg_orders", "order_status", "so", _ALL_STATUSES),
            _outside("stg_orders", "order_status", "so", "'completed', 'shipped'"),
            _outside("stg_orders", "shipping_method", "so", "'standard'"),
            _outside("dim_customers", "customer_segment", "dim", _SEGMENTS),
            _outside("dim_customers", "purchase_frequency_segment", "dim", "'Never Purchased'"),
        ]
    ),
    "check_declared_silver": " UNION ALL ".join(
        [
            _twice("int_orders_enriched", "order_id", "enriched"),
            *[_missing("int_orders_enriched", c, "enriched") for c in ("order_id", "customer_id", "grand_total")],
            _check(
                "int_orders_enriched",
                "customer_id",
                "relationships",
                "SELECT count(*) FROM enriched WHERE customer_id NOT IN (SELECT customer_id FROM dim)",
            ),
            _outside("int_orders_enriched", "order_status", "enriched", _ALL_STATUSES),
            _twice("int_customer_orders", "order_item_id", "lines"),
            *[
                _missing("int_customer_orders", c, "lines")
                for c in ("order_item_id", "customer_id", "is_line_total_valid")
            ],
            _twice("dim_customers", "customer_id", "dim"),
            *[_missing("dim_customers", c, "dim") for c in ("customer_id", "email", "customer_segment")],
            _outside("dim_customers", "customer_segment", "dim", _SEGMENTS),
            _outside("dim_customers", "purchase_frequency_segment", "dim", _FREQUENCIES),
        ]
    ),
    "check_declared_gold": " UNION ALL ".join(
        [
            _twice("mart_sales_daily", "date_day", "daily"),
            *[_missing("mart_sales_daily", c, "daily") for c in ("date_day", "net_revenue", "total_orders")],
            _twice("mart_customer_lifetime_value", "customer_id", "clv"),
            *[
                _missing("mart_customer_lifetime_value", c, "clv")
                for c in ("customer_id", "customer_lifetime_value", "rfm_segment")
            ],
            _outside("mart_customer_lifetime_value", "rfm_segment", "clv", _RFM),
            _outside("mart_customer_lifetime_value", "customer_value_tier", "clv", _TIERS),
            _twice("mart_product_performance", "product_id", "perf"),
            *[
                _missing("mart_product_performance", c, "perf")
                for c in ("product_id", "product_name", "total_revenue", "total_profit")
            ],
            _outside("mart_product_performance", "sales_velocity", "perf", _VELOCITIES),
            _outside("mart_product_performance", "inventory_health", "perf", _HEALTH),
        ]
    ),
    "check_positive_totals": """
        SELECT order_id, customer_id, order_date, grand_total,
               'Grand total must be positive for completed orders' AS validation_error
        FROM enriched WHERE is_completed AND grand_total <= 0""",
    "check_profit_le_revenue": """
        SELECT product_id, product_name, total_revenue, total_profit,
               'Profit cannot exceed revenue' AS validation_error
        FROM perf WHERE total_revenue > 0 AND total_profit > total_revenue""",
    "cents_to_dollars": """
        SELECT o_orderkey AS order_id, cents, round(cents::DECIMAL(28,4) / 100, 2) AS dollars,
               round(round(cents::DECIMAL(28,4) / 100, 2)::DECIMAL(18,2), 1) AS dollars_1_digit,
               round(round(cents::DECIMAL(28,4) / 100, 2)::DECIMAL(18,2), 0) AS whole_dollars
        FROM (SELECT o_orderkey, (o_totalprice::DECIMAL(12,2) * 100)::BIGINT AS cents FROM orders)""",
}


# Exact inside the steps; shown as doubles, because other engines give sums other widths.
_HEADS = "shipping_cost tax_amount discount_amount"
_ORDER = f"{_HEADS} subtotal_amount grand_total"
_DAILY = "gross_revenue shipping_revenue tax_collected total_discounts net_revenue"
_METRICS = (
    "lifetime_revenue lifetime_gross_revenue lifetime_profit total_discounts_received "
    "min_order_value max_order_value"
)
_PRODUCT = "unit_price unit_cost unit_profit"
MONEY_COLUMNS = {
    "stg_orders": _HEADS,
    "stg_products": _PRODUCT,
    "stg_order_items": "unit_price line_total calculated_line_total line_total_variance",
    "int_orders_enriched": _ORDER,
    "int_orders_enriched_salted": _ORDER,
    "int_customer_orders": f"{_HEADS} unit_price line_total unit_cost line_profit",
    "mart_sales_daily": _DAILY,
    "mart_customer_lifetime_value": f"{_METRICS} customer_lifetime_value",
    "mart_product_performance": f"{_PRODUCT} total_revenue total_profit",
    "revenue_trend": "net_revenue",
    "report_last_days": _DAILY,
    "report_tier_segment": "total_revenue",
    "report_tier_segment_rounded": "total_revenue",
    "report_top_products": f"{_PRODUCT} total_revenue total_profit",
    "join_left_orders_items": "subtotal_amount",
    "agg_order_items": "subtotal_amount",
    "agg_customer_metrics": f"{_METRICS} monetary_value",
    "agg_product_metrics": "total_revenue total_profit",
    "agg_daily": _DAILY,
    "rfm_ntile": "monetary_value",
    "moving_avg": "net_revenue",
    "wow_growth": "net_revenue",
    "merge_orders": _ORDER,
    "merge_orders_propagated": _ORDER,
    "revenue_trend_dense": "net_revenue",
    "report_product_preview": "total_revenue",
    "merge_sales_daily": _DAILY,
    "check_positive_totals": "grand_total",
    "check_profit_le_revenue": "total_revenue total_profit",
    "cents_to_dollars": "dollars dollars_1_digit whole_dollars",
}


def _statement(name: str) -> str:
    steps = ",\n".join(f"{step} AS ({body})" for step, body in STEPS.items())
    shown = [f"{c}::DOUBLE AS {c}" for c in MONEY_COLUMNS.get(name, "").split()]
    if name in ("stg_order_items", "int_customer_orders", "join_inner_lines", "join_inner_lines_salted"):
        shown.append("quantity::BIGINT AS quantity")
    replaced = f" REPLACE ({', '.join(shown)})" if shown else ""
    return f"WITH {steps},\nresult AS ({FINAL[name]})\nSELECT *{replaced} FROM result"


def oracle_sql() -> dict[str, str]:
    return {name: _statement(name) for name in FINAL}
