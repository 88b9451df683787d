import datetime as dt

from conftest import rows

from martwright.plans import checks


def test_completed_orders_must_bring_in_money(spark):
    day = dt.datetime(2024, 1, 1)
    data = [
        (1, 1, True, "0.00"),
        (2, 1, True, "-5.00"),
        (3, 1, True, "0.01"),
        (4, 1, False, "-5.00"),
        (5, 1, True, None),
    ]
    orders = spark.createDataFrame(
        [(i, c, done, total, day) for i, c, done, total in data],
        "order_id int, customer_id int, is_completed boolean, grand_total string, order_date timestamp_ntz",
    )
    failing = checks.positive_order_totals(
        orders.selectExpr("* except (grand_total)", "cast(grand_total as decimal(12,2)) as grand_total")
    )
    message = "Grand total must be positive for completed orders"
    assert rows(failing, "order_id", "validation_error") == [(1, message), (2, message)]


def test_profit_must_stay_within_revenue(spark):
    products = spark.createDataFrame(
        [(1, "a", 10.0, 10.01), (2, "b", 10.0, 10.0), (3, "c", 0.0, 1.0), (4, "d", 10.0, -1.0)],
        "product_id int, product_name string, total_revenue double, total_profit double",
    )
    failing = checks.profit_within_revenue(products)
    assert rows(failing, "product_id", "validation_error") == [(1, "Profit cannot exceed revenue")]
