import pytest
from pyspark.sql import functions as F

from martwright.functions import rules


def labels(spark, schema, data, column):
    """The column's value for each row, in the order given."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_inventory_status(spark):
    values = [None, -1, 0, 1, 50, 51, 150, 151]
    found = labels(spark, "s int", [(v,) for v in values], rules.inventory_status(F.col("s")))
    low, medium, high = "Low Stock", "Medium Stock", "High Stock"
    assert found == [high, low, "Out of Stock", low, low, medium, medium, high]


def test_status_flags_do_not_trim(spark):
    values = [(" COMPLETED ",), ("Shipped",), ("completed",), ("CANCELLED",), (None,), ("pending",)]
    done = labels(spark, "s string", values, rules.is_completed(F.col("s")))
    assert done == [False, True, True, False, False, False]
    gone = labels(spark, "s string", values, rules.is_cancelled(F.col("s")))
    assert gone == [False, False, False, True, False, False]


def test_customer_segment(spark):
    ages = [(None, None), (0, 0), (30, 30), (31, 31), (400, 90), (400, 91), (400, 365), (400, 366)]
    found = labels(
        spark, "f int, l int", ages, rules.customer_segment(F.col("f"), F.col("l"))
    )
    assert found == [
        "No Orders", "New", "New", "Active", "Active", "At Risk", "At Risk", "Churned",
    ]


def test_purchase_frequency(spark):
    found = labels(
        spark,
        "n long",
        [(n,) for n in (0, 1, 2, 5, 6, 10, 11)],
        rules.purchase_frequency_segment(F.col("n")),
    )
    occasional, regular = "Occasional Buyer", "Regular Buyer"
    assert found == [
        "Never Purchased", "One-Time Buyer", occasional, occasional, regular, regular, "VIP Buyer",
    ]


def test_value_tier(spark):
    values = [None, "0", "0.01", "249.99", "250", "499.99", "500", "999.99", "1000"]
    column = rules.customer_value_tier(F.col("v").cast("decimal(12,2)"))
    assert labels(spark, "v string", [(v,) for v in values], column) == [
        "No Purchase", "No Purchase", "Bronze", "Bronze", "Silver", "Silver", "Gold", "Gold", "Platinum",
    ]


def segment(r, f, m):
    """The segment rules once more, in Python."""
    if None in (r, f, m):
        return "Need Attention"
    if min(r, f, m) >= 4:
        return "Champions"
    if min(r, f, m) >= 3:
        return "Loyal Customers"
    if f <= 2:
        return {5: "Promising", 4: "Promising", 3: "Potential Loyalists"}.get(r, "Lost")
    return "At Risk" if r <= 2 else "Need Attention"


def test_rfm_segment_for_every_score(spark):
    scores = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    scores.append((None, None, None))
    found = labels(
        spark, "r int, f int, m int", scores, rules.rfm_segment(*[F.col(c) for c in "rfm"])
    )
    assert found == [segment(*s) for s in scores]


def test_velocity_and_health(spark):
    stocks, units = (None, -1, 0, 1, 50, 51, 100, 101), (None, 1, 2, 5, 10)
    grid = [(s, u) for s in stocks for u in units]
    pace = labels(spark, "s int, u int", grid, rules.sales_velocity(F.col("u")))
    by_units = dict(
        zip(units, ["Never Sold", "Slow Mover", "Moderate Seller", "Good Seller", "Best Seller"])
    )
    assert pace == [by_units[u] for _, u in grid]

    def health(s, u):
        if s is None:
            return "Healthy"
        if s == 0:
            return "Out of Stock"
        if u is None:
            return "Overstock Risk" if s > 0 else "Healthy"
        if s <= 50 and u >= 10:
            return "Reorder Soon"
        return "Monitor Stock" if s <= 100 and u >= 5 else "Healthy"

    found = labels(spark, "s int, u int", grid, rules.inventory_health(F.col("s"), F.col("u")))
    assert found == [health(s, u) for s, u in grid]


@pytest.mark.parametrize("ranks, score", [((1, 1, 1), 1000.0), ((3, 7, 6), 223.81), ((None,) * 3, 0.0)])
def test_performance_score(spark, ranks, score):
    schema = "r int, p int, v int"
    column = rules.performance_score(*[F.col(c) for c in "rpv"])
    assert labels(spark, schema, [ranks], column) == [score]


def test_top_flags_are_never_null(spark):
    found = labels(spark, "r int", [(1,), (5,), (6,), (None,)], rules.is_top(F.col("r")))
    assert found == [True, True, False, False]
