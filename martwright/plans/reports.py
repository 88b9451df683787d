"""Reports over the gold marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from martwright.functions.columns import as_of_day, ratio, round_half_up


def by_day() -> WindowSpec:
    """Days in order. One row per calendar day: small however large the orders grow."""
    return Window.orderBy(F.col("date_day").asc_nulls_last())


def moving_average(value: Column, rows: int = 7) -> Column:
    """Average of this row and the rows - 1 before it."""
    frame = by_day().rowsBetween(1 - rows, 0)
    return ratio(F.sum(value).over(frame), F.count(value).over(frame))


def growth_percent(value: Column, rows: int = 7) -> Column:
    """Change against the row `rows` earlier; a missing day stretches the distance."""
    before = F.lag(value, rows).over(by_day())
    return round_half_up(ratio(value - before, before) * 100)


def revenue_trend(daily: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Recent days, latest first, with a moving average and the growth on the week before.

    Days before the period are cut off first, so its first seven rows have no growth.
    """
    recent = daily.where(F.col("date_day") >= F.date_sub(as_of_day(as_of), days))
    revenue = F.col("net_revenue")
    return recent.select(
        "date_day",
        revenue,
        moving_average(revenue).alias("revenue_7day_ma"),
        growth_percent(revenue).alias("wow_growth_pct"),
        "total_orders",
        "avg_order_value",
    ).orderBy(F.col("date_day").desc_nulls_first())


def revenue_trend_dense(daily: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Every calendar day of a period, latest first, with moving average and growth counted in days.

    Days without orders are there with revenue and orders of 0. Averages take the seven days up to a
    day, growth compares with the day a week before; both reach back behind the period. The spine has
    one row per day of the period and a week, made from the two dates alone; its windows range over days.
    """
    last = as_of_day(as_of)
    spine = daily.sparkSession.range(1).select(
        F.explode(F.sequence(F.date_sub(last, days + 7), last)).alias("date_day")
    )
    recent = daily.where(F.col("date_day").between(F.date_sub(last, days + 7), last))
    known = recent.select("date_day", "net_revenue", "total_orders", "avg_order_value")
    filled = spine.join(known, "date_day", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("net_revenue", "total_orders")}
    )
    day = Window.orderBy(F.unix_date("date_day"))
    revenue = F.col("net_revenue")
    week = day.rangeBetween(-6, 0)
    before = F.max(revenue).over(day.rangeBetween(-7, -7))
    return (
        filled.select(
            "date_day",
            revenue,
            ratio(F.sum(revenue).over(week), F.count(revenue).over(week)).alias("revenue_7day_ma"),
            round_half_up(ratio(revenue - before, before) * 100).alias("wow_growth_pct"),
            "total_orders",
            "avg_order_value",
        )
        .where(F.col("date_day") >= F.date_sub(last, days))
        .orderBy(F.col("date_day").desc())
    )


def last_days(daily: DataFrame, days: int = 7) -> DataFrame:
    """The latest rows of the daily mart."""
    return daily.orderBy(F.col("date_day").desc_nulls_first()).limit(days)


def by_tier_and_segment(lifetime_value: DataFrame, rounded: bool = False) -> DataFrame:
    """Customers and revenue per value tier and RFM segment, largest revenue first."""
    revenue = F.sum("lifetime_revenue")
    return (
        lifetime_value.groupBy("customer_value_tier", "rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            (F.round(revenue, 2) if rounded else revenue).alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first())
    )


def top_products(performance: DataFrame) -> DataFrame:
    """The products with the highest revenue, best first."""
    return performance.where(F.col("is_top_revenue_product")).orderBy("revenue_rank")


def preview(df: DataFrame, rows: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """A few rows: the first ones by some columns, or whichever come first."""
    return (df.orderBy(*by) if by else df).limit(rows)


# The columns of the short product report.
PRODUCT_COLUMNS = ("product_name", "category", "total_revenue", "revenue_rank", "sales_velocity", "inventory_health")


def product_report(performance: DataFrame, rows: int = 10) -> DataFrame:
    """The short product report: the products of the highest revenue, best first."""
    return preview(performance, rows, [F.col("revenue_rank").asc_nulls_last(), "product_id"]).select(*PRODUCT_COLUMNS)
