"""Every model, operator and report over the star-schema tables, one entry per query."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import rules
from martwright.functions.columns import cents_to_dollars
from martwright.operators import history, materialize, merge, quality, reconcile, tables
from martwright.operators.skew import find_hot_keys, skew_join
from martwright.plans import checks, gold, reports, silver, staging
from martwright.plans.skew_profile import SkewProfile
from martwright.session import apply_settings
from martwright.sources import star

# The day after the last order, so results do not depend on the clock.
AS_OF = dt.date(2001, 8, 2)
# First day the incremental runs have not seen yet.
CUTOFF = dt.date(2001, 6, 1)
LOOKBACK_DAYS = 3

# Orders in these tables are about a thousand times larger than the rules' defaults expect.
TIERS = (("Platinum", 1_500_000), ("Gold", 1_000_000), ("Silver", 500_000))
VELOCITY_BANDS = (("Best Seller", 500), ("Good Seller", 400), ("Moderate Seller", 300))
REORDER_UNITS, MONITOR_UNITS = 500, 400
# So many shuffle partitions that most keys of the test tables count as heavy.
SALTED_PARTITIONS = 5_000


def comparable(df: DataFrame) -> DataFrame:
    """One type per kind of value: bigint, double, timestamp. Other engines have other widths."""
    casts = {
        T.DecimalType: "double",
        T.FloatType: "double",
        T.IntegerType: "bigint",
        T.ShortType: "bigint",
        T.DateType: "timestamp_ntz",
    }
    return df.select(
        *[
            F.col(f.name).cast(casts[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in casts
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


class Retail:
    """The models over one data folder; each frame is built when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.folder = folder

    @cached_property
    def line_skew(self) -> dict:
        lines = star.table(self.spark, self.folder, "lineitem")
        return find_hot_keys(lines, "l_partkey", "l_orderkey")

    @cached_property
    def hot_customers(self):
        return find_hot_keys(self.raw_orders, "customer_id")["customer_id"]

    @property
    def skew(self) -> SkewProfile:
        return SkewProfile(
            self.line_skew["l_partkey"], self.line_skew["l_orderkey"], self.hot_customers
        )

    @cached_property
    def raw_orders(self) -> DataFrame:
        return star.raw_orders(self.spark, self.folder)

    @cached_property
    def customers(self) -> DataFrame:
        return staging.stg_customers(star.raw_customers(self.spark, self.folder))

    @cached_property
    def orders(self) -> DataFrame:
        return staging.stg_orders(self.raw_orders)

    @cached_property
    def products(self) -> DataFrame:
        return staging.stg_products(star.raw_products(self.spark, self.folder))

    @cached_property
    def order_items(self) -> DataFrame:
        hot_parts = self.line_skew["l_partkey"]
        return staging.stg_order_items(star.raw_order_items(self.spark, self.folder, hot_parts))

    @cached_property
    def enriched(self) -> DataFrame:
        return silver.int_orders_enriched(
            self.orders, self.order_items, self.customers, self.hot_customers
        )

    @cached_property
    def customer_orders(self) -> DataFrame:
        return silver.int_customer_orders(
            self.order_items, self.products, self.orders, self.customers, self.skew
        )

    @cached_property
    def dimension(self) -> DataFrame:
        return silver.dim_customers(self.customers, self.orders, AS_OF)

    @cached_property
    def daily(self) -> DataFrame:
        return gold.mart_sales_daily(self.enriched)

    @cached_property
    def lifetime_value(self) -> DataFrame:
        return gold.mart_customer_lifetime_value(self.dimension, self.customer_orders, AS_OF, TIERS)

    @cached_property
    def performance(self) -> DataFrame:
        return gold.mart_product_performance(
            self.products, self.customer_orders, VELOCITY_BANDS, REORDER_UNITS, MONITOR_UNITS
        )


# ---- joins and aggregates on their own --------------------------------------------------------


def join_left_orders_items(r: Retail) -> DataFrame:
    totals = silver.order_line_totals(r.order_items)
    totals = totals.select("order_id", "items_count", "subtotal_amount")
    names = r.customers.select("customer_id", "full_name")
    heads = r.orders.select("order_id", "customer_id", "order_status").join(totals, "order_id", "left")
    return skew_join(heads, names, "customer_id", "left", r.hot_customers, spread="order_id")


def join_inner_lines(r: Retail) -> DataFrame:
    return r.customer_orders.select(
        "order_item_id", "order_id", "product_id", "customer_id", "category", "country", "quantity"
    )


def _salted_keys(frame: DataFrame, *columns: str) -> dict:
    """Heavy keys as they would be at so many partitions that ordinary keys count as heavy."""
    return find_hot_keys(frame, *columns, partitions=SALTED_PARTITIONS, small_rows=0)


def join_inner_lines_salted(r: Retail) -> DataFrame:
    """The line table by salted joins only: products first, then orders with their customers."""
    lines = _salted_keys(r.order_items, "product_id", "order_id")
    heads = _salted_keys(r.orders, "customer_id")
    skew = SkewProfile(lines["product_id"], lines["order_id"], heads["customer_id"])
    found = silver.int_customer_orders(
        r.order_items, r.products, r.orders, r.customers, skew, small_catalogue=False
    )
    return found.select(
        "order_item_id", "order_id", "product_id", "customer_id", "category", "country", "quantity"
    )


def int_orders_enriched_salted(r: Retail) -> DataFrame:
    hot = _salted_keys(r.orders, "customer_id")["customer_id"]
    return silver.int_orders_enriched(r.orders, r.order_items, r.customers, hot)


def join_left_customer_orders(r: Retail) -> DataFrame:
    orders = silver.customer_order_history(r.orders)
    return r.customers.select("customer_id", "full_name").join(orders, "customer_id", "left")


def rfm_ntile(r: Retail) -> DataFrame:
    scored = gold.rfm_scores(gold.customer_metrics(r.customer_orders), AS_OF)
    return scored.select(
        "customer_id",
        "recency_days",
        "purchase_frequency",
        "monetary_value",
        "recency_score",
        "frequency_score",
        "monetary_score",
    )


def product_rank(r: Retail) -> DataFrame:
    return gold.product_rankings(gold.product_metrics(r.customer_orders)).frame


def moving_avg(r: Retail) -> DataFrame:
    average = reports.moving_average(F.col("net_revenue"))
    return r.daily.select("date_day", "net_revenue", average.alias("revenue_7day_ma"))


def wow_growth(r: Retail) -> DataFrame:
    growth = reports.growth_percent(F.col("net_revenue"))
    return r.daily.select("date_day", "net_revenue", growth.alias("wow_growth_pct"))


# ---- incremental runs -------------------------------------------------------------------------


def _as_first_seen(orders: DataFrame, stale: Column) -> DataFrame:
    """Orders placed before the cutoff; the stale ones look as they did when they were placed."""
    return orders.where(F.col("order_date_day") < F.lit(CUTOFF)).withColumns(
        {
            "order_status": F.when(stale, "pending").otherwise(F.col("order_status")),
            "is_completed": F.col("is_completed") & ~stale,
            "is_cancelled": F.col("is_cancelled") & ~stale,
            "updated_at": F.when(stale, F.col("created_at")).otherwise(F.col("updated_at")),
        }
    )


def _enriched(r: Retail, orders: DataFrame, items: DataFrame) -> DataFrame:
    return silver.int_orders_enriched(orders, items, r.customers, r.hot_customers)


# Databases of this process's runs.
_databases: list[str] = []


def _fresh_table(r: Retail, name: str) -> str:
    """A table name in a database of its own, so that runs do not meet. It stays until `release`."""
    database = f"verification_{uuid.uuid4().hex}"
    tables.ensure_database(r.spark, database)
    _databases.append(database)
    return f"{database}.{name}"


def release(spark: SparkSession) -> None:
    """Drop the tables and delete the folders of all runs of this process; their results are gone with them."""
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")
    materialize.release(spark)


def merge_orders(r: Retail) -> DataFrame:
    """Store the orders up to the cutoff, merge what changed since; the table is the full build."""
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    seen = _as_first_seen(r.orders, F.col("updated_at") >= cutoff)
    name = _fresh_table(r, "int_orders_enriched")
    before = _enriched(r, seen, r.order_items)
    tables.replace_table(before, name, partition_by="order_month", latest=["order_updated_at"])
    newest = merge.latest_of_table(r.spark, name, "order_updated_at")
    run_at = dt.datetime.combine(AS_OF, dt.time())
    changed = r.orders.where(
        merge.changed_since(F.col("updated_at"), newest, run_at, LOOKBACK_DAYS)
    )
    items = silver.items_of(r.order_items, changed, r.line_skew["l_orderkey"])
    updates = _enriched(r, changed, items)
    merge.merge_into_table(r.spark, name, updates, "order_id", "order_month")
    return r.spark.table(name)


def merge_orders_propagated(r: Retail) -> DataFrame:
    """A table that lacks some old lines and has old names of some customers, after a run that propagates.

    The orders themselves did not change, and their dates are older than any lookback.
    """
    day = F.lit(AS_OF).cast("timestamp_ntz")
    old = F.col("customer_id") % 300 == 7
    late = F.col("order_id") % 900 == 11
    # Now: the late lines and the renamed customers carry today's date.
    items = r.order_items.withColumn("created_at", F.when(late, day).otherwise(F.col("created_at")))
    customers = r.customers.withColumn("updated_at", F.when(old, day).otherwise(F.col("updated_at")))
    name = _fresh_table(r, "int_orders_enriched")
    before = silver.int_orders_enriched(
        r.orders.where(F.col("updated_at") < F.lit(CUTOFF).cast("timestamp_ntz")),
        r.order_items.where(~late | (F.col("quantity") % 2 == 0)),
        r.customers.withColumn("full_name", F.when(old, F.lit("before")).otherwise(F.col("full_name"))),
        r.hot_customers,
    )
    tables.replace_table(before, name, partition_by="order_month", latest=["order_updated_at"])
    newest = merge.latest_of_table(r.spark, name, "order_updated_at")
    run_at = dt.datetime.combine(AS_OF, dt.time())

    def changed(moment: Column) -> Column:
        return merge.changed_since(moment, newest, run_at, LOOKBACK_DAYS)

    wanted = silver.affected_orders(r.orders, items, customers, changed, r.hot_customers)
    heads = r.orders.join(wanted, "order_id", "left_semi")
    lines = silver.items_of(items, heads, r.line_skew["l_orderkey"])
    updates = silver.int_orders_enriched(heads, lines, customers, r.hot_customers)
    merge.merge_into_table(r.spark, name, updates, "order_id", "order_month", fixed_partition=True)
    return r.spark.table(name)


def _days_with_gaps(r: Retail) -> DataFrame:
    return r.daily.where(F.dayofmonth("date_day") % 5 != 2)


# Two looks at the customers: some move in between, some vanish.
FIRST_LOOK, MOVED, SECOND_LOOK = dt.datetime(1993, 1, 1), dt.datetime(1996, 6, 1), dt.datetime(1997, 1, 1)


def customer_versions(r: Retail) -> DataFrame:
    columns = ("customer_id", "country", "updated_at")
    moves, moved = F.col("customer_id") % 3 == 0, F.lit(MOVED).cast("timestamp_ntz")
    first = r.customers.withColumns(
        {
            "country": F.when(moves, F.concat(F.lit("old "), "country")).otherwise(F.col("country")),
            "updated_at": F.lit(FIRST_LOOK).cast("timestamp_ntz"),
        }
    )
    second = r.customers.where("customer_id % 50 <> 9").withColumn(
        "updated_at", F.when(moves, moved).otherwise(F.lit(FIRST_LOOK).cast("timestamp_ntz"))
    )
    name = _fresh_table(r, "customer_versions")
    history.snapshot_into_table(r.spark, name, first.select(*columns), "customer_id", FIRST_LOOK)
    return history.snapshot_into_table(r.spark, name, second.select(*columns), "customer_id", SECOND_LOOK)


def orders_as_of_customer(r: Retail) -> DataFrame:
    """Each order with the country its customer had then."""
    orders = r.orders.select("order_id", "customer_id", "order_date")
    versions = customer_versions(r).drop(history.ENDED_ON, "updated_at")
    return history.join_as_of(
        orders, versions, "customer_id", "order_date", r.hot_customers, spread="order_id"
    )


def merge_sales_daily(r: Retail) -> DataFrame:
    """Daily table up to the cutoff with its last days half-told, then merged with their rebuild.

    A late change of an older day than the lookback is missed by design, so none is made here.
    """
    first_late_day = F.lit(CUTOFF - dt.timedelta(days=LOOKBACK_DAYS))
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    stale = (F.col("updated_at") >= cutoff) & (F.col("order_date_day") >= first_late_day)
    seen = _as_first_seen(r.orders, stale)
    name = _fresh_table(r, "mart_sales_daily")
    daily = gold.mart_sales_daily(_enriched(r, seen, r.order_items))
    tables.replace_table(daily, name, cluster_by=["date_day"], latest=["date_day"])
    newest = merge.latest_of_table(r.spark, name, "date_day")
    changed = r.enriched.where(
        merge.days_to_rebuild(F.col("order_date_day"), newest, LOOKBACK_DAYS)
    )
    updates = gold.mart_sales_daily(changed)
    merge.merge_into_table(r.spark, name, updates, "date_day", cluster_by=["date_day"])
    return r.spark.table(name)


def _status_versions(r: Retail) -> tuple[DataFrame, DataFrame]:
    """Orders as seen before the cutoff, and as they are now."""
    columns = ("order_id", "order_status", "updated_at")
    stale = F.col("updated_at") >= F.lit(CUTOFF).cast("timestamp_ntz")
    return _as_first_seen(r.orders, stale).select(*columns), r.orders.select(*columns)


def order_status_history(r: Retail) -> DataFrame:
    """A source with one or two versions of an order: as it was placed, and as it is now."""
    before, now = _status_versions(r)
    placed = r.orders.where("order_id % 3 = 0 and updated_at > created_at").select(
        "order_id", F.lit("placed").alias("order_status"), F.col("created_at").alias("updated_at")
    )
    return history.extend_history(history.start_history(before), now.unionByName(placed), "order_id")


def compare_order_states(r: Retail) -> DataFrame:
    before, now = _status_versions(r)
    return history.compare_tables(before, now, "order_id")


def reconcile_orders(r: Retail) -> DataFrame:
    """What changed in the orders since the cutoff, column by column."""
    stale = F.col("updated_at") >= F.lit(CUTOFF).cast("timestamp_ntz")
    columns = ("order_id", "order_status", "is_cancelled", "updated_at", "customer_id", "discount_amount")
    before = _as_first_seen(r.orders, stale).select(*columns)
    now = r.orders.where("order_id % 97 <> 5").select(*columns)
    return reconcile.reconcile(before, now, "order_id")


# ---- checks -----------------------------------------------------------------------------------


class Frames(Mapping[str, DataFrame]):
    """The models by name; each is built when it is first asked for, so a check costs only what it reads."""

    ATTRIBUTES = {
        "int_orders_enriched": "enriched",
        "int_customer_orders": "customer_orders",
        "mart_sales_daily": "daily",
        "mart_customer_lifetime_value": "lifetime_value",
        "mart_product_performance": "performance",
        "stg_customers": "customers",
        "stg_orders": "orders",
        "stg_order_items": "order_items",
        "stg_products": "products",
        "dim_customers": "dimension",
    }

    def __init__(self, retail: Retail):
        self.retail = retail

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self.retail, self.ATTRIBUTES[name])

    def __iter__(self) -> Iterator[str]:
        return iter(self.ATTRIBUTES)

    def __len__(self) -> int:
        return len(self.ATTRIBUTES)


def check_unique(r: Retail) -> DataFrame:
    listed = {
        "stg_customers": [quality.Unique("customer_id")],
        "stg_orders": [quality.Unique("order_id")],
        "stg_order_items": [quality.Unique("order_item_id"), quality.Unique("order_id")],
        "stg_products": [quality.Unique("product_id"), quality.Unique("category")],
    }
    return quality.report(listed, Frames(r))


def check_not_null(r: Retail) -> DataFrame:
    listed = {
        "stg_customers": [quality.NotNull(c) for c in ("customer_id", "email", "phone")],
        "stg_orders": [quality.NotNull(c) for c in ("order_id", "customer_id", "order_status")],
        "stg_products": [quality.NotNull(c) for c in ("product_name", "profit_margin_pct")],
        "dim_customers": [quality.NotNull(c) for c in ("customer_segment", "first_order_date")],
    }
    return quality.report(listed, Frames(r))


def check_relationships(r: Retail) -> DataFrame:
    """Line products the catalogue does not know, and order customers nobody knows."""
    products = quality.orphans(r.order_items, "product_id", r.products, "product_id")
    customers = quality.orphans(r.orders, "customer_id", r.customers, "customer_id")
    return products.withColumn("child", F.lit("order_items")).unionByName(
        customers.withColumn("child", F.lit("orders"))
    )


def check_accepted_values(r: Retail) -> DataFrame:
    listed = {
        "stg_orders": [
            quality.AcceptedValues("order_status", rules.ORDER_STATUSES),
            quality.AcceptedValues("order_status", rules.COMPLETED_STATUSES),
            quality.AcceptedValues("shipping_method", ("standard",)),
        ],
        "dim_customers": [
            quality.AcceptedValues("customer_segment", rules.CUSTOMER_SEGMENTS),
            quality.AcceptedValues("purchase_frequency_segment", ("Never Purchased",)),
        ],
    }
    return quality.report(listed, Frames(r))


def cents(r: Retail) -> DataFrame:
    orders = star.table(r.spark, r.folder, "orders")
    amount = (star.money(F.col("o_totalprice")) * 100).cast("bigint")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        amount.alias("cents"),
        cents_to_dollars(amount).alias("dollars"),
        cents_to_dollars(amount, 1).alias("dollars_1_digit"),
        cents_to_dollars(amount, 0).alias("whole_dollars"),
    )


MODELS: dict[str, Callable[[Retail], DataFrame]] = {
    "stg_customers": lambda r: r.customers,
    "stg_orders": lambda r: r.orders,
    "stg_products": lambda r: r.products,
    "stg_order_items": lambda r: r.order_items,
    "int_orders_enriched": lambda r: r.enriched,
    "int_customer_orders": lambda r: r.customer_orders,
    "dim_customers": lambda r: r.dimension,
    "mart_sales_daily": lambda r: r.daily,
    "mart_customer_lifetime_value": lambda r: r.lifetime_value,
    "mart_product_performance": lambda r: gold.best_first(r.performance),
    "revenue_trend": lambda r: reports.revenue_trend(r.daily, AS_OF),
    "report_last_days": lambda r: reports.last_days(r.daily),
    "report_tier_segment": lambda r: reports.by_tier_and_segment(r.lifetime_value),
    "report_tier_segment_rounded": lambda r: reports.by_tier_and_segment(r.lifetime_value, True),
    "report_top_products": lambda r: reports.top_products(r.performance),
    "join_left_orders_items": join_left_orders_items,
    "join_inner_lines": join_inner_lines,
    "join_inner_lines_salted": join_inner_lines_salted,
    "int_orders_enriched_salted": int_orders_enriched_salted,
    "join_left_customer_orders": join_left_customer_orders,
    "agg_order_items": lambda r: silver.order_line_totals(r.order_items),
    "agg_customer_orders": lambda r: silver.customer_order_history(r.orders),
    "agg_customer_metrics": lambda r: gold.customer_metrics(r.customer_orders),
    "agg_product_metrics": lambda r: gold.product_metrics(r.customer_orders),
    "agg_daily": lambda r: gold.daily_aggregates(r.enriched),
    "rfm_ntile": rfm_ntile,
    "product_rank": product_rank,
    "moving_avg": moving_avg,
    "wow_growth": wow_growth,
    "merge_orders": merge_orders,
    "merge_orders_propagated": merge_orders_propagated,
    "merge_sales_daily": merge_sales_daily,
    "revenue_trend_dense": lambda r: reports.revenue_trend_dense(_days_with_gaps(r), AS_OF),
    "report_product_preview": lambda r: reports.product_report(r.performance),
    "customer_versions": lambda r: customer_versions(r).drop(history.ENDED_ON),
    "orders_as_of_customer": orders_as_of_customer,
    "order_status_history": order_status_history,
    "compare_order_states": compare_order_states,
    "reconcile_orders": reconcile_orders,
    "reconcile_equal": lambda r: reconcile.reconcile(r.orders, r.orders, "order_id"),
    "agg_monthly_from_daily": lambda r: gold.period_customers(gold.daily_customers(r.enriched), "month"),
    "agg_weekly_from_daily": lambda r: gold.period_customers(gold.daily_customers(r.enriched), "week"),
    "check_unique": check_unique,
    "check_not_null": check_not_null,
    "check_relationships": check_relationships,
    "check_accepted_values": check_accepted_values,
    "check_declared_silver": lambda r: quality.report(checks.SILVER_CHECKS, Frames(r)),
    "check_declared_gold": lambda r: quality.report(checks.GOLD_CHECKS, Frames(r)),
    "check_positive_totals": lambda r: checks.positive_order_totals(r.enriched),
    "check_profit_le_revenue": lambda r: checks.profit_within_revenue(r.performance),
    "cents_to_dollars": cents,
}


def _runner(model: Callable[[Retail], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: comparable(model(Retail(spark, folder)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(model) for name, model in MODELS.items()}
