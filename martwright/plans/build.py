"""Build all layers into tables, in full or by merging what changed."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.columns import period_start
from martwright.operators import merge, quality, tables
from martwright.plans import checks, gold, silver, staging
from martwright.plans.skew_profile import SkewProfile, profile_skew
from martwright.plans.staging_views import view_query
from martwright.session import apply_settings
from martwright.sources.raw import RawTables, read_tables


@dataclass(frozen=True)
class Run:
    """Everything a build does not read from the data; the run time is on the orders' clock."""

    run_at: dt.datetime = field(
        default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    )
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    as_of: dt.date | None = None
    lookback_days: int = 3
    full_refresh: bool = False
    # Order and line ids are known to occur once: plain counts will do.
    unique_ids: bool = False
    # Orders with late lines or changed customers are merged too, whatever their dates.
    propagate_changes: bool = False
    # Database with the tables raw_<name>, where they are stored; else the build stores them itself.
    raw_database: str | None = None
    target: str = "dev"
    default_schema: str = "retail"
    audit_columns: tuple[str, str] = tables.AUDIT_COLUMNS

    @property
    def day(self) -> dt.date:
        return self.as_of or self.run_at.date()

    def table(self, layer: str | None, name: str) -> str:
        return f"{tables.layer_schema(layer, self.default_schema, self.target)}.{name}"

    def audited(self, df: DataFrame) -> DataFrame:
        return tables.with_audit(df, self.run_at, self.run_id, self.audit_columns)


@dataclass(frozen=True)
class Staged:
    """Staging frames and their heavy keys."""

    customers: DataFrame
    orders: DataFrame
    products: DataFrame
    order_items: DataFrame
    skew: SkewProfile


def stage(raw: RawTables) -> Staged:
    orders, order_items = staging.stg_orders(raw.orders), staging.stg_order_items(raw.order_items)
    return Staged(
        staging.stg_customers(raw.customers),
        orders,
        staging.stg_products(raw.products),
        order_items,
        profile_skew(order_items, orders),
    )


def changed_orders(spark: SparkSession, target: str, staged: Staged, run: Run) -> DataFrame:
    """Enriched rows of the orders changed since the table `target` was built.

    A new line or a changed customer without a change of the order is only seen where the run
    propagates changes.
    """
    newest = merge.latest_of_table(spark, target, "order_updated_at")

    def is_new(moment: Column) -> Column:
        return merge.changed_since(moment, newest, run.run_at, run.lookback_days)

    if run.propagate_changes:
        wanted = silver.affected_orders(
            staged.orders, staged.order_items, staged.customers, is_new, staged.skew.customers
        )
        changed = staged.orders.join(wanted, "order_id", "left_semi")
    else:
        changed = staged.orders.where(is_new(F.col("updated_at")))
    items = silver.items_of(staged.order_items, changed, staged.skew.orders)
    return silver.int_orders_enriched(
        changed, items, staged.customers, staged.skew.customers, run.unique_ids
    )


def changed_days(spark: SparkSession, target: str, enriched: DataFrame, run: Run) -> DataFrame:
    """Daily rows from the lookback before the target's last day on, each rebuilt in full."""
    newest = merge.latest_of_table(spark, target, "date_day")
    recent = enriched
    if newest is not None:
        first = F.lit(newest - dt.timedelta(days=run.lookback_days))
        # The month says the same more coarsely and lets whole partitions be skipped.
        recent = enriched.where(
            (F.col("order_month") >= period_start(first, "month"))
            & merge.days_to_rebuild(F.col("order_date_day"), newest, run.lookback_days)
        )
    return gold.mart_sales_daily(recent, run.unique_ids)


def stored_raw(spark: SparkSession, raw: RawTables, run: Run) -> tuple[RawTables, dict[str, str]]:
    """The raw tables as they are stored, and their names; a view can only read what the catalog knows."""
    if run.raw_database is None:
        names = {name: run.table(None, f"raw_{name}") for name in RawTables._fields}
        return RawTables(*[tables.replace_table(df, names[n]) for n, df in raw._asdict().items()]), names
    names = {name: f"{run.raw_database}.raw_{name}" for name in RawTables._fields}
    return read_tables(spark, run.raw_database), names


def build(spark: SparkSession, raw: RawTables, run: Run) -> dict[str, DataFrame]:
    """Build staging views in the bronze layer, silver and gold tables; returns them by name.

    Incremental tables are merged when they exist, unless a full refresh is asked for. The session gets
    the settings that results depend on. A claim that ids are unique is verified first.
    """
    apply_settings(spark)
    if run.unique_ids:
        merge.check_unique_key(raw.orders, "order_id")
        merge.check_unique_key(raw.order_items, "order_item_id")
    for layer in (None, "bronze", "silver", "gold"):
        tables.ensure_database(spark, tables.layer_schema(layer, run.default_schema, run.target))
    raw, sources = stored_raw(spark, raw, run)
    staged = stage(raw)
    built = {}
    for name, source in sources.items():
        query = view_query(name, source, run.run_at, run.run_id, run.audit_columns)
        built[f"stg_{name}"] = tables.create_view(spark, run.table("bronze", f"stg_{name}"), query)

    name = run.table("silver", "int_orders_enriched")
    if run.full_refresh or not spark.catalog.tableExists(name):
        enriched = silver.int_orders_enriched(
            staged.orders, staged.order_items, staged.customers, staged.skew.customers, run.unique_ids
        )
        tables.replace_table(
            run.audited(enriched), name, partition_by="order_month", latest=["order_updated_at"]
        )
    else:
        updates = run.audited(changed_orders(spark, name, staged, run))
        merge.merge_into_table(spark, name, updates, "order_id", "order_month")
    built["int_orders_enriched"] = spark.table(name)

    lines = silver.int_customer_orders(
        staged.order_items, staged.products, staged.orders, staged.customers, staged.skew
    )
    built["int_customer_orders"] = tables.replace_table(
        run.audited(lines), run.table("silver", "int_customer_orders")
    )
    dimension = silver.dim_customers(staged.customers, staged.orders, run.day, run.unique_ids)
    built["dim_customers"] = tables.replace_table(
        run.audited(dimension), run.table("silver", "dim_customers")
    )

    name = run.table("gold", "mart_sales_daily")
    if run.full_refresh or not spark.catalog.tableExists(name):
        daily = gold.mart_sales_daily(built["int_orders_enriched"], run.unique_ids)
        tables.replace_table(run.audited(daily), name, cluster_by=["date_day"], latest=["date_day"])
    else:
        updates = changed_days(spark, name, built["int_orders_enriched"], run)
        merge.merge_into_table(
            spark, name, run.audited(updates), "date_day", cluster_by=["date_day"]
        )
    built["mart_sales_daily"] = spark.table(name)

    lifetime_value = gold.mart_customer_lifetime_value(
        built["dim_customers"],
        built["int_customer_orders"],
        run.day,
        unique_orders=run.unique_ids,
    )
    built["mart_customer_lifetime_value"] = tables.replace_table(
        run.audited(lifetime_value),
        run.table("gold", "mart_customer_lifetime_value"),
        cluster_by=["customer_segment"],
        spread=["customer_id"],
    )
    performance = gold.mart_product_performance(staged.products, built["int_customer_orders"])
    built["mart_product_performance"] = tables.replace_table(
        run.audited(performance),
        run.table("gold", "mart_product_performance"),
        cluster_by=["category"],
        spread=["product_id"],
    )
    return built


def _rule_violations(built: dict[str, DataFrame]) -> dict[tuple[str, str, str], DataFrame]:
    """Failing rows of the two business rules, by table, column and name."""
    return {
        ("int_orders_enriched", "grand_total", "positive_order_totals"): checks.positive_order_totals(
            built["int_orders_enriched"]
        ),
        ("mart_product_performance", "total_profit", "profit_within_revenue"): (
            checks.profit_within_revenue(built["mart_product_performance"])
        ),
    }


def check_build(built: dict[str, DataFrame], severity: str = quality.WARN) -> DataFrame:
    """Report of all declared checks and the two business rules, one line each."""
    report = quality.report(checks.DECLARED_CHECKS, built, severity)
    for (table, column, check), failing in _rule_violations(built).items():
        line = failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(table).alias("table"),
            F.lit(column).alias("column"),
            F.lit(check).alias("check"),
            "failures",
            F.lit(severity).alias("severity"),
        )
        report = report.unionByName(line)
    return report


def store_failing_rows(
    spark: SparkSession, built: dict[str, DataFrame], report: DataFrame, database: str
) -> list[str]:
    """Keep the rows behind every failed check as `<table>_<column>_<check>`; returns the tables."""
    failing = {
        (table, check.column, check.kind): quality.failing_rows(check, table, built)
        for table, listed in checks.DECLARED_CHECKS.items()
        for check in listed
    } | _rule_violations(built)
    tables.ensure_database(spark, database)
    stored = []
    for line in report.where("failures > 0").collect():
        key = (line["table"], line["column"], line["check"])
        stored.append(f"{database}.{'_'.join(key)}")
        quality.store_failures(failing[key], stored[-1])
    return stored
