"""Time the headline queries, from the raw tables and from stored ones; prints one JSON line."""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators import merge, tables
from martwright.plans import gold
from martwright.session import local_session
from verification.queries import AS_OF, MONITOR_UNITS, REORDER_UNITS, TIERS, VELOCITY_BANDS, Retail, queries, release

HEADLINES = (
    "int_orders_enriched",
    "int_customer_orders",
    "dim_customers",
    "mart_sales_daily",
    "mart_customer_lifetime_value",
    "mart_product_performance",
    "revenue_trend",
    "merge_orders",
    "merge_sales_daily",
    "check_unique",
)
# The last days of the orders, about one in a hundred.
LAST_DAYS = 24


def seconds(run: Callable[[], DataFrame | None]) -> float:
    start = time.perf_counter()
    found = run()
    if found is not None:
        found.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def stored_runs(spark, folder: str, database: str) -> dict[str, Callable[[], DataFrame | None]]:
    """The marts over silver tables that are written before the clock starts, and merges into tables."""
    r = Retail(spark, folder)
    tables.ensure_database(spark, database)
    name = {t: f"{database}.{t}" for t in ("orders", "lines", "customers", "daily")}
    orders = tables.replace_table(
        r.enriched, name["orders"], partition_by="order_month", latest=["order_updated_at"]
    )
    lines = tables.replace_table(r.customer_orders, name["lines"])
    customers = tables.replace_table(r.dimension, name["customers"])
    tables.replace_table(gold.mart_sales_daily(orders), name["daily"], cluster_by=["date_day"], latest=["date_day"])
    products = r.products
    late = F.col("order_date_day") >= F.lit(AS_OF - dt.timedelta(days=LAST_DAYS))

    def merge_orders() -> None:
        merge.merge_into_table(spark, name["orders"], r.enriched.where(late), "order_id", "order_month")

    def merge_daily() -> None:
        updates = gold.mart_sales_daily(spark.table(name["orders"]).where(late))
        merge.merge_into_table(spark, name["daily"], updates, "date_day", cluster_by=["date_day"])

    return {
        "stored_mart_sales_daily": lambda: gold.mart_sales_daily(orders),
        "stored_mart_customer_lifetime_value": lambda: gold.mart_customer_lifetime_value(
            customers, lines, AS_OF, TIERS
        ),
        "stored_mart_product_performance": lambda: gold.mart_product_performance(
            products, lines, VELOCITY_BANDS, REORDER_UNITS, MONITOR_UNITS
        ),
        # Last, because they replace files that the others read.
        "merge_daily_into_table": merge_daily,
        "merge_orders_into_table": merge_orders,
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    available = queries()
    runs = {name: lambda name=name: available[name](spark, folder) for name in HEADLINES}
    seconds(runs["int_customer_orders"])  # starts the JVM's compiled paths
    database = f"bench_{uuid.uuid4().hex}"
    runs |= stored_runs(spark, folder, database)
    times = {}
    for name, run in runs.items():
        times[name] = round(statistics.median(seconds(run) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times[name] for name in HEADLINES), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.sql(f"DROP DATABASE {database} CASCADE")
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
