"""The raw tables derived from a TPC-H-like star schema in Parquet.

Every order, line, part and customer becomes one retail row. The traits the marts must cope with are
put in on the way: orders of unknown customers, lines of unknown products, so customers without
orders and products without sales; customers without a completed order; zero prices and stock; wrong
line totals; discounts above the total; negative costs; blanks around codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions.rules import first_match
from martwright.operators.skew import NO_HOT_KEYS, HotKeys, skew_join
from martwright.sources.raw import RawTables

MONEY = "decimal(12,2)"

STAR_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with its schema stated, so no job has to read footers first."""
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def money(amount) -> Column:
    return (F.lit(amount) if isinstance(amount, str) else amount).cast(MONEY)


def unknown_when(condition: Column, key: Column) -> Column:
    """The key, or a negative one that no table holds."""
    return F.when(condition, -1 - key).otherwise(key)


def line_product(part: Column) -> Column:
    """The product id that lines of a part carry; some are of products that nobody knows."""
    return unknown_when(part % 50 == 7, part)


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    key, start = F.col("c_custkey"), F.lit("1995-01-01").cast("date")
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            key.alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            F.substring("c_name", 10, 1000).alias("last_name"),
            F.concat(F.lit("  Cust"), key.cast("string"), F.lit("@Example.COM ")).alias("email"),
            F.lit(None).cast("string").alias("phone"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.col("n_name").alias("country"),
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("postal_code"),
            start.alias("created_at"),
            start.alias("updated_at"),
        )
    )


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    key, customer, ordered = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    status = first_match(
        [
            (customer % 25 == 4, "Cancelled"),
            (key % 97 == 0, " Completed"),
            (F.col("o_orderstatus") == "F", "Completed"),
            (key % 4 == 0, "shipped"),
            (key % 4 == 1, "pending"),
            (key % 4 == 2, " processing "),
        ],
        "Cancelled",
    )
    payment = first_match([(key % 3 == 0, "Credit_Card"), (key % 3 == 1, "paypal")], "debit_card")
    tax = F.round(money(F.col("o_totalprice")) * F.lit("0.07").cast("decimal(4,2)"), 2)
    return table(spark, folder, "orders").select(
        key.alias("order_id"),
        unknown_when(customer % 25 == 3, customer).alias("customer_id"),
        ordered.alias("order_date"),
        status.alias("order_status"),
        F.when(urgent, " Express").otherwise("standard").alias("shipping_method"),
        payment.alias("payment_method"),
        F.when(urgent, money("12.99")).otherwise(money("5.99")).alias("shipping_cost"),
        money(tax).alias("tax_amount"),
        F.when(key % 211 == 7, money("9000000.00"))
        .when(key % 5 == 0, money("10.00"))
        .otherwise(money("0.00"))
        .alias("discount_amount"),
        ordered.alias("created_at"),
        (ordered + F.make_dt_interval(days=(key % 6).cast("int"))).alias("updated_at"),
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    key, kind, retail = F.col("p_partkey"), F.col("p_type"), F.col("p_retailprice")
    start = F.lit("1995-01-01").cast("date")
    share = F.when(key % 97 == 5, F.lit("-0.60")).otherwise(F.lit("0.60")).cast("decimal(4,2)")
    cost = F.round(money(retail) * share, 2)
    return table(spark, folder, "part").select(
        key.alias("product_id"),
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("product_name"),
        kind.alias("category"),
        F.concat(kind, F.lit("/"), (F.col("p_size") % 5).cast("string")).alias("subcategory"),
        F.col("p_brand").alias("brand"),
        F.when(key % 499 == 0, money("0.00")).otherwise(money(retail)).alias("price"),
        money(cost).alias("cost"),
        ((key * 37) % 300).cast("int").alias("stock_quantity"),
        start.alias("created_at"),
        start.alias("updated_at"),
    )


def raw_order_items(spark: SparkSession, folder: str, hot_parts: HotKeys = NO_HOT_KEYS) -> DataFrame:
    """One row per line, priced from the part; the seventh line of an order has a wrong total.

    Prices are joined by the id that the product gets, which tells parts apart as well as their own: a later
    join with the products finds the lines dealt out already.
    """
    part, quantity = F.col("l_partkey"), F.col("l_quantity").cast("int")
    price = money(F.col("p_retailprice"))
    extra = F.when(F.col("l_linenumber") == 7, 1).otherwise(0)
    identity = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = table(spark, folder, "lineitem").withColumn("product_id", line_product(part))
    prices = table(spark, folder, "part")
    prices = prices.select(line_product(F.col("p_partkey")).alias("product_id"), "p_retailprice")
    # Heavy parts by either of their ids; one that does not occur costs nothing.
    salts = {id_: n for key, n in hot_parts.salts.items() for id_ in (key, -1 - key)}
    hot = HotKeys(salts, hot_parts.null_salts)
    priced = skew_join(lines, prices, "product_id", "left", hot, spread="l_orderkey")
    return priced.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in identity], quantity.cast("string")).alias(
            "order_item_id"
        ),
        F.col("l_orderkey").alias("order_id"),
        "product_id",
        quantity.alias("quantity"),
        price.alias("unit_price"),
        money(quantity * price + extra).alias("line_total"),
        F.col("l_shipdate").alias("created_at"),
    )


def read_star(spark: SparkSession, folder: str, hot_parts: HotKeys = NO_HOT_KEYS) -> RawTables:
    return RawTables(
        raw_customers(spark, folder),
        raw_orders(spark, folder),
        raw_products(spark, folder),
        raw_order_items(spark, folder, hot_parts),
    )
