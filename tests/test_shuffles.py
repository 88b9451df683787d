"""How often the plans of the largest models deal out the lines, and what they carry."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.plans import silver, staging
from martwright.sources import star

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_dealt_out_by_product_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = staging.stg_order_items(star.raw_order_items(spark, FOLDER))
        products = staging.stg_products(star.raw_products(spark, FOLDER))
        orders = staging.stg_orders(star.raw_orders(spark, FOLDER))
        customers = staging.stg_customers(star.raw_customers(spark, FOLDER))
        found = silver.int_customer_orders(lines, products, orders, customers, small_catalogue=False)
        plan = plan_of(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Lines, prices and products; the price join leaves the lines where the next join wants them.
    assert len(re.findall(r"hashpartitioning\(product_id", plan)) == 3
    assert "hashpartitioning(l_partkey" not in plan
    keys = found.join(products.select("product_id", F.col("product_key").alias("pk")), "product_id")
    keys = keys.join(orders.select("order_id", F.col("order_key").alias("ok")), "order_id")
    assert keys.count() == found.count() == keys.where("pk = product_key and ok = order_key").count() > 0


def test_lines_are_summed_up_per_order_after_one_shuffle(spark):
    early, late = dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
    data = [
        ("a", 1, 10, 2, Decimal("4.00"), late),
        ("a", 1, 10, 2, Decimal("4.00"), early),
        ("b", 1, 11, None, None, None),
        (None, 1, None, 1, Decimal("1.00"), None),
        ("a", 2, None, None, None, None),
        (None, 3, 10, 1, Decimal("1.00"), late),
        ("c", None, 10, 1, Decimal("1.00"), late),
    ]
    schema = "order_item_id string, order_id int, product_id int, quantity int, "
    schema += "line_total decimal(12,2), created_at timestamp_ntz"
    lines = spark.createDataFrame(data, schema)
    found = silver.order_line_totals(lines)
    assert plan_of(found).count("Exchange") == 1
    assert rows(found) == [
        (1, 2, 2, 5, Decimal("9.00"), early, late),
        (2, 1, 0, None, None, None, None),
        (3, 0, 1, 1, Decimal("1.00"), late, late),
    ]
    unique = silver.order_line_totals(lines.where("order_id = 2"), unique_items=True)
    assert rows(unique) == [(2, 1, 0, None, None, None, None)]


def test_a_round_of_components_takes_one_join(spark, monkeypatch):
    module = pytest.importorskip("martwright.llm.components")
    plans, keep = [], module.stored

    def noted(df, name):
        plans.append(plan_of(df))
        return keep(df, name)

    monkeypatch.setattr(module, "stored", noted)
    # A star around its largest vertex, a chain, a cycle; repeated, turned, null and own links.
    star = [(i, 99) for i in range(10, 40)]
    chain = [(100 + i, 101 + i) for i in range(20)]
    more = [(1, 2), (2, 1), (1, 2), (2, 3), (3, 1), (5, 5), (None, 7), (8, None)]
    links = spark.createDataFrame(star + chain + more, "a long, b long")
    label = {99: 10} | {a: 10 for a, _ in star} | {100 + i: 100 for i in range(21)} | {1: 1, 2: 1, 3: 1}
    assert rows(module.components(links), "v", "label") == sorted(label.items(), key=lambda r: tuple(map(str, r)))
    assert len(plans) > 3
    for plan in plans[2:]:
        assert len(re.findall(r"(?:SortMerge|Hash|NestedLoop)Join", plan)) == 1


def test_few_links_are_followed_without_an_exchange(spark, monkeypatch):
    """The same labels as by joins, for numbers, strings and no links; one link more takes the joins."""
    module = pytest.importorskip("martwright.llm.components")
    rng = random.Random(3)
    data = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(500, 540)]
    data += [(7, 7), (None, 3), (4, None), (700, 650), (700, 650)]
    for kind in ("long", "int", "string"):
        links = spark.createDataFrame(data, "a long, b long").selectExpr(f"cast(a as {kind}) a", f"cast(b as {kind}) b")
        plans, keep = [], module.stored
        monkeypatch.setattr(module, "stored", lambda df, name: plans.append(plan_of(df)) or keep(df, name))
        found, want = module.components(links, 1000), module.components(links)
        monkeypatch.setattr(module, "stored", keep)
        assert rows(found) == rows(want) and found.schema == want.schema
        assert "Exchange" not in plans[0] and len(plans) > 3
    own = links.where("a <> b").count()
    for few, expected in ((own, 1), (own - 1, 2)):
        plans.clear()
        monkeypatch.setattr(module, "stored", lambda df, name: plans.append(name) or keep(df, name))
        module.components(links, few)
        monkeypatch.setattr(module, "stored", keep)
        assert len(plans) == 1 if expected == 1 else len(plans) > 3
    assert module.components(links.limit(0), 10).count() == 0


def test_exploded_cells_are_never_broadcast(spark):
    """Spark takes 64 cells of a set for one: by its size the table would be broadcast."""
    near = pytest.importorskip("martwright.llm.near_dedup")
    sets = spark.range(2000).selectExpr("id rep", "transform(sequence(1, 64), i -> cast(hash(id % 700, i) as int)) sig")
    posts = near.postings(sets, near.Plan())
    assert "Broadcast" not in plan_of(posts)
    assert posts.select("rep").distinct().count() == 2000


def test_hubs_of_all_seeds_take_one_grouping_and_one_join(spark):
    near = pytest.importorskip("martwright.llm.near_dedup")
    data = [(t, rep, 20, label) for t in (1, 2) for rep, label in [(3, 3), (4, 3), (5, 5), (6, 6)]]
    data += [(3, 1, 2, 1), (3, 2, 2, 2), (4, 7, 20, 7), (4, 8, 20, 7)]  # a short list; one with one label
    posts = spark.createDataFrame(data, "token long, rep long, freq long, label long")
    found = near.hub_pairs(posts, range(4))
    plan = plan_of(found)
    assert plan.count("Join") == 1 and plan.count("Exchange") <= 4
    single = [set(rows(near.hub_pairs(posts, range(k, k + 1)))) for k in range(4)]
    assert rows(found) == sorted(set.union(*single))
    # Each member meets the hub of every order unless they have one label.
    for pairs in single:
        assert any(pairs == {(min(r, hub), max(r, hub)) for r in (3, 4, 5, 6) if r != hub and {r, hub} != {3, 4}} for hub in (3, 4, 5, 6))
