import datetime as dt

import pytest
from conftest import rows

from martwright.schemas import RAW_SCHEMAS
from martwright.sources import raw, star

# The first line of each file, the column names of the sources.
HEADERS = {
    "customers": (
        "customer_id,first_name,last_name,email,phone,city,state,country,postal_code,created_at,updated_at"
    ),
    "orders": (
        "order_id,customer_id,order_date,order_status,shipping_method,payment_method,shipping_cost,"
        "tax_amount,discount_amount,created_at,updated_at"
    ),
    "products": (
        "product_id,product_name,category,subcategory,brand,price,cost,stock_quantity,created_at,updated_at"
    ),
    "order_items": "order_item_id,order_id,product_id,quantity,unit_price,line_total,created_at",
}
ROWS = {
    "customers": "71,Ines,Okafor, Ines@Mill.example ,,Porto,PT,Portugal,04050,2019-05-06 07:08:09,2019-06-07 08:09:10",
    "orders": "9001,71,2019-07-11 23:59:00,SHIPPED,courier,voucher,12.34,0.56,7.89,2019-07-11 23:59:00,2019-07-13 00:01:00",
    "products": '305,Saw blade 9" fine,Tools,Blades,Grindstone,31.25,17.05,64,2018-03-04 05:06:07,2018-04-05 06:07:08',
    "order_items": "42,9001,305,3,31.25,93.75,2019-07-12 00:00:01",
}
FILES = {name: [HEADERS[name], ROWS[name]] for name in HEADERS}


@pytest.fixture
def folder(tmp_path):
    for name, lines in FILES.items():
        (tmp_path / f"raw_{name}.csv").write_text("\n".join(lines) + "\n")
    return tmp_path


def test_types_zeros_and_quotes_survive(spark, folder):
    tables = raw.read_csv(spark, str(folder))
    for name, df in tables._asdict().items():
        declared = [c.split()[0] for c in RAW_SCHEMAS[f"raw_{name}"].replace("DECIMAL(12,2)", "D").split(", ")]
        assert df.columns == declared
    assert rows(tables.customers, "postal_code") == [("04050",)]
    assert rows(tables.products, "product_name") == [('Saw blade 9" fine',)]
    assert dict(tables.orders.dtypes)["tax_amount"] == "decimal(12,2)"
    assert dict(tables.orders.dtypes)["order_date"] == "timestamp_ntz"


def test_value_of_wrong_type_fails(spark, folder):
    bad = folder / "raw_order_items.csv"
    bad.write_text(bad.read_text() + "x,9001,305,2,1.50,3.00,2019-07-12 00:00:01\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        raw.read_csv(spark, str(folder)).order_items.collect()


def test_load_replaces_the_tables(spark, folder):
    for _ in range(2):
        stored = raw.load_csv(spark, str(folder), "raw_db")
        assert [df.count() for df in stored] == [1, 1, 1, 1]
    assert rows(spark.table("raw_db.raw_customers"), "postal_code") == [("04050",)]
    assert raw.read_tables(spark, "raw_db").orders.columns == stored.orders.columns


def test_rows_with_an_unknown_nation_or_part_stay(spark, tmp_path):
    """Each base row becomes one raw row, whether or not its nation, region or part is known."""
    def table(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    table("customer", [(1, "Customer#1", 0), (2, "Customer#2", 9)], "c_custkey long, c_name string, c_nationkey int")
    table("nation", [(0, "FRANCE", 7)], "n_nationkey int, n_name string, n_regionkey int")
    table("region", [(3, "EUROPE")], "r_regionkey int, r_name string")
    table("part", [(1, 10.0)], "p_partkey long, p_retailprice double")
    lines = [(1, p, 1, n, 2.0, dt.datetime(2024, 1, 1)) for n, p in ((1, 1), (2, 5))]
    table("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz")
    customers = rows(star.raw_customers(spark, str(tmp_path)), "customer_id", "city", "state")
    assert customers == [(1, "FRANCE", None), (2, None, None)]
    found = rows(star.raw_order_items(spark, str(tmp_path)), "product_id", "quantity", "unit_price")
    assert [r[:2] for r in found] == [(1, 2), (5, 2)] and found[1][2] is None
