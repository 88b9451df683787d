import re

import pytest
from conftest import rows

from martwright.operators import quality as q


@pytest.fixture
def frames(spark):
    return {
        "child": spark.createDataFrame(
            [(1, 10, "x"), (1, 10, "y"), (2, 99, "z"), (3, 99, None), (None, None, "x"), (None, 11, "x")],
            "id int, parent_id int, kind string",
        ),
        "parent": spark.createDataFrame([(10,), (11,)], "id int"),
    }


CHECKS = {
    "child": [
        q.Unique("id"),
        q.NotNull("id"),
        q.NotNull("kind"),
        q.AcceptedValues("kind", ("x", "y")),
        q.Relationship("parent_id", "parent", "id"),
    ],
    "parent": [q.Unique("id")],
}


def test_report(frames):
    found = {(r["table"], r["column"], r["check"]): r["failures"] for r in q.report(CHECKS, frames).collect()}
    assert found == {
        ("child", "id", "unique"): 1,
        ("child", "id", "not_null"): 2,
        ("child", "kind", "not_null"): 1,
        ("child", "kind", "accepted_values"): 1,
        ("child", "parent_id", "relationships"): 2,
        ("parent", "id", "unique"): 0,
    }


def test_failing_rows(frames):
    unique, no_id, _, kinds, parents = CHECKS["child"]
    assert rows(q.failing_rows(unique, "child", frames)) == [(1, 2)]
    assert q.failing_rows(no_id, "child", frames).count() == 2
    assert rows(q.failing_rows(kinds, "child", frames)) == [("z", 1)]
    assert rows(q.failing_rows(parents, "child", frames)) == [(99, 2)]


def test_warnings_pass_and_errors_raise(frames):
    q.enforce(q.report(CHECKS, frames, q.WARN))
    with pytest.raises(q.ChecksFailed, match="child.id unique: 1"):
        q.enforce(q.report(CHECKS, frames, q.ERROR))


def test_store_failures(spark, frames):
    q.store_failures(q.duplicates(frames["child"], "id"), "failed_child_id")
    assert rows(spark.table("failed_child_id")) == [(1, 2)]


def test_row_checks_share_one_scan(frames):
    plan = q.report({"child": CHECKS["child"][1:4]}, frames)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("LocalTableScan") + plan.toString().count("Scan ExistingRDD") == 1


def test_all_uniqueness_checks_of_a_table_share_one_shuffle(spark):
    df = spark.createDataFrame(
        [(1, "a", bytearray(b"\x00"), 1.5), (2, "a", bytearray(b"\xff"), 1.5), (3, None, bytearray(b"\xfe"), None), (3, None, None, 1.5)],
        "i int, s string, b binary, d double",
    )
    checks = [q.Unique(c) for c in ("i", "s", "b", "d")]
    report = q.report({"t": checks}, {"t": df})
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(i#\d+, value#", plan)) == 1 == plan.count("Scan ExistingRDD")
    assert {r["column"]: r["failures"] for r in report.collect()} == {"i": 1, "s": 1, "b": 0, "d": 1}
    assert {r["failures"] for r in q.report({"t": checks}, {"t": df.limit(0)}).collect()} == {0}
