import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.operators import tables
from martwright.operators.history import (
    compare_tables,
    extend_history,
    join_as_of,
    snapshot_into_table,
    start_history,
    versions_at,
)
from martwright.operators.skew import NO_HOT_KEYS, HotKeys

SCHEMA = "id int, v string, updated_at timestamp_ntz"


def at(day):
    return dt.datetime(2024, 1, day)


def frame(spark, data):
    return spark.createDataFrame([(i, v, at(day)) for i, v, day in data], SCHEMA)


def versions(df):
    return rows(df, "id", "v", "valid_from", "valid_to")


def test_versions_follow_each_other(spark):
    first = start_history(frame(spark, [(1, "a", 1), (2, "b", 1)]))
    second = extend_history(first, frame(spark, [(1, "A", 3), (2, "b", 1), (3, "c", 2)]), "id")
    expected = [
        (1, "A", at(3), None),
        (1, "a", at(1), at(3)),
        (2, "b", at(1), None),
        (3, "c", at(2), None),
    ]
    assert versions(second) == expected
    # Nothing new, and a row that is gone: no change.
    assert versions(extend_history(second, frame(spark, [(1, "A", 3)]), "id")) == expected
    third = extend_history(second, frame(spark, [(1, "AA", 5), (2, "old", 1)]), "id")
    assert (1, "A", at(3), at(5)) in versions(third) and len(versions(third)) == 5


def test_compare(spark):
    left = frame(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 1), (5, None, 1), (6, "x", 1), (6, "x", 1)])
    right = frame(spark, [(1, "a", 1), (2, "B", 1), (4, "d", 1), (5, None, 1), (6, "x", 1)])
    assert dict(compare_tables(left, right, "id").collect()) == {
        "identical": 2,
        "different": 2,
        "only_left": 1,
        "only_right": 1,
    }
    assert dict(compare_tables(left, right, "id", ["updated_at"]).collect())["identical"] == 3


def test_several_versions_of_a_key_in_one_source(spark):
    first = start_history(frame(spark, [(1, "a", 1)]))
    twice = frame(spark, [(1, "c", 3), (1, "b", 2), (1, "b2", 2), (1, "a", 1), (2, "x", 5), (2, "w", 4)])
    found = versions(extend_history(first, twice, "id"))
    assert found == [
        (1, "a", at(1), at(2)),
        (1, "b2", at(2), at(3)),
        (1, "c", at(3), None),
        (2, "w", at(4), at(5)),
        (2, "x", at(5), None),
    ]


def snapshot(spark, name, data, day, **options):
    return snapshot_into_table(spark, name, frame(spark, data), "id", at(day), **options)


def holding(df):
    return rows(df, "id", "v", "valid_from", "valid_to", "ended_on")


def test_snapshots_start_end_and_come_back(spark):
    name = "default.t_snapshots"
    snapshot(spark, name, [(1, "a", 1), (2, "b", 1), (3, "c", 1)], 2)
    snapshot(spark, name, [(1, "A", 3), (2, "b", 1)], 4)
    expected = [
        (1, "A", at(3), None, None),
        (1, "a", at(1), at(3), at(4).date()),
        (2, "b", at(1), None, None),
        (3, "c", at(1), at(4), at(4).date()),
    ]
    assert holding(spark.table(name)) == expected
    files = {f for f in spark.table(name).inputFiles() if "2024-01-04" in f}
    # The run once more: nothing changes.
    assert holding(snapshot(spark, name, [(1, "A", 3), (2, "b", 1)], 4)) == expected
    files = {f for f in spark.table(name).inputFiles() if "2024-01-04" in f}
    snapshot(spark, name, [(1, "A", 3), (3, "C", 6)], 7)
    found = holding(spark.table(name))
    assert (3, "C", at(6), None, None) in found and (2, "b", at(1), at(7), at(7).date()) in found and len(found) == 5
    assert files <= set(spark.table(name).inputFiles())
    # Two changes in one day: both ended versions stay.
    snapshot(spark, name, [(1, "AA", 7), (3, "C", 6)], 8)
    snapshot(spark, name, [(1, "AAA", 8), (3, "C", 6)], 8)
    found = holding(spark.table(name))
    assert {(r[1], r[3]) for r in found if r[0] == 1} == {("a", at(3)), ("A", at(7)), ("AA", at(8)), ("AAA", None)}
    by_time = spark.createDataFrame([(at(d),) for d in range(1, 10)], "t timestamp_ntz")
    crowded = by_time.join(spark.table(name), (F.col("valid_from") <= F.col("t")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("t"))))
    assert crowded.groupBy("t", "id").count().where("count > 1").isEmpty()
    # All rows vanish, and the partition of versions that hold with them.
    assert snapshot(spark, name, [], 9).where("valid_to is null").isEmpty()
    assert snapshot(spark, name, [(5, "n", 9)], 10).where("valid_to is null").count() == 1
    tables.drop_table(spark, name)


def test_missing_rows_may_stay(spark):
    name = "default.t_kept_versions"
    snapshot(spark, name, [(1, "a", 1)], 2)
    assert holding(snapshot(spark, name, [], 3, close_missing=False)) == [(1, "a", at(1), None, None)]
    tables.drop_table(spark, name)


def test_rows_meet_the_version_of_their_time(spark):
    versions = extend_history(start_history(frame(spark, [(1, "a", 2), (2, "b", 2)])), frame(spark, [(1, "A", 5)]), "id")
    versions = versions.drop("updated_at")
    facts = spark.createDataFrame(
        [(10, 1, at(1)), (11, 1, at(2)), (12, 1, at(4)), (13, 1, at(5)), (14, 2, at(9)), (15, 3, at(9)), (16, None, at(9)), (17, 1, None)],
        "fact int, id int, t timestamp_ntz",
    )
    want = [(10, None), (11, "a"), (12, "a"), (13, "A"), (14, "b"), (15, None), (16, None), (17, None)]
    for hot in (NO_HOT_KEYS, HotKeys({1: 3}, 2)):
        assert rows(join_as_of(facts, versions, "id", "t", hot, spread="fact"), "fact", "v") == want
    assert rows(versions_at(versions, at(4)), "id", "v") == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="v"):
        join_as_of(facts.withColumn("v", F.lit(1)), versions, "id", "t", spread="fact")
