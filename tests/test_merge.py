import datetime as dt
import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.operators import merge, tables

SCHEMA = "id long, v string, m timestamp_ntz"


def month(number):
    return dt.datetime(2024, number, 1)


def frame(spark, data):
    return spark.createDataFrame([(i, v, month(m)) for i, v, m in data], SCHEMA).coalesce(1)


@pytest.fixture
def target(spark, request):
    name = f"t_{request.node.name.replace('[', '_').replace(']', '')}"
    before = frame(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)])
    before.write.partitionBy("m").format("parquet").saveAsTable(name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def content(spark, name):
    return [(r["id"], r["v"], r["m"].month) for r in spark.table(name).orderBy("id").collect()]


def test_update_insert_and_untouched_partition(spark, target):
    files = {f for f in spark.table(target).inputFiles() if "m=2024-03" in f}
    merge.merge_into_table(spark, target, frame(spark, [(2, "B", 1), (5, "e", 2)]), "id", "m")
    assert content(spark, target) == [(1, "a", 1), (2, "B", 1), (3, "c", 2), (4, "d", 3), (5, "e", 2)]
    assert files <= set(spark.table(target).inputFiles())


def test_key_moves_and_empties_its_partition(spark, target):
    merge.merge_into_table(spark, target, frame(spark, [(4, "D", 2)]), "id", "m")
    assert content(spark, target) == [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "D", 2)]


def test_null_partition(spark, target):
    lost = spark.createDataFrame([(9, "n", None), (1, "a2", None)], SCHEMA)
    merge.merge_into_table(spark, target, lost, "id", "m")
    merge.merge_into_table(spark, target, frame(spark, [(9, "N", 1)]), "id", "m")
    found = {r["id"]: (r["v"], r["m"]) for r in spark.table(target).collect()}
    assert found[9] == ("N", month(1)) and found[1] == ("a2", None) and len(found) == 5
    merge.merge_into_table(spark, target, frame(spark, [(1, "a3", 1)]), "id", "m")
    found = {r["id"]: (r["v"], r["m"]) for r in spark.table(target).collect()}
    assert found[1] == ("a3", month(1)) and len(found) == 5


def test_empty_updates_and_repeat(spark, target):
    before = content(spark, target)
    merge.merge_into_table(spark, target, frame(spark, []), "id", "m")
    assert content(spark, target) == before
    for _ in range(2):
        merge.merge_into_table(spark, target, frame(spark, [(1, "z", 1)]), "id", "m")
    assert content(spark, target)[0] == (1, "z", 1) and len(content(spark, target)) == 4


def test_unpartitioned(spark):
    frame(spark, [(1, "a", 1), (2, "b", 1)]).write.format("parquet").saveAsTable("t_flat")
    merge.merge_into_table(spark, "t_flat", frame(spark, [(2, "B", 1), (3, "c", 1)]), "id")
    assert content(spark, "t_flat") == [(1, "a", 1), (2, "B", 1), (3, "c", 1)]
    spark.sql("DROP TABLE t_flat")


def test_interrupted_merge_is_finished_later(spark, target, monkeypatch):
    """The run dies when files are in place; the next merge, of something else, completes both."""
    finish = tables.finish_switch
    calls = []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return finish(*args)

    monkeypatch.setattr(tables, "finish_switch", dies)
    with pytest.raises(RuntimeError):
        merge.merge_into_table(spark, target, frame(spark, [(4, "D", 2)]), "id", "m")
    monkeypatch.undo()
    assert content(spark, target)[3] == (4, "d", 3)
    merge.merge_into_table(spark, target, frame(spark, [(1, "A", 1)]), "id", "m")
    assert content(spark, target) == [(1, "A", 1), (2, "b", 1), (3, "c", 2), (4, "D", 2)]


class Steps:
    """Counts the steps that change the catalog or delete files, and fails before one of them."""

    def __init__(self, monkeypatch, spark, fail_at=None):
        self.count, self.fail_at = 0, fail_at
        sql, remove = type(spark).sql, tables.remove_folder
        changes = ("ALTER", "CREATE TABLE", "MSCK", "DROP")
        monkeypatch.setattr(type(spark), "sql", lambda s, text, *a, **k: (self.step() if text.startswith(changes) else None, sql(s, text, *a, **k))[1])
        monkeypatch.setattr(tables, "remove_folder", lambda *a: (self.step(), remove(*a))[1])

    def step(self):
        self.count += 1
        if self.count == self.fail_at:
            raise RuntimeError("lost")


BEFORE = [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", 3)]
MERGED = [(1, "a", 1), (2, "B", 2), (3, "c", 2), (4, "D", 2), (5, "e", 4)]
REBUILT = [(1, "x", 1), (2, "y", 2), (7, "z", 5)]


@pytest.mark.parametrize("by", ["m", None])
@pytest.mark.parametrize("change", ["merge", "rebuild"])
def test_no_step_that_fails_loses_rows(spark, monkeypatch, by, change):
    """Rows are old or new after a failure between any two steps, and the next run completes the change."""

    def apply(name):
        if change == "merge":
            merge.merge_into_table(spark, name, frame(spark, [(2, "B", 2), (4, "D", 2), (5, "e", 4)]), "id", by)
        else:
            tables.replace_table(frame(spark, REBUILT), name, partition_by=by)

    wanted = MERGED if change == "merge" else REBUILT
    at = 1
    while True:
        name = f"default.t_steps_{change}_{by}_{at}".lower()
        tables.replace_table(frame(spark, BEFORE), name, partition_by=by, latest=["m"])
        with monkeypatch.context() as patch:
            steps = Steps(patch, spark, at)
            try:
                apply(name)
                failed = False
            except RuntimeError:
                failed = True
        spark.catalog.refreshTable(name)
        found = content(spark, name)
        # A row is what it was or what it becomes; keys that no partition has yet to change are there.
        assert all(r in BEFORE or r in wanted for r in found)
        if by is None:
            assert found in (BEFORE, wanted)
        if not failed:
            assert found == wanted
        apply(name)
        assert content(spark, name) == wanted
        assert merge.latest_of_table(spark, name, "m") == max(month(m) for _, _, m in wanted)
        tables.drop_table(spark, name)
        if not failed:
            break
        at += 1 if by is None else 2
    assert at > 3


def test_a_failing_write_leaves_the_partitioned_table(spark, monkeypatch):
    name = "default.t_second_write"
    tables.replace_table(frame(spark, BEFORE), name, partition_by="m")
    broken = frame(spark, [(2, "b", 1)]).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        tables.replace_table(broken, name, partition_by="m")
    with pytest.raises(Exception, match="no"):
        merge.merge_into_table(spark, name, broken, "id", "m")
    # The second write of a merge: the rows that stay.
    unique = merge.check_unique_key
    monkeypatch.setattr(merge, "check_unique_key", lambda *a: (unique(*a), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        merge.merge_into_table(spark, name, frame(spark, [(2, "B", 1)]), "id", "m")
    assert content(spark, name) == BEFORE
    tables.drop_table(spark, name)


def test_other_columns_replace_the_table_and_a_lost_rename_is_undone(spark, monkeypatch):
    for by in ("m", None):
        name = f"default.t_other_{by}".lower()
        tables.replace_table(frame(spark, BEFORE), name, partition_by=by)
        wider = frame(spark, REBUILT).withColumn("w", F.lit(1))
        assert tables.replace_table(wider, name, partition_by=by).where("w = 1").count() == 3
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old_x")
        tables.recover_table(spark, name)
        assert spark.table(name).count() == 3
        tables.drop_table(spark, name)
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("t_other")]


def test_each_row_is_written_once(spark, target):
    """A merge leaves one new file set: the updates and the rows that stay of the partitions concerned."""
    merge.merge_into_table(spark, target, frame(spark, [(2, "B", 1), (5, "e", 2)]), "id", "m")
    per_file = spark.table(target).groupBy(F.input_file_name().alias("file")).count().collect()
    fresh = [r["count"] for r in per_file if f"{target}__" in r["file"]]
    assert sum(fresh) == 4 and len(per_file) - len(fresh) == 1


def test_largest_values_are_noted(spark):
    name = "default.t_latest"
    tables.replace_table(frame(spark, BEFORE), name, partition_by="m", latest=["m", "id"])

    def noted():
        jobs = []
        before = tables.largest
        tables.largest = lambda *a: (jobs.append(a), before(*a))[1]
        try:
            return merge.latest_of_table(spark, name, "id"), len(jobs)
        finally:
            tables.largest = before

    assert noted() == (4, 0)
    merge.merge_into_table(spark, name, frame(spark, [(9, "n", 2)]), "id", "m")
    assert noted() == (9, 0)
    merge.merge_into_table(spark, name, frame(spark, [(1, "A", 1)]), "id", "m")
    assert noted() == (9, 0)
    # The row that held the largest month moves to an earlier one: the table is looked at again.
    merge.merge_into_table(spark, name, frame(spark, [(4, "D", 1)]), "id", "m")
    assert merge.latest_of_table(spark, name, "m") == month(2)
    assert noted() == (9, 0)
    tables.replace_table(frame(spark, []), name, partition_by="m", latest=["m", "id"])
    assert merge.latest_of_table(spark, name, "id") is None
    tables.drop_table(spark, name)


def test_keys_that_keep_their_partition_are_not_looked_for(spark, target):
    merge.merge_into_table(spark, target, frame(spark, [(2, "B", 1), (5, "e", 4)]), "id", "m", fixed_partition=True)
    assert content(spark, target) == [(1, "a", 1), (2, "B", 1), (3, "c", 2), (4, "d", 3), (5, "e", 4)]


def test_no_folder_is_left(spark, target):
    shared = merge.shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    merge.merge_into_table(spark, target, frame(spark, [(1, "A", 1)]), "id", "m")
    merge.merge_into_table(spark, target, frame(spark, []), "id", "m")
    with pytest.raises(merge.DuplicateKeys):
        merge.merge_into_table(spark, target, frame(spark, [(1, "x", 1), (1, "y", 1)]), "id", "m")
    assert set(os.listdir(shared)) == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_merge_keeps_the_cluster_layout(spark):
    spread = spark.range(40_000).select("id", F.lit("v").alias("v"), F.lit(month(1)).cast("timestamp_ntz").alias("m"))
    tables.replace_table(spread, "t_laid", cluster_by=["id"])
    merge.merge_into_table(spark, "t_laid", frame(spark, [(0, "x", 1), (39_999, "y", 1)]), "id", cluster_by=["id"])
    ranges = spark.table("t_laid").groupBy(F.input_file_name()).agg(F.min("id"), F.max("id")).collect()
    edges = sorted((r[1], r[2]) for r in ranges)
    assert all(a[1] < b[0] for a, b in zip(edges[:-1], edges[1:], strict=True))
    assert spark.table("t_laid").count() == 40_000
    spark.sql("DROP TABLE t_laid")


def test_failed_rebuild_leaves_the_old_table(spark):
    tables.replace_table(frame(spark, [(1, "a", 1)]), "t_kept")
    broken = frame(spark, [(2, "b", 1)]).withColumn("v", F.raise_error(F.lit("no")))
    with pytest.raises(Exception, match="no"):
        tables.replace_table(broken, "t_kept")
    assert content(spark, "t_kept") == [(1, "a", 1)]
    grown = spark.table("t_kept").union(frame(spark, [(2, "b", 1)]))
    assert content(spark, "t_kept") and tables.replace_table(grown, "t_kept").count() == 2
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("t_kept")] == ["t_kept"]
    spark.sql("DROP TABLE t_kept")


def test_duplicate_key_is_refused(spark, target):
    with pytest.raises(merge.DuplicateKeys):
        merge.merge_into_table(spark, target, frame(spark, [(1, "x", 1), (1, "y", 1)]), "id", "m")
    assert len(content(spark, target)) == 4


@pytest.mark.parametrize("change", ["added", "dropped", "retyped"])
def test_schema_change_is_refused(spark, target, change):
    updates = frame(spark, [(1, "x", 1)])
    updates = {
        "added": updates.withColumn("extra", F.lit(1)),
        "dropped": updates.drop("v"),
        "retyped": updates.withColumn("v", F.lit(1)),
    }[change]
    with pytest.raises(merge.SchemaChanged):
        merge.merge_into_table(spark, target, updates, "id", "m")


def test_changed_since_takes_the_earlier_bound(spark):
    moments = spark.createDataFrame(
        [(i, dt.datetime(2024, 1, i)) for i in range(1, 11)], "id int, at timestamp_ntz"
    )
    run_at = dt.datetime(2024, 1, 9)

    def found(newest):
        return [r[0] for r in rows(moments.where(merge.changed_since(F.col("at"), newest, run_at)), "id")]

    assert sorted(found(dt.datetime(2024, 1, 4))) == [5, 6, 7, 8, 9, 10]
    assert sorted(found(dt.datetime(2024, 1, 8))) == [7, 8, 9, 10]
    assert sorted(found(None)) == [7, 8, 9, 10]


@pytest.fixture
def elsewhere(monkeypatch):
    """This process runs hours away from the session's time zone."""
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    yield
    monkeypatch.undo()
    time.tzset()


def test_time_zone_of_the_process_plays_no_part(spark, target, elsewhere):
    merge.merge_into_table(spark, target, frame(spark, [(2, "B", 2), (4, "D", 2)]), "id", "m")
    assert content(spark, target) == [(1, "a", 1), (2, "B", 2), (3, "c", 2), (4, "D", 2)]
    moments = spark.createDataFrame([(dt.datetime(2024, 1, 6, h),) for h in (0, 1, 6)], "at timestamp_ntz")
    newer = moments.where(merge.changed_since(F.col("at"), None, dt.datetime(2024, 1, 9)))
    assert newer.count() == 2


def test_filter_literal_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    frame(spark, [(1, "a", 1)]).write.parquet(path)
    bound = merge.changed_since(F.col("m"), None, dt.datetime(2024, 1, 9))
    plan = spark.read.parquet(path).where(bound)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(m,2024-01-06" in plan
