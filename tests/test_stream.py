import datetime as dt

import pytest
from pyspark.sql import functions as F

from martwright.operators import merge, stream, tables

SCHEMA = "id long, v string, at timestamp_ntz, m date"


def frame(spark, data):
    return spark.createDataFrame([(i, v, dt.datetime(2024, 1, d), dt.date(2024, m, 1)) for i, v, d, m in data], SCHEMA)


def content(spark, name):
    return [(r["id"], r["v"], r["m"].month) for r in spark.table(name).orderBy("id").collect()]


def run(spark, folder, checkpoint, name, by="m"):
    changes = spark.readStream.schema(SCHEMA).parquet(folder)
    query = stream.merge_stream(changes, name, "changes", checkpoint, "id", "at", by)
    query.awaitTermination(60)
    assert not query.isActive and query.exception() is None


@pytest.mark.parametrize("by", ["m", None])
def test_batches_of_files_are_merged_once(spark, tmp_path, by, monkeypatch):
    folder, checkpoint, name = str(tmp_path / "in"), str(tmp_path / "how_far"), f"default.t_stream_{by}".lower()
    tables.replace_table(frame(spark, [(1, "a", 1, 1), (2, "b", 1, 1), (3, "c", 1, 2)]), name, partition_by=by)
    frame(spark, [(2, "B", 3, 1), (2, "old", 2, 1), (4, "d", 2, 3)]).write.parquet(folder)
    run(spark, folder, checkpoint, name, by)
    assert content(spark, name) == [(1, "a", 1), (2, "B", 1), (3, "c", 2), (4, "d", 3)]
    frame(spark, [(3, "C", 4, 2), (1, "A", 4, 2)]).write.mode("append").parquet(folder)
    # Nothing is merged where nothing is new.
    run(spark, folder, checkpoint, name, by)
    expected = [(1, "A", 2), (2, "B", 1), (3, "C", 2), (4, "d", 3)]
    assert content(spark, name) == expected
    with monkeypatch.context() as patch:
        patch.setattr(merge, "merge_into_table", lambda *a, **k: 1 / 0)
        run(spark, folder, checkpoint, name, by)
    # A run without the checkpoint begins anew, with the new file in its first batch.
    frame(spark, [(9, "n", 5, 1)]).write.mode("append").parquet(folder)
    run(spark, folder, str(tmp_path / "lost"), name, by)
    assert content(spark, name) == [*expected, (9, "n", 1)]
    tables.drop_table(spark, name)


@pytest.mark.parametrize("by", ["m", None])
def test_a_batch_that_died_is_replayed(spark, monkeypatch, by):
    """The run dies before the switch, or after it: the replay leaves the same rows and number."""
    changes = frame(spark, [(1, "A", 3, 2), (5, "e", 3, 1)])
    expected = [(1, "A", 2), (2, "b", 1), (5, "e", 1)]
    for dies in ("switch_partitions", "switch_table", "finish_switch", "remove_folder"):
        name = f"default.t_replay_{by}_{dies}".lower()
        tables.replace_table(frame(spark, [(1, "a", 1, 1), (2, "b", 1, 1)]), name, partition_by=by)
        calls = []
        real = getattr(tables, dies)

        def lost(*args, calls=calls, real=real, dies=dies, **options):
            calls.append(1)
            if dies != "finish_switch" or len(calls) == 3:
                raise RuntimeError("lost")
            return real(*args, **options)

        with monkeypatch.context() as patch:
            patch.setattr(tables, dies, lost)
            try:
                stream.merge_batch(spark, name, "s", changes, 7, "id", "at", by)
            except RuntimeError:
                pass
        stream.merge_batch(spark, name, "s", changes, 7, "id", "at", by)
        assert content(spark, name) == expected
        assert tables.properties(spark, name)[stream.BATCH + "s"] == ":7"
        assert not stream.merge_batch(spark, name, "s", changes.withColumn("v", F.lit("x")), 7, "id", "at", by)
        assert not stream.merge_batch(spark, name, "s", changes, 3, "id", "at", by)
        assert stream.merge_batch(spark, name, "other", changes.limit(0), 0, "id", "at", by)
        assert content(spark, name) == expected
        tables.drop_table(spark, name)
