import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.operators.rank import Ranking
from martwright.operators.tiles import behind, select_ranks, with_tiles

SCHEMA = "id long, k int, d date"


def frame(spark, n, keys=None, seed=1):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n + 1), n)
    data = []
    for i in ids:
        k = rng.choice(keys) if keys else rng.randrange(-3, 10)
        k = None if rng.random() < 0.2 else k
        data.append((i, k, None if k is None else dt.date(2024, 1, 1) + dt.timedelta(days=k % 9)))
    return spark.createDataFrame(data, SCHEMA).repartition(3).cache()


def built_in(df, rankings, tiles):
    orders = {
        r.name: Window.orderBy(r.key.desc_nulls_first() if r.descending else r.key.asc_nulls_last(), "id") for r in rankings
    }
    return df.withColumns({name: F.ntile(tiles).over(w) for name, w in orders.items()})


@pytest.fixture
def rankings(spark):
    return [Ranking("up", F.col("k")), Ranking("down", F.col("k"), True), Ranking("day", F.col("d"))]


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 23, 400])
def test_tiles_equal_the_window_function(spark, rankings, n):
    df = frame(spark, n)
    for tiles in (1, 5):
        assert rows(with_tiles(df, "id", rankings, tiles)) == rows(built_in(df, rankings, tiles))


@pytest.mark.parametrize("keys", [None, [5], [0] * 9 + [1]])
def test_refined_brackets_find_the_same_borders(spark, rankings, keys):
    """Samples far below the number of rows, with one key for most rows: several rounds."""
    df = frame(spark, 1500, keys)
    want = rows(built_in(df, rankings, 5))
    for sample in (12, 200):
        assert rows(with_tiles(df, "id", rankings, 5, sample)) == want


def test_any_rank(spark, rankings):
    df = frame(spark, 300)
    for ranking in rankings:
        order = ranking.key.desc_nulls_first() if ranking.descending else ranking.key.asc_nulls_last()
        ids = [r["id"] for r in df.orderBy(order, "id").collect()]
        (found,) = select_ranks(df, "id", [(ranking, [1, 2, 77, 299, 300])], 300, sample=40)
        assert {rank: b.id for rank, b in found.items()} == {rank: ids[rank - 1] for rank in (1, 2, 77, 299, 300)}
        for rank, border in found.items():
            assert df.where(~behind(ranking, "id", border)).count() == rank


def test_no_shuffle_and_no_sort(spark, rankings):
    plan = with_tiles(frame(spark, 50), "id", rankings, 5)._jdf.queryExecution().executedPlan().toString()
    own = plan.split("InMemoryRelation")[0]
    assert "Exchange" not in own and "Sort" not in own and "Join" not in own
