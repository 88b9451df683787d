"""Small documents with every awkward case, and the shared tables."""

import os
import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
PROSE = (
    "The river carried silt past the old mill while farmers counted sacks and argued about the price of grain "
    "in the market square until the bells rang and everyone went home to supper with bread soup and a story"
).split()
# Columns with names that operators use inside.
CLASHING = ("id", "n", "h", "row", "kind", "start", "end", "label", "token", "rep", "__n", "bucket", "key", "match")


def prose(seed, words=120):
    rng = random.Random(seed)
    lines = [" ".join(rng.choice(PROSE) + rng.choice(["", "", "", ","]) for _ in range(12)) for _ in range(words // 12)]
    return ".\n".join(lines) + "."


LONG = " ".join(prose(s, 240) for s in range(60))
AWKWARD = [
    (1, prose(1)),
    (2, None),
    (3, ""),
    (4, "   \n\t "),
    (5, prose(1)),
    (6, prose(6)),
    (6, prose(6)),
    (7, LONG),
    (8, LONG[: len(LONG) // 2]),
    (9, "word"),
    (10, "é😀 ß\x00\x01x\x02   日本 <|endoftext|> +1 (743) 555-3824 a.b@c.example"),
    (11, prose(1).replace("grain", "wheat", 1)),
    (None, prose(12)),
    (None, None),
]


@pytest.fixture(scope="session")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, "doc_id long, text string")
    return df.withColumns({c: F.lit("x") for c in CLASHING}).withColumn("source", F.lit("a/b")).repartition(3)


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def shared(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def shared_labels(spark, shared):
    return spark.read.parquet(f"{SF}/labels.parquet")
