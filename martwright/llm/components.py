"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.common import stored


def _followed(links: pa.Table) -> pa.Table:
    """Columns v and label, the smallest vertex reachable, for every vertex of the links."""
    parent: dict = {}

    def root(v):
        while parent.setdefault(v, v) != v:
            parent[v] = v = parent[parent[v]]
        return v

    for a, b in zip(*(c.to_pylist() for c in links.columns), strict=True):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    vertices = list(parent)
    kind = links.schema.field("a").type
    return pa.table({"v": pa.array(vertices, kind), "label": pa.array(map(root, vertices), kind)})


def components(links: DataFrame, few: int = 0) -> DataFrame:
    """Columns v and label for every vertex of the links (a, b): label is the smallest vertex reachable.

    In a round each vertex hears the labels of its neighbours, of its label and of itself and takes the
    smallest, so that chains halve. All come by one join and one grouping: Spark's driver keeps a thread
    for each exchange and broadcast of the last minute, and a broadcast's rows. Labels are stored after
    each round; minima combine before the shuffle, so a vertex with very many links costs one row per task.
    At most `few` links, of whole numbers or strings, are followed on the driver, which takes no exchange.
    """
    links = links.where("a <> b").select("a", "b")
    kind = links.schema["a"].dataType
    if few and isinstance(kind, T.IntegralType | T.StringType):
        some = links.limit(few + 1).toArrow()
        if some.num_rows <= few:
            schema = T.StructType([T.StructField("v", kind), T.StructField("label", kind)])
            return stored(links.sparkSession.createDataFrame(_followed(some), schema), "labels")
    edges = stored(links.union(links.select("b", "a")).distinct(), "edges")
    labels = edges.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("near"))
    labels = stored(labels.select("v", F.least("v", "near").alias("label")), "labels")
    while True:
        own = labels.select(F.col("v").alias("a"), F.explode(F.array("v", "label")).alias("b"))
        heard = (
            edges.union(own)
            .join(labels.toDF("b", "label"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("label").alias("label"), F.min(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("old"))
        )
        new = heard.select("v", "label", (F.col("label") < F.col("old")).alias("moved"))
        new = stored(new, "labels")
        labels = new.select("v", "label")
        if new.where("moved").isEmpty():
            return labels
