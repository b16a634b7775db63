"""Connected components of an edge table, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.store import written


def connected_components(edges: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """``node, comp`` for every node of ``edges`` (``a, b``): the smallest node
    it is linked with.  ``start`` may give labels known from some of the edges.  Each round gives a node the smallest label among its
    neighbours' and its own, then that label's label, which doubles the way a
    label travels; every round's labels are a written table.  A node with very
    many links is pre-aggregated per task."""
    edges = edges.where("a <> b").distinct()
    both = written(edges.unionByName(edges.selectExpr("b AS a", "a AS b")), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("comp"))
    if start is not None:
        labels = labels.unionByName(start).groupBy("node").agg(F.min("comp").alias("comp"))
    labels = written(labels, "labels")
    kind = dict(both.dtypes)["a"]
    while True:
        near = both.join(labels.selectExpr("node AS b", "comp"), "b").select(
            F.col("a").alias("node"), "comp", F.lit(None).cast(kind).alias("old"))
        least = (near.unionByName(labels.select("node", "comp", F.col("comp").alias("old")))
                 .groupBy("node").agg(F.min("comp").alias("comp"), F.max("old").alias("old")))
        jumped = least.join(labels.selectExpr("node AS comp", "comp AS further"), "comp", "left")
        labels = written(jumped.withColumn("comp", F.least("comp", F.coalesce("further", "comp")))
                         .select("node", "comp", (F.col("comp") != F.col("old")).alias("new")), "labels")
        if not labels.where("new").take(1):
            return labels.select("node", "comp")
