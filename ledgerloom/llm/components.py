"""Connected components of a graph that no single task could hold."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import work_table


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges``(a, b), both long; root is the smallest node that can be reached.

    Alternates two steps until every node hangs on one root: each node hands its larger neighbours, then its smaller ones,
    to the smallest node it knows. A step is a minimum per node, reduced in each task first, and a join with it, in which
    Spark splits nodes of very many neighbours. Each round is written, so lost executors cost no earlier one.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        both = links.distinct().withColumn("pair", F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
        both = both.select(F.inline("pair"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        wide = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        near = wide.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        links = work_table(near.filter("a <> b").distinct(), "links")
        ends = links.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")),
                                             F.struct(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))))
        ends = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
        if ends.filter("down > 1 or down + up > 1").isEmpty():
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
