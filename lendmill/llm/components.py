"""Connected components by contraction, with every step written to the working folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Of edges (x, y): every node with the label of its component (node, label).

    In each round a node is merged into the smallest of its neighbours and itself, and the
    edges are carried over to the merged nodes. Minima are found by aggregates, which reduce
    a hub before the shuffle, and nothing but a count reaches the driver. Node names should
    be hashes, so that no order runs along long paths.
    """
    left = written(edges.select("x", "y").filter("x <> y").distinct(), "edges")
    merged = written(left.select(F.col("x").alias("node")).union(left.select("y")).distinct().withColumn("label", F.col("node")), "nodes")
    while left.limit(1).count():
        both = left.union(left.select("y", "x"))
        least = written(both.groupBy(F.col("x").alias("old")).agg(F.least(F.min("y"), F.col("old")).alias("new")), "least")
        merged = written(
            merged.join(least, merged.label == least.old, "left").select("node", F.coalesce("new", "label").alias("label")), "labels"
        )
        other = least.select(F.col("old").alias("old_y"), F.col("new").alias("new_y"))
        left = written(
            left.join(least, left.x == least.old).join(other, F.col("y") == F.col("old_y")).select(
                F.least("new", "new_y").alias("x"), F.greatest("new", "new_y").alias("y")
            ).filter("x <> y").distinct(),
            "edges",
        )
    return merged
