"""Connected components of a graph given as edges, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablework.sources.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; the root is the least node of the component.

    Each round takes the least label among a node and its neighbours, then the label of that label, which
    roughly doubles the reach. A round's labels are written, so lost executors do not undo rounds; only a count of
    changes reaches the driver. Sums per node combine before the shuffle; joins on a node with many edges are dealt over
    tasks by adaptive execution.
    """
    pairs = edges.select("a", "b").filter("a <> b")
    both = materialize(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels"
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("far"))
        moved = materialize(
            lower.join(jump, "low").select("node", F.least("low", "far").alias("root"), (F.least("low", "far") != F.col("old")).alias("moved")), "labels"
        )
        labels = moved.select("node", "root")
        if moved.filter("moved").isEmpty():
            return labels
