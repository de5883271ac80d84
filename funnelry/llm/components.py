"""Connected components of an edge list, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelry.sources.tables import stored


#: Rows of labels that one task writes; small edge lists take few tasks a round.
TASK_ROWS = 1 << 20


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node in an edge.

    Each round takes the smallest label among neighbours, then the label of that label, so
    rounds grow with the logarithm of the longest path. Each round's labels are written to
    the shared folder, in as many files as there are edges for. ``edges`` is read twice: give
    a stored table. Nodes must not be null.
    """
    tasks = 1 + 2 * edges.count() // TASK_ROWS
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = stored(both.union(both.select("other", "node")).distinct().coalesce(tasks), "edges")
    first = both.groupBy("node").agg(F.min("other").alias("near"))
    own = first.select("node", F.least("node", "near").alias("root"))
    labels = stored(own.coalesce(tasks), "labels")
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("root").alias("near"))
        near = both.join(seen, "other").groupBy("node").agg(F.min("near").alias("near"))
        closer = labels.join(near, "node").select(
            "node", F.least("root", "near").alias("next"), F.col("root").alias("before")
        )
        roots = labels.select(F.col("node").alias("next"), F.col("root").alias("far"))
        moved = stored(
            closer.join(roots, "next").select(
                "node", F.least("next", "far").alias("root"), "before"
            ).coalesce(tasks),
            "labels",
        )
        labels = moved.select("node", "root")
        if moved.filter("root != before").isEmpty():
            return labels


def forest(labels: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Edges that make the same components as those the labels come from: node to root.

    One edge for each node that is no root, however many edges there were.
    """
    return labels.filter("node != root").select(F.col("node").alias(a), F.col("root").alias(b))
