"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.runtime import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``edges``, root being the smallest node of its
    component.

    Each round gives a node the smallest root among its neighbours and then the root
    of that root, so paths halve. Neighbours are combined in each task before the
    shuffle; every round is a written table.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = both.unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other")))
    both = materialize(both.where(F.col("node") != F.col("other")), "cc-edges")
    roots = materialize(
        both.groupBy("node").agg(F.min("other").alias("least"))
        .select("node", F.least("node", "least").alias("root")), "cc-roots")
    while True:
        seen = both.join(roots.withColumnRenamed("node", "other"), "other")
        seen = seen.groupBy("node").agg(F.min("root").alias("seen"))
        hooked = roots.join(seen, "node").select("node", "root", F.least("root", "seen").alias("new"))
        above = roots.select(F.col("node").alias("new"), F.col("root").alias("above"))
        moved = materialize(
            hooked.join(above, "new", "left").select(
                "node", F.least("new", F.coalesce("above", "new")).alias("root"),
                (F.least("new", F.coalesce("above", "new")) != F.col("root")).alias("changed")), "cc-roots")
        roots = moved.select("node", "root")
        if moved.where("changed").isEmpty():
            return roots
