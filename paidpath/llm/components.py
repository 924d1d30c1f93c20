"""Connected components of a link table, by pointer jumping over Spark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paidpath.llm.tables import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; component: the smallest node
    reachable. Null ends are ignored. Every round joins labels along the links, takes the
    smallest and follows it once more, so rounds grow as the logarithm of a chain's length;
    sums and minima are combined before each shuffle, so a hub with many links is spread.
    Each round's labels are a written table: a lost executor costs one round at most."""
    pairs = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL AND x <> y")
    edges = written(pairs.union(pairs.select("y", "x")).distinct(), "edges")
    labels = written(edges.groupBy("x").agg(F.min("y").alias("m"))
                     .select(F.col("x").alias("node"), F.least("x", "m").alias("component")), "labels")
    while True:
        near = (edges.join(labels, F.col("y") == F.col("node")).groupBy("x")
                .agg(F.min("component").alias("m")))
        hooked = (labels.join(near, F.col("node") == F.col("x"))
                  .select("node", F.col("component").alias("was"), F.least("component", "m").alias("c")))
        # a root that saw a smaller label hands it to all that point at it
        roots = hooked.groupBy(F.col("was").alias("root")).agg(F.min("c").alias("r"))
        moved = hooked.join(roots, F.col("was") == F.col("root")).select("node", "was", F.least("c", "r").alias("c"))
        after = written(moved, "labels")
        jump = after.select(F.col("node").alias("via"), F.col("c").alias("far"))
        after = written(after.join(jump, F.col("c") == F.col("via"), "left")
                        .select("node", "was", F.least("c", F.coalesce("far", "c")).alias("component")), "labels")
        changed = after.where("component <> was").limit(1).count()
        labels = after.select("node", "component")
        if not changed:
            return labels
