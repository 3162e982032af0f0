"""Connected components of an edge table."""

from pyspark.sql import DataFrame, functions as F

from parley.llm.common import written

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b: long, not null); a component is named by its
    smallest node. Each round a node takes the least label around it and then that label's own label, so
    the way to the smallest node is halved; labels are tables in the shared folder, and a node of very
    many edges is reduced by partial minima. Repeated edges and loops do no harm; no edges, no rows."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    for _ in range(MAX_ROUNDS):
        around = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        step = labels.join(around, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        own = labels.select(F.col("node").alias("new"), F.col("component").alias("next"))
        labels2 = written(step.join(own, "new").select("node", "old", F.least("new", "next").alias("component")), "labels")
        labels = labels2.select("node", "component")
        if labels2.filter("old <> component").limit(1).count() == 0:
            return labels
    raise RuntimeError(f"components are not settled after {MAX_ROUNDS} rounds")
