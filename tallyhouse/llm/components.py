"""Connected components of links, by joins that keep every step in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import Stages


def components(links: DataFrame, stages: Stages) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is the smallest node that can be reached.

    Large-star and small-star rounds: each node hooks its neighbours to the smallest one it knows, so long
    chains fold up in logarithmically many rounds. Only minima per node are shuffled, combined before.
    The driver sees one count per round.
    """
    edges = stages.keep(links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
                        .filter("node != root").distinct())
    while True:
        # Large-star: neighbours above a node go to the smallest neighbour, or to the node itself.
        both = edges.unionByName(edges.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        large = both.filter("root > node").join(least, "node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        large = stages.keep(large.filter("node != root").distinct())
        # Small-star: neighbours below a node, and the node, go to the smallest of them.
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node")
        small = small.select(F.col("root").alias("node"), F.col("least").alias("root")).unionByName(
            least.select("node", F.col("least").alias("root")))
        after = stages.keep(small.filter("node != root").distinct())
        changed = after.join(edges, ["node", "root"], "left_anti").limit(1).count() or \
            edges.join(after, ["node", "root"], "left_anti").limit(1).count()
        edges = after
        if not changed:
            return edges
