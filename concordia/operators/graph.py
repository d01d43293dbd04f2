"""Connected components of an edge table, on request: equivalences themselves aren't transitive.

Labels are parents in a forest. A round looks at every edge once: a node's parent becomes the smallest
grandparent among its neighbours and itself, and so does the parent of the node that was its parent
before, which hooks one tree to another at its root. So trees grow by other trees, not by nodes, and
paths halve: a chain of n nodes, in any order, takes about log2(n) + 2 rounds. Parents only ever get
smaller, so rounds end; they go on until none changes, however many that takes. Labels and edges meet by
merges, so neither passes the driver, as a broadcast would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import by_merge, checkpointed


def components(edges: DataFrame, keep: Callable[[DataFrame], DataFrame] = checkpointed) -> DataFrame:
    """(node, component): the smallest node that each node of edges (a, b: long) reaches.

    Edges go both ways, repeats and loops allowed; edges with a null end are left out. No edges: no rows.
    keep: how a round is written; it cuts lineage. Only whether something changed comes back to the driver.
    """
    edges = keep(edges.select("a", "b").filter("a is not null and b is not null"))
    both = keep(edges.union(edges.select("b", "a")).distinct())
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component")))
    while True:
        parents = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        grand = labels.join(by_merge(parents), "component").select("node", "component", "up")
        near = both.join(by_merge(grand.select(F.col("node").alias("b"), "up")), "b").groupBy(F.col("a").alias("node")).agg(F.min("up").alias("near"))
        lower = keep(grand.join(by_merge(near), "node").select("node", "component", F.least("up", "near").alias("low")))
        # The same for the root of the tree that a node was in; summed up first, whatever the size of the tree.
        hooks = lower.groupBy(F.col("component").alias("node")).agg(F.min("low").alias("hook"))
        after = lower.join(by_merge(hooks), "node", "left").select("node", F.col("component").alias("old"), F.least("low", F.coalesce("hook", "low")).alias("component"))
        after = keep(after)
        labels = after.select("node", "component")
        if after.filter("component <> old").isEmpty():
            return labels
