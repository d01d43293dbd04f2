"""Connected components of an edge table; rounds are staged, so a lost executor costs one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import graph
from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node that has an edge to another.

    edges: a, b (long), in any direction, repeats and loops allowed. No edges: no rows. Rounds grow with the
    logarithm of a chain's length and aren't capped.
    """
    edges = staged(edges.select("a", "b").filter("a <> b"), "links")
    rows = 2 * edges.count()
    return graph.components(edges, lambda df: staged(df, "labels", rows=rows))
