"""Connected components by smallest label, for small and large graphs alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stash


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """node, root (the smallest node of its component) for every node in edges (a, b).

    Each round every node takes the smallest root among its own and its neighbours', then the root of its root (path
    halving), so that chains of length n take about log n rounds. Edges and roots are written tables in the shared folder;
    nothing but one count a round reaches the driver. Self-loops and repeated edges do no harm; null ends are ignored."""
    e = edges.filter("a is not null and b is not null").select("a", "b")
    both = stash(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = stash(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).select(F.col("a").alias("node"), "root"), "roots")
    for _ in range(rounds):
        near = both.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = roots.join(near.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "near").alias("new"))
        up = roots.select(F.col("node").alias("new"), F.col("root").alias("above"))
        step = stash(step.join(up, "new", "left").select("node", "root", F.coalesce(F.least("new", "above"), F.col("new")).alias("new")), "roots")
        changed = not step.filter("new <> root").isEmpty()
        roots = step.select("node", F.col("new").alias("root"))
        if not changed:
            return roots
    raise RuntimeError(f"components not settled after {rounds} rounds")
