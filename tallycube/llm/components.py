"""Connected components of an edge table, by the smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tallycube.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b, both long); root is the smallest node of the component.

    Each round takes the smallest root among a node's neighbours and then the root of that root, so that long chains
    shrink by half. Rounds are written to the shared folder; only a count of changed rows comes to the driver.
    """
    pairs = edges.select("a", "b").filter("a <> b").distinct()
    both = written(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "roots")
    while True:
        told = both.join(roots, both["a"] == roots["node"]).groupBy(F.col("b").alias("node")).agg(F.min("root").alias("told"))
        lower = roots.join(told, "node").select("node", F.col("root").alias("was"), F.least("root", "told").alias("root"))
        above = roots.select(F.col("node").alias("root"), F.col("root").alias("top"))
        new = written(lower.join(above, "root", "left").select("node", "was", F.coalesce("top", "root").alias("root")), "roots")
        changed = new.filter("root <> was").limit(1).count()
        roots = new.select("node", "root")
        if not changed:
            return roots
