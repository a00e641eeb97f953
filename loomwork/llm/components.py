"""Connected components of an edge table, by rounds of contraction; nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (a, b: bigint); root is the smallest node reachable.

    Each round points every node at its smallest neighbour (an aggregate that combines on the map side, so a
    hub costs one row a task), follows the pointers to the end, and replaces the nodes of the remaining edges
    by what they point at. Edges within a component vanish; the number of components with edges at least
    halves each round. Loops and repeated edges do no harm; no edges give no rows.
    """
    left = written(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "cc-edges")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        ends = left.select(F.col("hi").alias("node"), F.col("lo").alias("to")).unionAll(left.select(F.col("lo").alias("node"), F.col("lo").alias("to")))
        at = written(ends.groupBy("node").agg(F.min("to").alias("root")), "cc-roots")
        while True:  # root of root, until nothing changes
            up = at.select(F.col("node").alias("root"), F.col("root").alias("up"))
            new = written(at.select("node", "root").join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") < F.col("root")).alias("moved")), "cc-roots")
            forget(at)
            at = new
            if new.where("moved").isEmpty():
                break
        at = at.select("node", "root")
        maps.append(at)
        hi, lo = at.select(F.col("node").alias("hi"), F.col("root").alias("r_hi")), at.select(F.col("node").alias("lo"), F.col("root").alias("r_lo"))
        old, left = left, written(left.join(hi, "hi").join(lo, "lo").where("r_hi <> r_lo").select(F.greatest("r_hi", "r_lo").alias("hi"), F.least("r_hi", "r_lo").alias("lo")).distinct(), "cc-edges")
        forget(old)
    if not maps:
        return edges.sparkSession.createDataFrame([], "node bigint, root bigint")
    out = maps[0]
    for m in maps[1:]:
        up = m.select(F.col("node").alias("root"), F.col("root").alias("up"))
        out = out.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return out
