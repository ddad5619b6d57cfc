"""Connected components of a link table, by hooking and pointer jumping.

Nodes and links stay in Spark.  Every round each root hooks onto its smallest
neighbouring root, pointers jump until flat, and links move to the roots; a
component's roots at least halve, so rounds are logarithmic.  Tables of each
round are stored, so both sides of a join come straight from a scan and
adaptive execution can split a hot root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize


def _flat(parent: DataFrame) -> DataFrame:
    """Jump until every node points at a root."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
        jumped = parent.join(up, "root").select("node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved"))
        parent = materialize(jumped, "parents")
        if not parent.where("moved").limit(1).count():
            return parent.select("node", "root")


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (smallest node reachable) for every node of ``links(u, v)``."""
    links = materialize(links.select("u", "v").where("u != v"), "links")
    known = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
        parent = _flat(materialize(lowest.select("node", F.least("node", "low").alias("root")), "parents"))
        if known is None:
            known = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
            known = materialize(
                known.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "roots"
            )
        for side in ("u", "v"):
            links = links.join(parent.select(F.col("node").alias(side), F.col("root").alias(f"r_{side}")), side)
        links = materialize(
            links.select(F.least("r_u", "r_v").alias("u"), F.greatest("r_u", "r_v").alias("v")).where("u != v").distinct(),
            "links",
        )
        if not links.limit(1).count():
            return known


class Forest:
    """Union-find inside a task, by path halving; the smaller root stays."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def links(self) -> list[tuple[int, int]]:
        """A star for each tree of two nodes or more."""
        return [(r, x) for x in list(self.parent) if (r := self.find(x)) != x]
