"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import map_rows, staged


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, node):
        parent = self.parent
        root = node
        while (above := parent.get(root, root)) != root:
            root = above
        while node != root:
            parent[node], node = root, parent.get(node, node)
        return root

    def join(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self):
        """(member, root) of every member that is not its own root."""
        return ((node, self.find(node)) for node in self.parent)


EDGES_PER_TASK = 500_000


def _contracted(edges: DataFrame) -> DataFrame:
    """The same components from fewer edges: each task turns its edges, a run at a time, into stars."""

    def work(rows):
        forest = Forest()
        for a, b in rows:
            forest.join(a, b)
            if len(forest.parent) >= 2 * EDGES_PER_TASK:
                yield from forest.edges()
                forest = Forest()
        yield from forest.edges()

    return map_rows(edges, work, "u bigint, v bigint", every=20_000)


def _star_round(stars: DataFrame) -> DataFrame:
    """A large-star and a small-star step over edges from larger nodes ``u`` to smaller nodes ``v``."""
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.join(least, "u").where(F.col("v") > F.col("u"))
    large = larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    down = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = large.join(down, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(down.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "components") -> DataFrame:
    """``id, component`` for every node of an edge table of two long columns; the smallest node names its component.

    Edges with a null end and loops are ignored, repeated edges count once, no edges give no rows.
    A round first contracts the edges within tasks of a bounded number of edges, then takes a
    large-star and a small-star step across them; it is a written table. Once a bounded task holds
    all that is left, its contraction is the result. A node of many neighbours costs one
    pre-aggregated minimum and a join that adaptive execution splits.
    """
    ends = edges.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v"))
    ends = ends.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    stars = staged(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), label)
    before = None
    while True:
        # Distinct edges: their number and the sum of their hashes tell whether a round changed anything.
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        tasks = -(-now[0] // EDGES_PER_TASK)
        if now == before or not tasks:
            break
        stars = staged(_contracted(stars.repartition(tasks)).distinct(), label)
        if tasks == 1:
            break
        stars, before = staged(_star_round(stars), label), now
    roots = stars.select(F.col("v").alias("id")).distinct()
    return stars.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
