"""Connected components of a table of links.

Every task joins the links it holds, so that each of its nodes hangs on the least it
reaches there; alternating large and small stars then connect what lies in several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin.session import cut_lineage

ROWS_PER_TASK = 200_000
HELD_LINKS = 1_000_000  # links that a task joins at a time


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is linked to the least of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).repartition("u")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u and its smaller neighbours are linked to the least of them; v < u throughout."""
    down = edges.repartition("u")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    own = joined.select("u", F.col("m").alias("v"))
    others = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return own.union(others).where("u <> v").distinct()


def joined_links(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stars with the same components: every node but the least of a component, with that."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = parent[above]
            node = above
        return node

    for u, v in links:
        a, b = root(u), root(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(node, root(node)) for node in list(parent) if root(node) != node]


def _joined_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, int]] = []

    def stars() -> pa.RecordBatch:
        found = joined_links(held)
        return pa.RecordBatch.from_arrays([pa.array([s[i] for s in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

    for batch in batches:
        held += zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True)
        if len(held) >= HELD_LINKS:
            yield stars()
            held.clear()
    yield stars()


def connected_components(links: DataFrame, stored: bool = False) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v), root the least node reachable.

    A link to itself, u = v, makes no node. The driver sees a count and a checksum per
    round; a round halves the distances at least. What one task can hold needs no round.
    ``stored``: the links lie in reliable storage already and are not written once more.
    """
    edges = links.where("u <> v").select("u", "v")
    if not stored:
        edges = cut_lineage(edges)
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == (state["n"], state["s"]) or not state["n"]:
            break
        # As many tasks as the links need: most tables of links are small.
        tasks = max(1, -(-state["n"] // ROWS_PER_TASK))
        together = edges.coalesce(tasks).mapInArrow(_joined_in_task, "u long, v long")
        if tasks == 1:
            edges = cut_lineage(together)
            break
        before = (state["n"], state["s"])
        edges = cut_lineage(_small_star(_large_star(together)).coalesce(tasks))
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.union(roots).select(F.col("u").alias("node"), F.col("v").alias("root"))
