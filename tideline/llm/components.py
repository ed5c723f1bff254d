"""Connected components of an edge table: union-find in tasks, and alternating stars where the edges are many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm._shared import Scratch, map_batches

#: So many edges are finished by one task; more take rounds of stars over all tasks, which give the same rows.
ONE_TASK = 250_000


def _forest(whole: bool):
    """Union-find over edges, of a task's whole input or batch by batch: leaves each tree as a star around its smallest id."""

    def forest(batches):
        import pyarrow as pa

        parent: dict[int, int] = {}

        def find(x: int) -> int:
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        def stars():
            nodes = [x for x in parent if find(x) != x]
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], ["u", "v"])

        for batch in batches:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = find(u), find(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if not whole:
                yield stars()
                parent.clear()
        if whole:
            yield stars()

    return forest


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, root) for every id of the edges (u, v), two longs, but for the roots themselves: root is the smallest id that can be reached.

    First each task joins its own edges by union-find, which leaves at most an edge for each id it has seen. Up to
    ONE_TASK edges are then finished by one task. More take rounds: large stars link an id's larger neighbours to its
    smallest neighbour, small stars its smaller ones and itself, until nothing changes; the rounds grow with the
    logarithm of the longest path. Minima combine on the map side, and joins on a hot id read only written tables, so
    adaptive execution can split them. Only two numbers a round reach the driver.
    """
    edges = scratch.write(map_batches(edges.select(F.col("u").cast("long"), F.col("v").cast("long")), _forest(False), "u long, v long").distinct())
    before, now = None, (edges.count(),)
    if now[0] <= ONE_TASK:
        return scratch.write(map_batches(edges.repartition(1), _forest(True), "id long, root long"))
    while now != before:
        both = edges.union(edges.select("v", "u"))
        least = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = scratch.write(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        scratch.drop(edges, least)
        least = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = scratch.write(small.where("u <> v").distinct())
        scratch.drop(large, least)
        before, now = now, tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
