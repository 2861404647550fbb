"""Connected components of a graph of longs, by alternating large-star and small-star steps.

No task holds a whole component: a step is a grouped minimum, combined before
the shuffle, and an equi-join, in which the centres of large stars are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleethealth.llm.common import delete_work, join_sized, written


class Forest:
    """Union-find over any hashable nodes; the root of a tree is its least node."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, x):
        up = self.up
        r = x
        while (y := up.get(r, r)) != r:
            r = y
        while x != r:
            up[x], x = r, up.get(x, x)
        return r

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if a > b:
            a, b = b, a
        self.up[b] = a
        self.up.setdefault(a, a)
        return True


#: Nodes that a task's forest holds before it passes its stars on.
HELD = 500_000


def _within_partitions(edges: DataFrame) -> DataFrame:
    """A star for each component of a partition's edges: fewer edges, the same components."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()

        def stars() -> Iterator[pa.RecordBatch]:
            nodes = [x for x in forest.up if forest.root(x) != x]
            for at in range(0, len(nodes), 50_000):
                part = nodes[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([forest.root(x) for x in part], pa.int64())], names=["u", "v"])

        for batch in batches:
            for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                forest.join(a, b)
            if len(forest.up) > HELD:
                yield from stars()
                forest.up.clear()
        yield from stars()

    return edges.select("u", "v").mapInArrow(of, "u long, v long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): each node that an edge (u, v) touches, with the least node that it reaches; roots are not listed.

    Loops and repeated edges are allowed; edges with a null end are ignored.
    """
    now = written(_within_partitions(edges.where("u is not null and v is not null and u <> v")), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or state.n == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        # v <= u holds for each edge from here on
        both = now.union(now.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = join_sized(both, least, ["u"], "n", 2 * state.n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "stars")
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = join_sized(large, low, ["u"], "n", large.count()).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        after = written(small, "edges")
        delete_work(now.sparkSession, now)
        delete_work(now.sparkSession, large)
        now = after
