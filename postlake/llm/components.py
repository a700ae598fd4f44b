"""Connected components by contraction, for edges that need not fit one machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm import common

#: Vertices that a task thins the edges of at once.
VERTICES = 1_000_000


def thinned(edges: DataFrame) -> DataFrame:
    """Fewer edges (``a``, ``b``) that connect the same vertices: in each task stars around the one that comes first.

    That is the order in which ``components`` moves vertices, so a star is gone after one round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[tuple[int, int], tuple[int, int]] = {}

        def find(x: tuple[int, int]) -> tuple[int, int]:
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root[up]
            return x

        def stars() -> pa.RecordBatch:
            out = [(find(x)[1], x[1]) for x in list(root)]
            root.clear()
            out = [x for x in out if x[0] != x[1]]
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for a, b, first, second in zip(*[c.to_pylist() for c in batch.columns]):
                one, two = find((first, a)), find((second, b))
                root[max(one, two)] = min(one, two)
            if len(root) > VERTICES:
                yield stars()
        yield stars()

    return common.map_in_arrow(edges.select("a", "b", F.xxhash64("a"), F.xxhash64("b")), run, "a bigint, b bigint")


def components(edges: DataFrame, a: str = "a", b: str = "b", thin: bool = False) -> DataFrame:
    """``id`` and ``component`` (the smallest id that can be reached) of every end of ``edges``; both are 64-bit integers.

    Every vertex moves to the vertex of its neighbourhood that comes first in a shuffled order, and edges follow, until
    none is left; their number falls by a constant share each round. Each round is a written table, so lost executors
    cost no more than their own tasks, and joins read plain tables, of which Spark can split a hot vertex. Only row counts reach the driver. Edges with a null end count as none.
    ``thin``: tasks thin their edges before each round, which saves rounds where a task has much of a component.
    """
    less = thinned if thin else lambda x: x
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    places = common.written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().select("id", F.col("id").alias("at")), "vertices")
    left = common.written(less(pairs.filter("a <> b").distinct()), "edges")
    while not left.isEmpty():
        ends = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("v"))).alias("m"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("v"))
        moves = common.written(first.select(F.col("a").alias("from"), F.least("m", own)["v"].alias("to")), "moves")
        # Two moves in one: the place that the place moves to.
        moves = moves.join(moves.select(F.col("from").alias("to"), F.col("to").alias("last")), "to", "left").select("from", F.coalesce("last", "to").alias("to"))
        moves = common.written(moves, "moves")
        places = common.written(
            places.join(moves, places["at"] == moves["from"], "left").select("id", F.coalesce("to", "at").alias("at")), "places"
        )
        one = moves.select(F.col("from").alias("a"), F.col("to").alias("a2"))
        two = moves.select(F.col("from").alias("b"), F.col("to").alias("b2"))
        moved = left.join(one, "a").join(two, "b").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
        left = common.written(less(moved.filter("a <> b").distinct()), "edges")
    least = common.written(places.groupBy("at").agg(F.min("id").alias("component")), "least")
    return common.written(places.join(least, "at").select("id", "component"), "components")
