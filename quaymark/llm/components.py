"""Connected components of a table of edges by alternating large and small stars.

Each half-round is one exchange: edges are dealt out by node and streamed in order, so a node's least
neighbour is the first one seen and its other edges are turned towards it, however many there are.
Nodes with more than a four-thousandth of all edges are found in a sample; their least neighbours are
broadcast (at most some thousand rows) and their edges are turned where they lie, without an exchange.

Defined cases: loops and repeated edges change nothing; nodes without an edge to another are not
returned; ids may be negative; an empty table gives no rows; edges with a null end are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import arrow_rows, batches, map_arrow, release, stage

#: Edges that a task unites in memory at a time.
UNITED = 200_000
#: Edges of a partition.
EDGES = 100_000
#: Nodes are heavy from this share of all edges on, found in one of SAMPLE edges, or from LEAST sampled edges on.
HEAVY, SAMPLE, LEAST = 4096, 64, 256


def spanning(left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """(node, least node of its tree) of the components of a list of edges."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in zip(left, right, strict=True):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, find(x)) for x in parent if find(x) != x]


def contract(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: each task keeps a star for each of its components."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[int] = []
        right: list[int] = []

        def out() -> pa.RecordBatch:
            stars = np.array(spanning(left, right), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(stars[:, 0]), pa.array(stars[:, 1])], names=["u", "v"])

        for b in batches(parts):
            left += b.column("u").to_pylist()
            right += b.column("v").to_pylist()
            if len(left) >= UNITED:
                yield out()
                left, right = [], []
        if left:
            yield out()

    return map_arrow(edges, run, "u long, v long")


def heavy_nodes(edges: DataFrame, total: int) -> DataFrame | None:
    """u and m (the least of its neighbours and itself) of the nodes with very many edges, if there are any."""
    some = edges.where(F.pmod(F.xxhash64("u", "v"), F.lit(SAMPLE)) == 0).groupBy("u").agg(F.count("*").alias("n"))
    found = [r["u"] for r in some.where(F.col("n") >= max(LEAST, total // SAMPLE // HEAVY)).select("u").collect()]
    if not found:
        return None
    nodes = edges.sparkSession.createDataFrame([(x,) for x in found], "u long")
    least = edges.join(F.broadcast(nodes), "u").groupBy("u").agg(F.min("v").alias("m"))
    return least.select("u", F.least("u", "m").alias("m"))


def turned(edges: DataFrame, partitions: int, small: bool, total: int) -> DataFrame:
    """A half-round in which heavy nodes' edges stay where they are."""
    heavy = heavy_nodes(edges, total)
    if heavy is None:
        return _turned(edges, partitions, small)
    # At most as many rows as heavy nodes can be.
    mine = edges.join(F.broadcast(heavy), "u").where("true" if small else "v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    both = _turned(edges.join(F.broadcast(heavy), "u", "left_anti"), partitions, small).union(mine)
    return (both.union(heavy.select("u", F.col("m").alias("v"))) if small else both).where("u <> v")


def _turned(edges: DataFrame, partitions: int, small: bool) -> DataFrame:
    """One half-round over (u, v) with u > v: edges of a node go to the least of its neighbours and itself."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, least = None, 0  # the node whose edges are being read, and its target
        for b in batches(parts):
            u, v = b.column("u").to_numpy(), b.column("v").to_numpy()
            new = np.r_[node is None or u[0] != node, u[1:] != u[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(u)), -1))
            m = np.where(first >= 0, np.minimum(u, v[np.maximum(first, 0)]), least)
            node, least = u[-1], m[-1]
            if small:
                pairs = np.concatenate([np.stack([v, m], 1), np.stack([u[new], m[new]], 1)])
            else:
                pairs = np.stack([v, m], 1)[v > u]
            pairs = pairs[pairs[:, 0] != pairs[:, 1]]
            if len(pairs):
                pairs = np.unique(pairs, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], names=["u", "v"])

    return map_arrow(edges.repartition(partitions, "u").sortWithinPartitions("u", "v"), run, "u long, v long")


def components(spark: SparkSession, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the least node of its component), for every node that has an edge to another.

    Each round keeps the components and shrinks the paths; it ends when nothing changes, and raises
    if that does not happen within ``rounds``.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum("u"), F.sum("v")).first())

    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with arrow_rows(spark, 50_000):
        now = stage(spark, contract(edges.where("u <> v")), "edges")
        if (left := now.count()) <= UNITED:  # few enough for one task; more are turned round by round
            return stage(spark, contract(now.coalesce(1)), "stars").toDF("node", "root")
        before = (-1, None, None)
        for _ in range(rounds):
            partitions = max(1, min(most, 1 + left // EDGES))
            both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            large = stage(spark, turned(both, partitions, False, 2 * left), "edges")
            new = stage(spark, turned(large, partitions, True, 2 * left).repartition(partitions, "u").dropDuplicates(["u", "v"]), "edges")
            release(spark, now)
            release(spark, large)
            now, old = new, before
            before = state(now.select(F.col("u").cast("decimal(38,0)"), F.col("v").cast("decimal(38,0)")))
            left = before[0]
            if before == old:
                return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    raise RuntimeError("the components did not settle")
