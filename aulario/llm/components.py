"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aulario.llm.common import batch, small_batches, staged

_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _within_tasks(edges: DataFrame) -> DataFrame:
    """Replace the links that a task holds by stars around their smallest nodes.

    At most as many links as before come out, and chains among them are gone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = parent[up]
                x = up
            return x

        for incoming in batches:
            for u, v in zip(incoming.column(0).to_pylist(), incoming.column(1).to_pylist()):
                a, b = root(u), root(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        nodes = [x for x in parent if root(x) != x]
        for i in range(0, len(nodes), 50_000):
            some = nodes[i : i + 50_000]
            yield batch(_EDGES, [some, [root(x) for x in some]])

    return edges.mapInArrow(run, "u long, v long")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one node that hangs on none."""
    ends = edges.select(F.explode(F.array(*[F.struct(F.col(c).alias("x"), F.lit(b).alias("below")) for c, b in (("u", 1), ("v", 0))])).alias("e"))
    found = ends.groupBy("e.x").agg(F.sum("e.below").alias("below"), F.min("e.below").alias("least"))
    return found.filter("below > 1 or (below = 1 and least = 0)").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (``a``, ``b``); a component is its smallest node.

    Links are first merged within tasks. Each step then shrinks the table or leaves it, is written
    to the shared folder, and gathers per node only a minimum: a node with very many links
    costs partial minima, not a list.
    """
    small_batches(links.sparkSession)
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
    edges = staged(_within_tasks(pairs), "links")
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = moved.unionByName(least.select("u", F.col("m").alias("v"))).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        )
        edges = staged(_within_tasks(stars.filter("u <> v").distinct()), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
