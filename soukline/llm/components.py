"""Connected components of a distributed edge list by alternating star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soukline.llm.common import drop_stored, stored


EDGES_A_FILE = 20_000


def _large_star(edges: DataFrame, files: int | None) -> DataFrame:
    """Connect every larger neighbour of a vertex to the vertex's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # stored: a vertex with very many neighbours can then be split in the join
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")), "components-least", files)
    return (both.filter("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a vertex and its smaller neighbours to the smallest of them (v < u here)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v != m").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _print(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """``vertex, component``: the smallest vertex reachable, for every vertex of an edge.

    ``edges`` has the columns ``u, v`` (of one ordered type, not null). Each round is two aggregations
    and joins over the edges, so a vertex with many edges is never gathered; the edges
    become stars after a number of rounds logarithmic in the component size, however long
    its paths. Only an edge count and a checksum reach the driver. ``files``: the most that a
    round's table is written in (see ``file_count``).
    """
    now = stored(edges.filter("u != v").select(F.greatest("u", "v").alias("u"),
                                               F.least("u", "v").alias("v")).distinct(),
                 "components", files)
    before = None
    while (mark := _print(now)) != before and mark[0]:
        before = mark
        # a round makes no edges: its tables need no more files than those it reads
        files = min(files or mark[0], -(-mark[0] // EDGES_A_FILE))
        new = stored(_small_star(_large_star(now, files)), "components", files)
        drop_stored(now)
        now = new
    stars = now.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("vertex"),
                                        F.col("v").alias("component")).distinct())
