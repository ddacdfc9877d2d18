"""Connected components of a link table by alternating star contraction.

Large-star connects a node's larger neighbours to its smallest neighbour,
small-star its smaller ones; the two alternate until every edge points at the
root of its component.  Each step is a minimum per node (map-side combined) and
an equi-join, so no neighbour list is ever collected; the edges of each round
are written to the shared folder, in no more files than the edges of the round
before call for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .store import few_files, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: (u, v) with u > v.  Returns new edges of the same form, some
    of them more than once."""
    u, v = F.col("u"), F.col("v")
    if large:
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.filter(v > u).join(least, "u").select(v.alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = (edges.join(least, "u").select(v.alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.filter(F.col("u") != F.col("v"))


def _written(edges: DataFrame, rows: int | None = None) -> tuple[DataFrame, tuple]:
    """The distinct edges, stored, with their count and checksum, which are
    taken while they are written; at most ``rows`` of them, if that is known."""
    seen = Observation()
    edges = edges.distinct().observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
    edges = stored(edges if rows is None else few_files(edges, rows), "edges")
    return edges, (seen.get["n"], seen.get["sum"])


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: long, any order).

    ``component`` is the smallest node reachable.  Nodes without a link are not
    listed; repeated links and loops have no effect.  ``rows``: at most so many
    links, if that is known.
    """
    edges, mark = _written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v"), rows)
    before = None
    while mark != before and mark[0]:
        before = mark
        # a star step leaves no more edges than it finds
        edges, mark = _written(_star(_star(edges, True), False), mark[0])
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
