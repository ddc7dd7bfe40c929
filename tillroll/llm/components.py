"""Connected components of a link table, all on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Links each neighbour on one side of a node to the least of its neighbourhood.

    The least neighbour of a node comes from a partial aggregate, and the join back is a
    plain equi-join of two written or shuffled sides, which adaptive execution can split
    at a hub.
    """
    directed = _both_ways(edges)
    least = directed.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    least = least.select(F.col("a").alias("node"), "m")
    if large:
        linked = directed.filter("b > a").join(least, F.col("a") == F.col("node"))
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        smaller = directed.filter("b < a")
        linked = smaller.join(least, F.col("a") == F.col("node"))
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            linked.select("a", F.col("m").alias("b"))
        )
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its least node.

    Alternates large-star and small-star steps until nothing changes; each round is
    written to the shared folder, which cuts lineage. Links to itself or NULL are ignored.
    """
    edges = written(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = None
    while True:
        edges = written(_stars(_stars(edges, large=True), large=False), "links")
        mark = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == state:
            break
        state = mark
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
