"""Connected components of an edge table by contraction, wholly in DataFrames.

Each round hooks every node to its least neighbour (if that is smaller), jumps
pointers twice, and maps the edges onto the new representatives; edges inside a
component vanish.  Rounds go on until no edge is left (they shrink
geometrically), every round is written to the shared folder, and the rounds'
maps are composed backwards.  Joins are by node id, so a large component is a
skewed join side with a unique other side, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspark.llm.common import stage


def _jump(parents: DataFrame) -> DataFrame:
    up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
    joined = parents.join(up, "parent", "left")
    return joined.select("node", F.coalesce("above", "parent").alias("parent"))


def _moved(edges: DataFrame, parents: DataFrame, col: str) -> DataFrame:
    up = parents.select(F.col("node").alias(col), "parent")
    rest = "b" if col == "a" else "a"
    return edges.join(up, col).select(F.col("parent").alias(col), rest)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a bigint, b bigint); root is the same within a component.

    Loops and repeated edges do no harm; rows with a null end are ignored; an empty table gives no rows.
    """
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    edges = stage(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(*pair).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        parents = least.select(F.col("a").alias("node"), F.least("a", "m").alias("parent"))
        parents = stage(_jump(_jump(parents)), "parents")
        rounds.append(parents)
        moved = _moved(_moved(edges, parents, "a"), parents, "b")
        edges = stage(moved.where("a <> b").select(*pair).distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds.pop().withColumnRenamed("parent", "root")
    while rounds:
        above = roots.select(F.col("node").alias("parent"), "root")
        below = rounds.pop().join(above, "parent", "left")
        roots = below.select("node", F.coalesce("root", "parent").alias("root"))
    return roots
