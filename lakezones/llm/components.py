"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_tables, stored

MAX_ROUNDS = 200


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns a, b); nodes of one component have one root.

    Contraction: each round every node joins its neighbour (or itself) of least random rank and the
    graph of the joined nodes goes on, until no edge is left.  Ranks change every round, so paths shrink by
    a constant factor.  Minima are combined before they are shuffled and every table is written once;
    a hub's edges are split by the join.
    """
    with scratch_tables(edges.sparkSession):
        return _contracted(edges, label)


def _contracted(edges: DataFrame, label: str) -> DataFrame:
    left = stored(edges.select("a", "b").where("a <> b").distinct(), f"{label}-edges")
    roots = None
    for number in range(MAX_ROUNDS):
        if left.isEmpty():
            break
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(number)).alias("r"), F.col(c).alias("id"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        moved = stored(best.select(F.col("a").alias("node"), F.least(rank("a"), F.col("m"))["id"].alias("to")), f"{label}-moved")
        if roots is None:
            roots = moved.select("node", F.col("to").alias("root"))
        else:
            roots = stored(roots.join(moved.withColumnRenamed("node", "root"), "root", "left")
                           .select("node", F.coalesce("to", "root").alias("root")), f"{label}-roots")
        ends = (left.join(moved.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
                .join(moved.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b"))
        left = stored(ends.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
                      .where("a <> b").distinct(), f"{label}-edges")
    else:
        raise RuntimeError("components did not converge")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root")).where("false")
    return stored(roots, f"{label}-roots", keep=True)
