"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quadrat.session import Scratch


def components(edges: DataFrame, u: str = "u", v: str = "v") -> tuple[DataFrame, int]:
    """``(node, root)`` for every node of an edge, and the number of rounds it took.

    ``root`` is the smallest node of the component. A round hands each node's larger neighbours
    to its smallest one, then does the same with the smaller neighbours; each node is thus tied
    to ever smaller ones, and paths of any length shrink to stars in a number of rounds that
    grows with the logarithm of their length. No node's neighbours are listed. Repeated edges,
    loops and edges with a null end are allowed; a node known only from a loop is its own root.
    The result stands in a written table; the tables of earlier rounds are removed.
    """
    scratch = Scratch(edges.sparkSession)
    known = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u is not null and v is not null")
    nodes = scratch.cut(known.select(F.col("u").alias("node")).union(known.select("v")).distinct())
    now = scratch.cut(known.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen, rounds = None, 0
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        wide = scratch.cut(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = wide.groupBy("u").agg(F.min("v").alias("m"))
        tied = wide.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = scratch.cut(tied.union(low.select("u", "m")).distinct())
        scratch.drop(keep=(nodes, after))
        now, seen, rounds = after, mark, rounds + 1
    found = scratch.cut(nodes.join(now.withColumnsRenamed({"u": "node", "v": "root"}), "node", "left").select("node", F.coalesce("root", "node").alias("root")))
    scratch.drop(keep=(found,))
    return found, rounds
