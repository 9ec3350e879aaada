"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quadrat.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of the links; ``root`` is the smallest node it can reach.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the smallest
    node around it, and writes the links that remain, until all are stars. A node
    with very many links is a key of partial aggregations and of a join that adaptive
    execution splits, never one task's list. Null ends and self links are ignored.
    """
    current = cut_lineage(links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                          .filter("hi <> lo and hi is not null and lo is not null").distinct())
    while True:
        for larger in (True, False):
            ends = F.array(F.struct(F.col("hi").alias("n"), F.col("lo").alias("m")), F.struct(F.col("lo").alias("n"), F.col("hi").alias("m")))
            around = current.select(F.inline(ends)) if larger else current.select(F.col("hi").alias("n"), F.col("lo").alias("m"))
            smallest = around.groupBy("n").agg(F.min("m").alias("s")).select("n", F.least("n", "s").alias("s"))
            hung = around.join(smallest, "n")
            hung = hung.filter("m > n") if larger else hung
            kept = hung.select(F.col("m").alias("hi"), F.col("s").alias("lo"))
            if not larger:
                kept = kept.union(smallest.select(F.col("n").alias("hi"), F.col("s").alias("lo")))
            current = cut_lineage(kept.filter("hi <> lo").distinct())
        ends = current.select(F.col("hi").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(current.select("lo", F.lit(0), F.lit(1)))
        unfinished = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up = 1 and down = 1)")
        if unfinished.isEmpty():  # every node hangs on one root, and no root hangs on another node
            break
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(current.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
