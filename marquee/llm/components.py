"""Connected components of an edge table by alternating star contraction.

Each round first hangs every node's larger neighbours on its smallest neighbour, then every node and
its smaller neighbours on the smallest of them; the edges end up as one star per component. A round
is a grouping with partial minima, saved, and a join with it, written to the shared folder; the number of rounds
grows with the logarithm of the longest chain. Neither nodes nor edges pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import materialise
from marquee.session import stages


def _directed(pairs: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller end, without loops."""
    return pairs.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
    # Saved, so that the join meets no grouping on its way: Spark can then split a node with very many edges.
    smallest = materialise(smallest, "smallest")
    # Only the larger neighbours move: those are the edges that come in.
    return edges.join(smallest, F.col("v") == F.col("at")).select("u", F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "smallest")
    moved = edges.join(smallest.withColumnRenamed("u", "at"), F.col("u") == F.col("at"))
    moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for nodes that are not roots.

    ``pairs`` has two columns of one ordered type, ``u`` and ``v``; order, repeats and loops do not matter. A
    null end makes a pair no edge. Nodes without an edge to another do not appear. The result is saved; the
    stages of the rounds are deleted.
    """
    with stages(pairs.sparkSession) as run:
        edges = materialise(_directed(pairs).distinct(), "edges")
        before, now = None, _mark(edges)
        while now != before:
            large = materialise(_directed(_large_star(edges)), "large")
            run.release(edges)
            # Repeats do not change a minimum, so they are dropped once a round only.
            edges = materialise(_directed(_small_star(large)).distinct(), "edges")
            run.release(large)
            before, now = now, _mark(edges)
        return run.keep(edges.select(F.col("u").alias("node"), F.col("v").alias("root")), "components")
