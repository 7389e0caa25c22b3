"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014).

Each step replaces edges by edges to smaller neighbours; the rounds grow with the
logarithm of the longest path. Edges stay a written table in the shared checkpoint
folder; nothing is gathered on the driver. The minimum of a node's neighbours is
written before it is joined back, so both sides of that join are plain scans and
adaptive execution can split the partition of a node with very many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salaria.llm.rows import passing_tables, table


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b of one orderable type, in any order).

    ``component`` is the smallest node reachable. Loops, repeated edges and rows with
    a null end add nothing; without edges the result is empty.
    """
    with passing_tables(edges.sparkSession, "components") as passing:
        def least_neighbour(pairs: DataFrame) -> DataFrame:
            return passing(pairs.groupBy("a").agg(F.min("b").alias("least")), "least")

        def state(e: DataFrame):
            return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

        e = passing(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        seen = state(e)
        while seen[0]:
            both = e.union(e.select("b", "a"))
            large = both.join(least_neighbour(both), "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
            large = passing(large.distinct(), "large")
            m = least_neighbour(large)
            small = large.join(m, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            e = passing(small.union(m.select("a", F.col("least").alias("b"))).distinct(), "edges")
            before, seen = seen, state(e)
            if before == seen:
                break
        return table(e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
            e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), "components")
