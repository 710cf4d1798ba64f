"""Connected components of an edge list, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node of the component.

    In a large star step every node hands its larger neighbours to its least
    neighbour, in a small star step its smaller ones; both keep components as
    they are, and the edges end as stars around the least nodes after a
    logarithmic number of rounds.  A step needs each node's minimum and a join,
    never a node's neighbours in one place.  Minimums are stored before they are
    joined: both sides are then plain exchanges, so a node with very many
    neighbours is split.  Every step starts from written files.
    """
    def stored(e: DataFrame) -> DataFrame:
        return written(e.filter("u > v").distinct(), "edges")

    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while True:
        least = e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        if least.filter("n > 1").isEmpty() and e.select("v").join(e.select(F.col("u").alias("w")), F.col("v") == F.col("w")).isEmpty():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mins = written(both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m")), "edge-minimums")
        large = stored(both.filter("v > u").join(mins, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")))
        mins = written(large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "edge-minimums")
        e = stored(large.join(mins, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(mins.select(F.col("w").alias("u"), F.col("m").alias("v"))))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
