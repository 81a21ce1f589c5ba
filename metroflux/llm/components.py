"""Connected components of an edge table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import discard, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); a component is
    named by its smallest node.  Alternating large-star and small-star steps.
    A step takes one pre-aggregated minimum a node and joins it to the edges.
    The minimum is a stored table, so both sides of the join come through a
    shuffle and adaptive execution splits a node of very many edges.  The
    links are a star to the smallest node when nothing changes any more; a
    round's tables go when the next round's are written."""
    e = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = materialise(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        lower = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        small = materialise(large.join(lower, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        settled = small.join(e, ["u", "v"], "left_anti").isEmpty() and e.join(small, ["u", "v"], "left_anti").isEmpty()
        discard(e, least, large, lower)
        if settled:
            return small.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        e = small
