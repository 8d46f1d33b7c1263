"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.scratch import materialize, release


def _stars(links: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); root is the smallest node it is joined to.

    Large and small stars in turn (Kiveris et al., 2014): each node links its larger neighbours, then its
    smaller ones, to the smallest neighbour it knows. The steps are joins and partial minima, so a node with
    very many links is no single task's work; the rounds grow with the logarithm of the longest chain. Each
    round is written to the shared folder. Nothing comes to the driver but whether all links are
    from a node to a root.
    """
    now = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        before, now = now, materialize(small, "stars")
        release(before)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
