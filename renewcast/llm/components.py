"""Connected components of an undirected graph by alternating large-star and small-star joins.

A node with very many neighbours would bring all of them to one task of a join; neighbours are therefore dealt
over ``SALT`` parts, and the least neighbour of a node (one row, from a pre-aggregated grouping) goes to each."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewcast.llm.shared import materialise

SALT = 16


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges(a, b) joined with least(a, m)."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALT)))
    each = least.select("a", "m", F.explode(F.expr(f"sequence(0L, {SALT - 1}L)")).alias("salt"))
    return salted.join(each, ["a", "salt"])


def _stars(edges: DataFrame) -> bool:
    """Whether each a has one b and no b is an a as well: then b is the least of all that a reaches."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("from")), F.struct(F.col("b").alias("node"), F.lit(0).alias("from")))).alias("e"))
    each = ends.groupBy("e.node").agg(F.sum("e.from").alias("n"), F.min("e.from").alias("least"))
    return not each.where("n > 1 OR n = 1 AND least = 0").agg(F.count(F.lit(1))).first()[0]


def components(links: DataFrame) -> DataFrame:
    """links(a, b) of comparable ids -> (node, component): the smallest node that can be reached.  Nodes
    without links don't appear.  Links of a node to itself and repeated links do no harm; nulls are left out."""
    edges = links.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = materialise(edges, "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Greater neighbours link to the least neighbour.
        star = _with_least(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Smaller neighbours and the node itself link to the least.
        least = star.groupBy("a").agg(F.min("b").alias("m"))
        star = _with_least(star, least).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        edges = materialise(star, "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
