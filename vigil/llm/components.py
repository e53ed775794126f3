"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import written_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v")
    return moved.union(least.selectExpr("u", "m AS v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, label) for every node of ``links`` (columns u, v of type long): the smallest node reachable.

    Each pass replaces the links by links to smaller nodes of the same component
    until every node points at its component's smallest; a hub's links are never
    gathered, only their minimum is. Self links, repeated links, links in either
    direction and links with a null end (ignored) are fine; no links give no rows.
    """
    spark = links.sparkSession
    ends = links.where("u IS NOT NULL AND v IS NOT NULL").selectExpr("greatest(u, v) AS u", "least(u, v) AS v")
    alone = ends.where("u = v").selectExpr("u AS node", "u AS label")
    edges, before = written_table(spark, ends.where("u <> v").distinct(), "edges"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.expr("xxhash64(u, v) % 1000000007"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        edges = written_table(spark, _small_star(_large_star(edges)), "edges")
    pointed = edges.selectExpr("u AS node", "v AS label")
    return pointed.union(edges.selectExpr("v AS node", "v AS label")).union(alone).groupBy("node").agg(
        F.min("label").alias("label"))
