"""Connected components of a table of links, by alternating large and small stars.

Every round is two aggregations and two joins over the links; a round's table is
written to the shared folder, so that neither lineage nor the driver grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _star(links: DataFrame, large: bool) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    to = both.where("b > a") if large else both
    out = to.join(least, "a").selectExpr("b AS a", "m AS b")
    if not large:
        out = out.unionByName(least.selectExpr("a", "m AS b"))
    return out.where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_000_007), F.lit(0))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links (a, b): component is the smallest node that can be reached."""
    links = common.kept(links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    state = _state(links)
    while state[0]:
        links = common.kept(_star(_star(links, True), False), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    nodes = links.selectExpr("a AS node", "b AS component")
    return nodes.unionByName(links.selectExpr("b AS node", "b AS component").distinct())
