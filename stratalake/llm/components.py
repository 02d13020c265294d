"""Connected components of links, by alternating large and small stars.

Each round hangs the neighbours of a node below the smallest node that it knows of: first the
larger neighbours, then the smaller ones. The number of links never grows, and a hub is only
met by aggregates that combine before the shuffle and by joins that can be split. Every round
is written to the shared folder, so a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import pin, unpin


def _both_ways(links: DataFrame) -> DataFrame:
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select("a", "b").unionByName(back)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes below the smallest of the node and its neighbours."""
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.min("b").alias("_least"))
    low = F.least("a", "_least")
    return near.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), low.alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, go below the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_least"))
    others = down.join(least, "a").where(F.col("b") != F.col("_least")).select(F.col("b").alias("a"), "_least")
    return others.unionByName(least).select("a", F.col("_least").alias("b"))


def _flat(links: DataFrame) -> bool:
    """Whether links from larger to smaller nodes are stars: one link per node, and none from a centre."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("_low"), F.lit(0).alias("_high"))
    ends = ends.unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("_low"), F.lit(1).alias("_high")))
    per = ends.groupBy("node").agg(F.sum("_low").alias("_low"), F.max("_high").alias("_high"))
    return per.where("_low > 1 OR (_low > 0 AND _high > 0)").isEmpty()


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b`` of long ids).

    ``component`` is the smallest node reachable. Nodes that link with nothing are not listed;
    links of a node with itself and NULL ends are ignored. ``known``, an earlier result, is
    extended by ``links``.
    """
    if known is not None:
        if links.isEmpty():
            return known
        earlier = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
        links = links.select("a", "b").unionByName(earlier)
    stars = pin(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    done = stars.isEmpty()
    while not done:
        earlier, stars = stars, pin(_small_star(_large_star(stars)).distinct(), "stars")
        unpin(earlier)
        done = _flat(stars)
    members = stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(heads)


def joined_by_id(of: DataFrame, found: DataFrame) -> DataFrame:
    """Components ``found`` of nodes, extended by links between the nodes of one id (``id, node``)."""
    of = pin(of.select("id", "node").distinct(), "nodes")
    first = of.groupBy("id").agg(F.min("node").alias("a"))
    return components(pin(of.join(first, "id").where("node > a").select("a", F.col("node").alias("b")), "same"), found)


def named_by_id(classes: DataFrame, *keys: str) -> DataFrame:
    """``*keys, component`` of classes, the component renamed to the smallest ``head`` in it."""
    least = classes.groupBy("component").agg(F.min("head").alias("_least"))
    return classes.join(least, "component").select(*keys, F.col("_least").alias("component"))


def same_by_id(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows with ``id, component``; those of a repeated id all get the component that one of them has."""
    per = rows.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("component").alias("_of_id"))
    return rows.join(per, "id", "left").withColumn("component", F.coalesce("_of_id", "component")).drop("_of_id")
