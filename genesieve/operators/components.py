"""Clusters of loci that share a tag: connected components by alternating stars.

Loci are nodes, numbered in the order of their names; each tag links the loci that hold it to the
least of them (a star, never all pairs). Alternating large and small star steps run until nothing changes,
each written to the shared folder so that lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from genesieve.schema import LOCUS, TAG
from genesieve.sources.scratch import compact, materialise

UNKNOWN = "cluster_unknown"


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v), u > v. Large: join larger neighbours to the least one known; small: the others."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    side = F.col("v") > F.col("u") if large else F.lit(True)
    rewired = both.where(side).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        rewired = rewired.unionByName(least.select("u", F.col("m").alias("v")))
    return rewired.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def linked_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of a link (u, v) between two nodes; the component is its least node.

    Each step rewires every node to the least node it knows, so the number of steps grows
    with the logarithm of the node count. A node with very many neighbours is only ever aggregated
    (partially, where its rows lie) and joined (where Spark may split it).
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, before = compact(materialise(edges, "graph")), None
    while True:
        edges = compact(materialise(_star(_star(edges, True), False), "graph"))
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if before == now:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of edges (u, v); the component is its least node. Self-links make a node known."""
    edges = materialise(edges, "graph-edges")
    nodes = edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    found = linked_components(edges)
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def locus_name() -> Column:
    return F.concat_ws(":", *LOCUS)


def numbered_loci(loci: DataFrame) -> DataFrame:
    """Every locus once, with its name and a 64-bit number; numbers have the order of names. Written, since the numbers are given as rows lie."""
    named = loci.select(*LOCUS).distinct().withColumn("name", locus_name()).orderBy("name")
    return materialise(named.withColumn("id", F.monotonically_increasing_id()), "loci")


def cluster_loci(loci: DataFrame, tags: DataFrame) -> DataFrame:
    """Every locus with its cluster: the least locus name of its component, or ``cluster_unknown`` if it has no tag.

    The graph is one of numbers; names come back at the end. As numbers have the names' order, the least of both is the same locus.
    """
    names = numbered_loci(loci)
    held = tags.join(names, [*LOCUS]).select(*TAG, "id")
    # a tag links its loci to the least of them
    least = F.min("id").over(Window.partitionBy(*TAG))
    links = materialise(held.select(F.col("id").alias("u"), least.alias("v")).distinct(), "graph-edges")
    found = linked_components(links)
    tagged = links.select("u").distinct().join(found, F.col("u") == F.col("node"), "left").select(F.col("u").alias("id"), F.coalesce("component", "u").alias("least"))
    label = names.select(F.col("id").alias("least"), F.col("name").alias("cluster_label"))
    return names.join(tagged, "id", "left").join(label, "least", "left").select(*LOCUS, F.coalesce("cluster_label", F.lit(UNKNOWN)).alias("cluster_label"))
