"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.session import join_statistics, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node of its component.

    Alternates two steps until only stars are left: each node links its larger
    neighbours, and then its smaller ones, to its smallest neighbour. Chains get
    shorter by a constant factor per round and the number of links never grows.
    A round deals the links out three times: for the neighbours of each node, which
    also tell whether all are stars, for the smaller ones of each, and to leave out
    repeated links. Each is written to the shared folder, so a lost executor costs
    one step's tasks only. Links with a NULL end, and links of a node to itself, are
    left out.
    """
    pairs = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    pairs = materialize(pairs.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")), "links")
    while True:
        nodes = materialize(_neighbours(pairs), "nodes")
        # In a star, a node with a smaller neighbour has no other one.
        if not nodes.filter("least < node AND least < most").limit(1).count():
            return nodes.select("node", F.least("node", "least").alias("root"))
        pairs = materialize(_small_star(materialize(_large_star(pairs, nodes), "links")), "links")


def _neighbours(pairs: DataFrame) -> DataFrame:
    """The least and the greatest neighbour of each node, and the number of its links to larger ones."""
    ends = F.array(
        F.struct(F.col("high").alias("node"), F.col("low").alias("other"), F.lit(0).alias("larger")),
        F.struct(F.col("low").alias("node"), F.col("high").alias("other"), F.lit(1).alias("larger")),
    )
    both = pairs.select(F.explode(ends).alias("end")).select("end.*")
    return both.groupBy("node").agg(F.min("other").alias("least"), F.max("other").alias("most"), F.sum("larger").alias("larger"))


def _large_star(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of it and its neighbours."""
    centres = nodes.filter("larger > 0").select(F.col("node").alias("low"), F.least("node", "least").alias("least"), "larger")
    return join_statistics(pairs, centres, "low", "larger").select("high", F.col("least").alias("low"))


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    least = materialize(pairs.groupBy("high").agg(F.min("low").alias("least"), F.max("low").alias("most"), F.count("*").alias("links")), "least")
    several = least.filter("least < most").select("high", "least", "links")
    moved = join_statistics(pairs, several, "high", "links").filter("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.unionByName(least.select("high", F.col("least").alias("low"))).distinct()
