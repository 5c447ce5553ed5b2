"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import dealt, forget, stash


#: Labels of up to so many links (a few MB) are broadcast; more are joined by shuffles.
FEW = 50_000


def connected(links: DataFrame, root: str, name: str) -> DataFrame:
    """links: (a, b). (node, comp) for every node of a link; comp is the smallest node it reaches.

    Each round, every node takes its smallest neighbour, then that one's own, as its parent,
    and links are rewritten between parents; what has become one node is gone. So links are
    read twice in the first round and few are left after it, and the rounds grow with the
    logarithm of a path. Hot nodes are safe: neighbours are only minimised over, with partial
    aggregation, and never gathered; labels of more than FEW links are joined by shuffles, not by way of the driver. Each round's tables are in the shared folder; links that
    are null on either side are left out.
    """
    spark = links.sparkSession
    lower, upper = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges = stash(links.where("a is not null and b is not null").select(lower, upper).distinct(), root, f"{name}-edges-0")
    labels, k = None, 0
    while (left := edges.limit(FEW + 1).count()) or labels is None:
        side = F.broadcast if 0 < left <= FEW else dealt
        both = edges.select(F.col("a").alias("node"), F.col("a").alias("low")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("low")))
        parent = both.groupBy("node").agg(F.min("low").alias("low"))
        up = parent.select(F.col("node").alias("low"), F.col("low").alias("comp"))
        parent = stash(parent.join(side(up), "low").select("node", "comp"), root, f"{name}-parents-{k}")
        of = lambda c, side=side: side(parent.select(F.col("node").alias(c), F.col("comp").alias(f"p{c}")))
        shorter = edges.join(of("a"), "a").join(of("b"), "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
        new_edges = stash(shorter.distinct(), root, f"{name}-edges-{k + 1}")
        moved = parent if labels is None else labels.join(of("comp"), "comp", "left").select("node", F.coalesce("pcomp", "comp").alias("comp"))
        new_labels = stash(moved, root, f"{name}-labels-{k}")
        for old in (f"{name}-edges-{k}", f"{name}-parents-{k}", f"{name}-labels-{k - 1}"):
            forget(spark, f"{root}/{old}")
        edges, labels, k = new_edges, new_labels, k + 1
    return labels
