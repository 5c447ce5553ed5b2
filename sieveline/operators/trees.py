"""Trees by parent keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.groups import checkpoints


def rooted(rows: DataFrame, key: str, parent: str) -> DataFrame:
    """(key, root, depth, kind) of each row of a table with unique keys: the topmost ancestor and how far above it is. kind is root (no
    parent), orphan (its parent isn't there; it is its own root), child, or cycle: a row whose ancestors never end, with neither root nor depth. Rows without a key are left out.

    Each round doubles the distance that a row looks up, so a tree of depth d takes log2(d) rounds; rows that have found their root
    leave, and when a round finds no more, those left are below a cycle.
    """
    checkpoints(rows.sparkSession)
    own = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(parent).alias("p"))
    there = own.select(F.col("k").alias("p"), F.lit(True).alias("known"))
    own = own.join(there, "p", "left").select("k", "p", "known").checkpoint()
    kind = F.when(F.col("p").isNull(), "root").when(F.col("known").isNull(), "orphan")
    done = own.where(kind.isNotNull()).select("k", F.col("k").alias("root"), F.lit(0).cast("long").alias("depth"), kind.alias("kind"))
    left = own.where(kind.isNull()).select("k", F.col("p").alias("up"), F.lit(1).cast("long").alias("d"))
    waiting = left.count()
    while waiting:
        tops = done.select(F.col("k").alias("up"), "root", "depth")
        found = left.join(tops, "up", "left").select("k", "up", "d", "root", "depth").checkpoint()
        done = done.unionByName(found.where("root is not null").select("k", "root", (F.col("d") + F.col("depth")).alias("depth"), F.lit("child").alias("kind")))
        rest = found.where("root is null").select("k", "up", "d")
        further = rest.select(F.col("k").alias("up"), F.col("up").alias("next"), F.col("d").alias("more"))
        left = rest.join(further, "up", "left").select("k", F.coalesce("next", "up").alias("up"), (F.col("d") + F.coalesce("more", F.lit(0))).alias("d")).checkpoint()
        before, waiting = waiting, left.count()
        if waiting == before:
            break
    lost = left.select("k", F.lit(None).cast(own.schema["k"].dataType).alias("root"), F.lit(None).cast("long").alias("depth"), F.lit("cycle").alias("kind"))
    return done.unionByName(lost).withColumnRenamed("k", key)
