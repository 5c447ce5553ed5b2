"""Mixing sources to target weights.

Every document gets a key that is a hash of its id and a seed. Within a source, documents are
range-sorted by that key: leading hex digits give a range, ranges are summed, a running sum
over the ranges gives each its start, and inside a range a running sum finishes the job. So a
source of any size is spread over 16**digits tasks. A document takes as many whole epochs as
fit in its source's budget, and the remainder is cut exactly where the running sum meets it.

Null texts have size 0 and take nothing; a null source is a source of its own, sorted last;
rows with equal ids have equal keys and go by size; rows equal in that too may change places,
which changes no total. A text of any length is counted whole by one task; ids may have any type; other
columns are not looked at unless keep names them. Windows over all sources run in one task: a row a source.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import new_root, stash, text_of, word_count


def source_key(col: str = "source") -> Column:
    """Sorts by code point with null last, and equal for nulls, so joins may use it."""
    return F.when(F.col(col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(col)))


def targets(sizes: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes: (sk, source_size). Adds target: share of all sizes by weight, none above most times its source.

    Sources fill up in the order of room per weight; the first that does not fill up, and all
    after it, share what is left by weight. That is what resharing the excess comes to.
    One row per source, so one window over them all is small.
    """
    listed = sizes.withColumn("nth", F.row_number().over(Window.orderBy("sk")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights)).cast("int") + 1)
    listed = listed.withColumn("weight", weight).withColumn("room", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy((F.col("room") / F.col("weight")).asc(), F.col("sk").asc())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = listed.withColumn("level", left / open_weight)
    fits = F.when(F.col("room") > F.col("level") * F.col("weight"), F.col("level"))
    final = F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return level.withColumn("final", final).select("sk", "source_size", F.coalesce(F.least("room", F.col("final") * F.col("weight")), "room").alias("target"))


def mix(docs: DataFrame, seed: str = "mix-1", weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, digits: int = 3, keep=()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row of docs; the columns in keep come along as one struct, kept."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id"),
        source_key().alias("sk"),
        word_count(text_of()).alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
        *([F.struct(*keep).alias("kept")] if keep else []),
    ).withColumn("range", F.substring("key", 1, digits))
    if not keep:  # sizes and keys alone are worth a table of their own
        rows = stash(rows, new_root(spark, "mix"), "rows")

    ranges = rows.groupBy("sk", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("sk").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("range_start", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
    plan = targets(ranges.groupBy("sk").agg(F.sum("range_size").alias("source_size")), weights, share, most)
    starts = starts.join(plan, "sk").select("sk", "range", "range_start", "source_size", "target")

    inside = Window.partitionBy("sk", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(starts, ["sk", "range"]).withColumn("start", F.col("range_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("start")))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), *(["kept"] if keep else []))
