"""Inventories by file and period that can be added up: exact sums beside mergeable sketches of different values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**LG places of a sketch: at most 4 KB, and a standard error of about 1.04 / sqrt(2**LG), 1.6 %.
LG = 12


def inventory(rows: DataFrame, file: Column, period: Column, value: str, amount: str) -> DataFrame:
    """(id, file, period, n, total, seen): rows, the sum of amount, and a sketch of the different values, for each file and period; id names both. Rows without file or period are groups of their own; null values and amounts count in n only."""
    made = rows.groupBy(file.alias("file"), period.alias("period")).agg(F.count("*").alias("n"), F.coalesce(F.sum(amount), F.lit(0)).alias("total"), F.hll_sketch_agg(value, LG).alias("seen"))
    return made.select(F.concat_ws("|", F.coalesce(F.col("file").cast("string"), F.lit("")), F.coalesce(F.col("period").cast("string"), F.lit(""))).alias("id"), "*")


def periods(inventories: DataFrame) -> DataFrame:
    """(period, n, total, different) over all files: sums are exact, different is an estimate; a value that several files hold counts once."""
    return inventories.groupBy("period").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.hll_sketch_estimate(F.hll_union_agg("seen")).alias("different"))
