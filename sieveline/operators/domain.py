"""Composites: trees with synthetic parents, verdicts, repairs, sanity checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions import values as V
from sieveline.functions.extract import shortened
from sieveline.operators.groups import spread
from sieveline.streaming import root_of


def full_tree(rows: DataFrame, path: str, separator: str = "/") -> DataFrame:
    """(path, synthetic, members, parent): every path and every ancestor; those that no row has are synthetic."""
    there = rows.groupBy(path).agg(F.count("*").alias("members"))
    all_ = rows.select(F.explode(V.prefixes(path, separator)).alias(path)).distinct()
    cut = F.regexp_extract(path, f"^(.*){separator}[^{separator}]*$", 1)
    tree = all_.join(there, path, "left").withColumn("synthetic", F.col("members").isNull())
    return tree.withColumn("members", F.coalesce("members", F.lit(0))).withColumn("parent", F.nullif(cut, F.lit("")))


def verdict(*levels: tuple[Column, str], rest: str) -> Column:
    """The name of the first condition that holds; null conditions don't."""
    (c, name), *more = levels
    return reduce(lambda out, x: out.when(F.coalesce(x[0], F.lit(False)), x[1]), more, F.when(F.coalesce(c, F.lit(False)), name)).otherwise(rest)


def repaired(*sources: tuple[str, str], least: int = 1) -> list[Column]:
    """[text, reason]: the first source (column, reason) with at least so many characters."""
    good = lambda c: F.length(F.trim(F.col(c))) >= least
    return [
        F.coalesce(*[F.when(good(c), F.col(c)) for c, _ in sources]).alias("text"),
        verdict(*[(good(c), reason) for c, reason in sources], rest="none").alias("reason"),
    ]


def first_dated(*sources: tuple[Column, str, str], low: str, high: str) -> Column:
    """struct(date, source, grain) of the first date between low and high."""
    ok = lambda d: F.when(d.between(F.lit(low).cast("date"), F.lit(high).cast("date")), d)
    return F.coalesce(*[F.when(ok(d).isNotNull(), F.struct(d.alias("date"), F.lit(s).alias("source"), F.lit(g).alias("grain"))) for d, s, g in sources])


def checked(plan: DataFrame, rules: dict[str, Column], key: str) -> DataFrame:
    """One row of counts: rows, keys that repeat, and rows that break each rule (null breaks it)."""
    broken = [F.count_if(~F.coalesce(c, F.lit(False))).alias(name) for name, c in rules.items()]
    return plan.agg(F.count("*").alias("rows"), (F.count(key) - F.count_distinct(key)).alias("repeated"), *broken)


def to_columns(items: Column, n: int, name: str) -> list[Column]:
    """An array as n numbered columns; an item that an earlier one repeats is null in its place."""
    once = F.transform(items, lambda x, i: F.when(F.array_position(items, x) == i + 1, x))
    return [F.get(once, F.lit(k)).alias(f"{name}_{k + 1}") for k in range(n)]


def by_priority(items: Column, first: str) -> Column:
    """Distinct items, those that match first before the others, each part in its order."""
    items = F.array_distinct(items)
    return F.concat(F.filter(items, lambda x: x.rlike(first)), F.filter(items, lambda x: ~x.rlike(first)))


def nearest_before(df: DataFrame, key: str, text: str, mention: str, anchor: str) -> DataFrame:
    """(key, at, mention, anchor): each match of mention with the last match of anchor before it. Both are Java patterns without groups."""
    marked = F.regexp_replace(F.regexp_replace(F.col(text), f"({anchor})", "\x01A$1\x01"), f"({mention})", "\x01M$1\x01")
    parts = df.select(key, F.posexplode(F.split(marked, "\x01")).alias("at", "part"))
    from pyspark.sql import Window

    w = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("part").startswith("A"), F.substring("part", F.lit(2), F.length("part"))), ignorenulls=True).over(w)
    return parts.where(F.col("at") % 2 == 1).withColumn("anchor", last).where(F.col("part").startswith("M")).select(key, "at", F.substring("part", F.lit(2), F.length("part")).alias("mention"), "anchor")


def distinct_paths(df: DataFrame, key: str, folder: str, name: str, most: int = 259) -> DataFrame:
    """df with path: folder and name in at most so many characters. Of paths that are the same in any case, the first by key keeps it (one
    that needed no cut comes before one that did), the others are numbered from 2; where a numbered path is another row's path already, the number has a digest of the name beside it.
    The numbered rows are written to the shared folder once, and read again for each use."""
    w = Window.partitionBy(F.lower("path")).orderBy(F.length(F.concat(folder, F.lit("/"), name)) > most, key)
    kept, spark = root_of(df.sparkSession, "paths"), df.sparkSession
    df.withColumn("path", shortened(folder, name, most)).withColumn("_n", F.row_number().over(w)).write.parquet(kept)
    first = spread(spark.read.parquet(kept), key)
    alone, more = first.where("_n = 1").drop("_n"), first.where("_n > 1")
    numbered = more.withColumn("path", shortened(folder, name, most, F.concat(F.lit(" ("), "_n", F.lit(")"))))
    taken = alone.select(F.lower("path").alias("_path"), F.lit(True).alias("_taken"))
    marked = numbered.join(taken, F.lower("path") == F.col("_path"), "left")
    longer = shortened(folder, name, most, F.concat(F.lit(" ("), "_n", F.lit("-"), F.substring(F.md5(name), 1, 8), F.lit(")")))
    return alone.unionByName(marked.withColumn("path", F.when(F.col("_taken"), longer).otherwise(F.col("path"))).select(*alone.columns))
