"""Bit signatures of vectors, and rows whose signatures are a few bits apart, by an index over chunks of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 64
#: Above so many signatures under one chunk, a second chunk is part of the key.
HOT = 1000


def planes(dimensions: int) -> np.ndarray:
    """Signs, dimensions x BITS, from a rule: the parity of the bits of a mixed product of both places, counted from 1. Two vectors get the same signs at any length."""
    i, j = np.arange(1, dimensions + 1, dtype=np.uint64)[:, None], np.arange(1, BITS + 1, dtype=np.uint64)[None, :]
    mixed = ((i * np.uint64(40503) + j * np.uint64(30011)) * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)
    return 1 - 2 * (np.bitwise_count(mixed).astype("int64") % 2)


def signature(whole: Column) -> Column:
    """BITS signs of random projections of an array<bigint>, as a long; the sums are whole numbers, and so exact. Null for null."""

    @F.pandas_udf("long")
    def signs(vectors: pd.Series) -> pd.Series:
        table = planes(max((len(v) for v in vectors if v is not None), default=0))
        bits = [None if v is None else np.packbits(v @ table[: len(v)] > 0, bitorder="little").view("int64")[0] for v in vectors]
        return pd.Series(bits, dtype="Int64")

    return signs(whole)


def _chunks(k: int) -> list[tuple[int, int]]:
    """(start, width) of k + 1 chunks that cover the bits: with k bits wrong, one of them is right."""
    ends = [BITS * n // (k + 1) for n in range(k + 2)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def _piece(sig: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(sig, start).bitwiseAND(F.lit((1 << width) - 1))


def near_links(rows: DataFrame, key: str, by: str, sig: str, size: str, k: int, percent: int = 21, hot: int = HOT) -> DataFrame:
    """(a, b): links whose components are those of all pairs of rows of the same group that are at most k >= 1 bits apart and
    of whose sizes (whole numbers, not negative) the larger is at most so many percent above the smaller.

    Rows of one group and signature first come down to runs of sizes without a gap, and each row is linked to the smallest key of its run;
    two runs hold a pair within the gate if and only if they come that near to each other, so only runs are compared. Runs
    meet where one of k + 1 chunks is the same. Under a frequent chunk the other k chunks have at most k wrong bits, so one of them
    has at most one, and this one is part of the key, with each bit turned over on one side. Rows with a null are left out.
    """
    near = lambda a, b: F.lit(100) * b <= F.lit(100 + percent) * a
    own = rows.select(F.col(key).alias("k"), F.col(by).alias("g"), F.col(sig).alias("s"), F.col(size).cast("decimal(30,0)").alias("n")).dropna()
    sizes = own.groupBy("g", "s", "n").agg(F.min("k").alias("first"))
    w = Window.partitionBy("g", "s").orderBy("n")
    gap = F.coalesce(~near(F.lag("n").over(w), F.col("n")), F.lit(True)).cast("int")
    parted = sizes.withColumn("gap", gap).withColumn("run", F.sum("gap").over(w))
    parted = parted.withColumn("rep", F.min("first").over(Window.partitionBy("g", "s", "run")))
    members = own.join(parted.select("g", "s", "n", "rep"), ["g", "s", "n"]).where("k <> rep").select(F.col("k").alias("a"), F.col("rep").alias("b"))

    runs = parted.groupBy("g", "s", "run", "rep").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    chunks = _chunks(k)
    keys = F.array(*[F.struct(F.lit(c).alias("c"), _piece(F.col("s"), *chunk).alias("v")) for c, chunk in enumerate(chunks)])
    keyed = runs.select("g", "s", "rep", "lo", "hi", F.explode(keys).alias("x")).select("*", "x.c", "x.v").drop("x")
    many = keyed.groupBy("g", "c", "v").agg(F.count("*").alias("rows")).where("rows > 1").withColumn("hot", F.col("rows") > hot).drop("rows")
    keyed = keyed.join(many, ["g", "c", "v"])

    def other(turned: bool) -> Column:
        """The other chunks of a hot row; if turned, with each single bit the other way as well."""
        found = []
        for c, (start, width) in enumerate(chunks):
            v = _piece(F.col("s"), start, width)
            for x in [v, *[v.bitwiseXOR(F.lit(1 << bit)) for bit in range(width if turned else 0)]]:
                found.append(F.when(F.col("c") != c, F.struct(F.lit(c).alias("c2"), x.alias("v2"))))
        return F.array_compact(F.array(*found))

    plain = F.array(F.struct(F.lit(-1).alias("c2"), F.lit(0).cast("long").alias("v2")))
    side = lambda p, turned: keyed.select("g", "c", "v", *[F.col(x).alias(f"{p}_{x}") for x in ("s", "rep", "lo", "hi")], F.explode(F.when(F.col("hot"), other(turned)).otherwise(plain)).alias("x")).select("*", "x.c2", "x.v2").drop("x")
    pairs = side("a", False).join(side("b", True), ["g", "c", "v", "c2", "v2"]).where("a_s < b_s or (a_s > b_s and c2 >= 0)")
    close = (F.bit_count(F.col("a_s").bitwiseXOR(F.col("b_s"))) <= k) & near(F.col("a_hi"), F.col("b_lo")) & near(F.col("b_hi"), F.col("a_lo"))
    return members.union(pairs.where(close).select(F.greatest("a_rep", "b_rep").alias("a"), F.least("a_rep", "b_rep").alias("b")).distinct())
