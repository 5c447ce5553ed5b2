"""Whitening of embeddings: rows centred exactly, their Gramian matrix by MLlib, its eigenvectors on the driver, rows projected in tasks.

Entries become whole numbers x = floor(64 * c) + 1000000, so sums over all rows are exact (decimals), and so is n * x - S for each
entry; divided by n, these rows go into a RowMatrix, whose Gramian divided by n is the covariance. What the driver holds is
square in the number of dimensions and doesn't grow with the rows; the same goes for the projection that tasks get.

Cases: vectors that are null, empty or hold null or non-finite entries are dropped, and so are those shorter than the longest
one (they lack entries) and those of which an entry times 64 is beyond 2**62 (it fits no long). Repeated rows count as often as they
are there. A direction without variance can't be whitened: its values are 0, and identity_error then says 1. explained is 0 if no entry varies at all. A deviation
beyond a long is null. An empty table gives no rows. Clashing columns don't matter: only id and vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import new_root, stash

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32


def whole_numbered(vectors: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(vec_id, x) of the rows that take part, but for those that are too short."""
    scaled = F.transform(F.col(vector), lambda c: c.cast("double") * SCALE)
    fit = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**62))
    rows = vectors.where(F.size(vector) > 0).where(fit)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(scaled, lambda c: F.when(F.abs(c) < 2.0**62, F.floor(c) + SHIFT)).alias("x"))


def gramian(rows: Column, df: DataFrame, n: int, width: int) -> np.ndarray:
    """Sum of the outer products of a column of arrays of doubles, over n."""
    vectors = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(rows).alias("row")), "row")
    return RowMatrix(vectors, n, width).computeGramianMatrix().toArray() / n


class Fit:
    """n, exact sums and extremes of each dimension, and from the covariance the directions, numbered by falling variance."""

    def __init__(self, rows: DataFrame, components: int):
        found = rows.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.min("x").alias("low"), F.max("x").alias("high"))
        stats = found.orderBy("at").collect()  # a row for each dimension
        self.width, self.n = len(stats), int(stats[0]["n"])
        self.sums = [int(r["s"]) for r in stats]
        self.whole = [s // self.n for s in self.sums]
        self.rest = [s % self.n for s in self.sums]
        spread = [max(abs(self.n * r[e] - s) for e in ("low", "high")) for r, s in zip(stats, self.sums, strict=True)]
        self.largest, self.total = max(spread), sum(d * d for d in spread)
        variance, directions = np.linalg.eigh(gramian(self.centred(), rows, self.n, self.width))
        most = min(components, self.width)
        self.variance, self.directions = variance[::-1][:most], directions[:, ::-1][:, :most]
        trace = float(variance.sum())
        flat = max(variance.max(), 0) * self.width * np.finfo(float).eps
        self.directions = np.where(self.variance > flat, self.directions / np.sqrt(np.where(self.variance > flat, self.variance, 1)), 0)
        self.explained = np.maximum(self.variance, 0) / trace if trace > 0 else np.zeros(most)

    def centred(self) -> Column:
        """(n * x - S) / n of each entry; the numerator is exact."""
        kind = "long" if self.largest < 2**62 else "decimal(38,0)"
        offsets = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(r).cast("long").alias("r")) for q, r in zip(self.whole, self.rest, strict=True)])
        one = lambda x, o: ((x - o["q"]).cast(kind) * F.lit(self.n).cast("long") - o["r"]).cast("double") / F.lit(float(self.n))
        return F.zip_with("x", offsets, one)


def whitened(rows: DataFrame, fit: Fit) -> DataFrame:
    """(vec_id, deviation, w): w are the row's whitened components."""
    small = fit.total < 2**62
    kind = np.int64 if small else object
    shared = rows.sparkSession.sparkContext.broadcast((np.array(fit.whole, kind), np.array(fit.rest, kind), fit.directions))
    n = fit.n

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, r, directions = shared.value
        for b in batches:
            if len(b):
                off = (np.stack(b["x"].to_numpy()).astype(kind) - q) * n - r
                deviation = pd.array([int(d) if d < 2**63 else None for d in (off * off).sum(axis=1)], "Int64")
                yield pd.DataFrame({"vec_id": b["vec_id"].astype("Int64").to_numpy(object), "deviation": deviation, "w": list(off.astype(float) / n @ directions)})

    return rows.select("vec_id", "x").mapInPandas(run, "vec_id long, deviation long, w array<double>")


def whiten(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector that takes part and each component."""
    spark, root = vectors.sparkSession, new_root(vectors.sparkSession, "whitening")
    rows = whole_numbered(vectors, vector, vec_id)
    width = rows.agg(F.max(F.size("x"))).first()[0]
    if width is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    fit = Fit(rows := rows.where(F.size("x") == width), components)
    done = stash(whitened(rows, fit), root, "whitened")
    most = len(fit.explained)
    means = done.agg(*[F.avg(F.col("w")[k]) for k in range(most)]).first()
    off = F.zip_with("w", F.array(*map(F.lit, means)), lambda w, m: w - m)
    error = float(np.abs(gramian(off, done, fit.n, most) - np.eye(most)).max())
    each = done.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    share = F.element_at(F.array(*map(F.lit, fit.explained.tolist())), F.col("at") + 1)
    return each.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
