"""Exact top-k search by inner product of whole-numbered vectors: exhaustive, term at a time.

A term is a dimension. Vectors are dealt round-robin into blocks of a bounded number of components and written once; queries
likewise. Every block of candidates meets every block of queries as one group: the candidates' postings (term -> rows and
weights) are made once, and the terms of a sparse query row scatter its weighted postings into a dense array of scores. A
partition selection keeps the best rows of a block, and a ranking by query merges what the blocks kept. Nothing is
broadcast or collected but row counts.

Cases: vectors that are null or hold null or non-finite components (after scaling, too) take no part; components a shorter
vector lacks are 0. Copies are candidates like others, and so is another row with the query's own id: of all rows
just one that equals the query in id and score is left out. Ties go to the smaller id, null ids last; a null id is no
query. Scores are exact at any size of the components; one beyond a long is returned as the nearest long. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import new_root, stash

#: Components that a block of candidates or of queries holds at most, and rows that are worth a task.
CANDIDATES, QUERIES, WORTH = 1 << 22, 1 << 20, 1024
#: A term that more than this share of a block's rows hold is kept as a whole column of weights.
DENSE = 0.25
LONG = np.iinfo(np.int64)


def whole_numbered(vectors: DataFrame, scale: int, vector: str, vec_id: str) -> DataFrame:
    """(vec_id, v): floor(scale * component) as doubles, which hold them exactly."""
    scaled = F.transform(F.col(vector), lambda c: c.cast("double") * scale)
    fit = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(scaled, lambda c: F.when(F.abs(c) < 2.0**52, F.floor(c).cast("double")).otherwise(c))  # larger doubles are whole
    return vectors.where(F.col(vector).isNotNull()).where(fit).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a column of lists, the shorter ones filled up with 0."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def whole(m: np.ndarray, bound: float) -> np.ndarray:
    """m in the narrowest type in which sums up to bound are exact; beyond a long, Python's whole numbers."""
    if bound < 2**31:
        return m.astype(np.int32)
    if bound < 2**62:
        return m.astype(np.int64)
    return np.array([[int(c) for c in row] for row in m], object).reshape(m.shape)


def in_longs(scores: np.ndarray) -> np.ndarray:
    return np.array([min(max(s, LONG.min), LONG.max) for s in scores], np.int64) if scores.dtype == object else scores


class Postings:
    """term -> (rows or None for all rows, weights) of a block of candidates."""

    def __init__(self, m: np.ndarray):
        self.rows, self.kind, self.terms = len(m), m.dtype, []
        for column in m.T:
            held = np.flatnonzero(column)
            few = len(held) <= DENSE * len(m)
            self.terms.append((held, column[held]) if few else (None, np.ascontiguousarray(column)))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Of each row with a query row; only the query's own terms are looked at."""
        total, part = np.zeros(self.rows, self.kind), np.empty(self.rows, self.kind)
        for term in np.flatnonzero(query[: len(self.terms)]):
            held, weights = self.terms[term]
            if held is None:
                np.multiply(weights, query[term], out=part)
                total += part
            else:
                total[held] += weights * query[term]
        return total


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, the earlier of equal ones first."""
    places = np.arange(len(scores))
    if len(scores) > k:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return places[np.argsort(~scores[places], kind="stable")[:k]]  # ~s is -s - 1, which every whole number has


def _pair(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    order = np.lexsort((candidates["vec_id"].fill_null(0).to_numpy(), candidates["vec_id"].is_null().to_numpy(zero_copy_only=False)))
    candidates = candidates.take(pa.array(order))
    c, q = matrix(candidates["v"]), matrix(queries["v"])
    high, own_high = float(np.abs(c).max(initial=0)), float(np.abs(q).max(initial=0))
    bound = max(high, own_high, 1.0) * max(own_high, 1.0) * max(1, q.shape[1])
    c, q = whole(c, bound), whole(q, bound)
    postings, ids = Postings(c), candidates["vec_id"].combine_chunks()
    rows, places, scores, own = [], [], [], []
    for row, query in enumerate(q):
        found = in_longs(postings.scores(query))
        top = best(found, k + 1)
        rows += [row] * len(top)
        places += top.tolist()
        scores += found[top].tolist()
        own += [min(sum(x * x for x in query.tolist()), LONG.max)] * len(top)
    at = pa.array(rows, pa.int64())
    columns = [queries["row"].take(at), queries["vec_id"].take(at), pa.array(own, pa.int64()), ids.take(pa.array(places, pa.int64())), pa.array(scores, pa.int64())]
    return pa.table(columns, names=["row", "query_id", "own", "vec_id", "score"])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of vectors where is_query holds, the k other rows with the highest inner products. is_query may use the id, as vec_id."""
    spark, root = vectors.sparkSession, new_root(vectors.sparkSession, "top_k")
    own = whole_numbered(vectors, scale, vector, vec_id)
    size = own.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.max(F.size("v")).alias("width")).first()
    width = max(size["width"] or 0, 1)

    def dealt(rows: DataFrame, n: int, most: int, name: str, least: int) -> tuple[DataFrame, int]:
        """rows in blocks of most components at most, as the table name; block: from 0. At least as many blocks as least."""
        blocks = max(1, -(-n * width // most), min(least, n // WORTH))
        return stash(rows.repartition(blocks).withColumn("block", F.spark_partition_id()), root, name), blocks

    candidates, many = dealt(own, size["n"], CANDIDATES, "candidates", 2 * spark.sparkContext.defaultParallelism)
    queries, blocks = dealt(own.where(is_query), size["q"], QUERIES, "queries", 1)
    queries = queries.withColumn("row", F.monotonically_increasing_id())
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = candidates.withColumn("q", every(blocks)).groupBy("block", "q")
    right = queries.withColumnRenamed("block", "q").withColumn("block", every(many)).groupBy("block", "q")
    kept = left.cogroup(right).applyInArrow(lambda c, q: _pair(c, q, k), "row long, query_id long, own long, vec_id long, score long")
    by = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = kept.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k + 1)
    itself = F.min(F.when((F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own")), F.col("place"))).over(Window.partitionBy("row"))
    ranked = ranked.withColumn("itself", F.coalesce(itself, F.lit(k + 2))).where("place <> itself")
    rank = F.col("place") - F.when(F.col("itself") < F.col("place"), 1).otherwise(0)
    return ranked.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def top_k_sql(every: int = 50, k: int = 5, scale: int = 256) -> str:
    return f"""
        WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: CAST(floor({scale} * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
          FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % {every} = 0),
        o AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS INT) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM o WHERE rank <= {k}"""
