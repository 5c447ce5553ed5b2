"""Retrieval over embeddings: cosine, governance, rerank, boost, quota."""

from pyspark.sql import functions as F

from sieveline.functions import values as V
from sieveline.operators import groups as G
from sieveline.plans.registry import query, table

_COS = "list_dot_product(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) / (sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(q.embedding::DOUBLE[], q.embedding::DOUBLE[])) + 1e-9)"
_SCORED = f"s AS (SELECT e.vec_id, e.label, round({_COS}, 6) AS score FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q)"


def scored(spark, sf):
    """All vectors against the one with id 0, a scalar subquery of the same plan."""
    e = table(spark, sf, "embeddings")
    asked = e.where("vec_id = 0").agg(F.first("embedding")).scalar()
    return e.select("vec_id", "label", "embedding", asked.alias("asked")).select("vec_id", "label", F.round(V.cosine("embedding", "asked"), 6).alias("score"))


@query(f"WITH {_SCORED} SELECT vec_id, score FROM s ORDER BY score DESC, vec_id LIMIT 14")
def cosine_top_k(spark, sf):
    return scored(spark, sf).select("vec_id", "score").orderBy(F.desc("score"), "vec_id").limit(14)


@query(f"""
    WITH {_SCORED}, w AS (SELECT vec_id, round(score * CASE WHEN label % 2 = 0 THEN 1.0 ELSE 0.85 END * (1 + 0.08 * exp(-label / 6.0)), 6) AS score FROM s WHERE label <> 3)
    SELECT vec_id, score FROM w ORDER BY score DESC, vec_id LIMIT 20""")
def rerank_weighted(spark, sf):
    s = scored(spark, sf).where("label <> 3").withColumn("quality", F.when(F.col("label") % 2 == 0, "ok").otherwise("poor"))
    score = F.round(V.recency(F.col("score"), "quality", F.lit(2024) - F.col("label"), 2024), 6)
    return s.select("vec_id", score.alias("score")).orderBy(F.desc("score"), "vec_id").limit(20)


@query(f"""
    WITH {_SCORED}, t AS (SELECT *, row_number() OVER (ORDER BY score DESC, vec_id) AS rn FROM s)
    SELECT vec_id, CASE WHEN rn <= 200 AND label = 5 THEN round(score * 1.12, 6) ELSE score END AS boosted, rn <= 200 AS rescored FROM t""")
def lexical_boost_top_n(spark, sf):
    """The best 200 are scored again and come first; the rest follows in its order."""
    s = scored(spark, sf)
    top = s.orderBy(F.desc("score"), "vec_id").limit(200).select("vec_id", F.lit(True).alias("rescored"))
    both = s.join(F.broadcast(top), "vec_id", "left").withColumn("rescored", F.coalesce("rescored", F.lit(False)))
    boosted = F.when(F.col("rescored") & (F.col("label") == 5), F.round(F.col("score") * 1.12, 6)).otherwise(F.col("score"))
    return both.select("vec_id", boosted.alias("boosted"), "rescored").orderBy(F.desc("rescored"), F.desc("boosted"), "vec_id")


@query(f"""
    WITH {_SCORED}, t AS (SELECT * FROM s),
    n AS (SELECT *, label < 5 AS cat, row_number() OVER (PARTITION BY label < 5 ORDER BY score DESC, vec_id) AS nth FROM t),
    p AS (SELECT vec_id, label, score, row_number() OVER (ORDER BY CASE WHEN cat AND nth > 6 THEN 1 ELSE 0 END, score DESC, vec_id) AS place FROM n)
    SELECT vec_id, label, score, place FROM p WHERE place <= 14""")
def quota_with_refill(spark, sf):
    return G.quota(scored(spark, sf), [F.desc("score"), F.col("vec_id")], F.col("label") < 5, 6, 14).withColumn("place", F.col("place").cast("long"))


@query(f"""
    WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rn FROM s) SELECT label, vec_id, score FROM r WHERE rn <= 3""")
def top_per_label(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("label").orderBy(F.desc("score"), "vec_id")
    return scored(spark, sf).withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("label", "vec_id", "score")
