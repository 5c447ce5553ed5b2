"""Periodic reports: scores, protected lists, leftovers, recurring entities."""

from pyspark.sql import functions as F

from sieveline.functions import values as V
from sieveline.operators import groups as G
from sieveline.plans.registry import query, table

_SCORE = "CASE WHEN o_totalprice > 300000 THEN 30 ELSE 0 END + CASE WHEN o_orderpriority = '1-URGENT' THEN 25 ELSE 0 END + CASE WHEN o_orderstatus = 'P' THEN 20 ELSE 0 END + least(n, 25)"
_TRIAGE = f"t AS (SELECT o_orderkey, o_custkey, o_orderdate, CAST({_SCORE} AS BIGINT) AS score FROM orders JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) USING (o_custkey))"


def triaged(spark, sf):
    o = table(spark, sf, "orders")
    points = lambda c, n: F.when(c, n).otherwise(0)
    seen = o.groupBy("o_custkey").agg(F.count("*").alias("n"))
    score = points(F.col("o_totalprice") > 300000, 30) + points(F.col("o_orderpriority") == "1-URGENT", 25) + points(F.col("o_orderstatus") == "P", 20) + F.least("n", F.lit(25))
    return o.join(seen, "o_custkey").select("o_orderkey", "o_custkey", "o_orderdate", score.cast("long").alias("score"))


@query(f"WITH {_TRIAGE} SELECT o_orderkey, score, CASE WHEN score >= 60 THEN 'critical' WHEN score >= 45 THEN 'high' WHEN score >= 30 THEN 'medium' ELSE 'low' END AS risk FROM t")
def triage_score(spark, sf):
    return triaged(spark, sf).select("o_orderkey", "score", V.band("score", [(60, "critical"), (45, "high"), (30, "medium")], "low").alias("risk"))


@query(f"WITH {_TRIAGE} SELECT o_orderkey, CASE WHEN o_custkey % 50 = 0 THEN greatest(score, 50) ELSE score END AS score FROM t")
def floor_override(spark, sf):
    return triaged(spark, sf).select("o_orderkey", F.when(F.col("o_custkey") % 50 == 0, F.greatest("score", F.lit(50))).otherwise(F.col("score")).alias("score"))


@query("""
    WITH s AS (SELECT s_suppkey, s_acctbal, s_nationkey = 3 AS p FROM supplier), n AS (SELECT greatest(12, count(*) FILTER (p)) AS n FROM s),
    r AS (SELECT *, row_number() OVER (ORDER BY p DESC, s_acctbal DESC, s_suppkey) AS rn FROM s) SELECT s_suppkey, s_acctbal FROM r, n WHERE rn <= n""")
def protected_top_k(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    return G.protected_top(s, F.col("s_nationkey") == 3, [F.desc("s_acctbal"), F.col("s_suppkey")], 12).drop("s_nationkey")


@query(f"""
    WITH {_TRIAGE}, pub AS (SELECT o_orderkey FROM t ORDER BY score DESC, o_orderkey LIMIT 100) SELECT o_orderkey, score FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM pub)""")
def inventory_leftovers(spark, sf):
    t = triaged(spark, sf).select("o_orderkey", "score")
    return t.join(t.orderBy(F.desc("score"), "o_orderkey").limit(100), "o_orderkey", "left_anti")


@query("""
    WITH d AS (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) AS rn, count(*) OVER (PARTITION BY l_suppkey) AS n FROM d)
    SELECT l_suppkey, max(n) AS n, string_agg(CAST(l_orderkey AS VARCHAR), ' ' ORDER BY rn) AS refs FROM r WHERE rn <= 6 AND n >= 2 GROUP BY l_suppkey""")
def recurring_entities(spark, sf):
    d = table(spark, sf, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select("l_suppkey", "l_orderkey").distinct()
    g = d.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("l_orderkey")).alias("r")).where("n >= 2")
    return g.select("l_suppkey", "n", F.array_join(F.transform(F.slice("r", 1, 6), lambda x: x.cast("string")), " ").alias("refs"))


@query("""
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 99 END, o_totalprice DESC, o_orderkey""")
def custom_order(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return o.orderBy(V.rank_of("o_orderpriority", ["1-URGENT", "2-HIGH"]), F.desc("o_totalprice"), "o_orderkey")


@query("SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 10")
def seeded_sample(spark, sf):
    return G.hash_sample(table(spark, sf, "documents").select("doc_id"), "doc_id", 10)


@query("""
    WITH x AS (SELECT doc_id, CASE WHEN regexp_matches(text, 'http') THEN 3 ELSE 0 END AS web, CASE WHEN regexp_matches(text, '[0-9]') THEN 2 ELSE 0 END + CASE WHEN regexp_matches(text, '\\|') THEN 2 ELSE 0 END AS data, CASE WHEN regexp_matches(text, '[.!?]') THEN 1 ELSE 0 END AS prose FROM documents)
    SELECT doc_id, CASE WHEN greatest(web, data, prose) = 0 THEN NULL WHEN web >= data AND web >= prose THEN 'web' WHEN data >= prose THEN 'data' ELSE 'prose' END AS label FROM x""")
def weighted_rules(spark, sf):
    rules = [("web", "http", 3), ("data", "[0-9]", 2), ("data", r"\|", 2), ("prose", "[.!?]", 1)]
    return table(spark, sf, "documents").select("doc_id", F.get(G.rules_score(F.col("text"), rules), F.lit(0))["label"].alias("label"))


@query()
def global_cap(spark, sf):
    """Text lengths of each conversation cut at one level until they add up to 400 characters."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    return G.shrink_to(c, ["conv_id"], "n", 400, 20)
