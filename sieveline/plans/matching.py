"""Joins: semi, anti, diff, cascade, positional, interval, nearest, fuzzy."""

from pyspark.sql import functions as F

from sieveline.functions.text import match_key
from sieveline.operators import joins as J
from sieveline.operators import similar as S
from sieveline.plans.registry import query, spread, table

_HASH = "md5(text)"


@query("SELECT n_name, r_name, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def multiway_join(spark, sf):
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    joined = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return joined.groupBy("n_name", "r_name").agg(F.count("*").alias("suppliers"))


@query("SELECT doc_id, source, coalesce(quality, -1) AS quality, coalesce(toxic, 9) AS sort_key FROM documents LEFT JOIN labels USING (doc_id)")
def left_join_default(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", "source", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(9)).alias("sort_key"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def left_semi_labeled(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left_semi")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def left_anti_unlabeled(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left_anti")


@query("""
    WITH l AS (SELECT d.doc_id, lang, source, n_chars FROM documents d JOIN labels USING (doc_id))
    SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.doc_id = d.doc_id) AND NOT EXISTS (SELECT 1 FROM l WHERE l.source = d.source AND l.n_chars = d.n_chars)
      AND NOT EXISTS (SELECT 1 FROM l WHERE l.lang = d.lang AND l.source = d.source AND l.n_chars = d.n_chars)""")
def anti_multi_key(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    there = d.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return J.anti_any(d, there, [["doc_id"], ["source", "n_chars"], ["lang", "source", "n_chars"]]).select("doc_id")


OLD, NEW = "o_orderdate < TIMESTAMP '2000-01-01'", "o_orderdate >= TIMESTAMP '1996-01-01'"


def order_snapshots(spark, sf):
    """Orders as of 2000, and those since 1996 of which one in ten has another status."""
    o = table(spark, sf, "orders")
    changed = F.when(F.col("o_orderkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus"))
    return o.where(OLD), o.where(NEW).withColumn("o_orderstatus", changed)


@query(f"""
    WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE {OLD}),
    n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS s, o_totalprice AS p FROM orders WHERE {NEW})
    SELECT coalesce(o.k, n.k) AS o_orderkey, CASE WHEN o.k IS NULL THEN 'new' WHEN n.k IS NULL THEN 'vanished' WHEN o.s = n.s AND o.p = n.p THEN 'equal' ELSE 'changed' END AS change FROM o FULL JOIN n ON o.k = n.k""")
def full_outer_diff(spark, sf):
    return J.full_diff(*order_snapshots(spark, sf), "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("""
    WITH l AS (SELECT c_custkey, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey END AS k1, round(c_acctbal) AS k2, c_mktsegment AS k3 FROM customer),
    r AS (SELECT c_custkey AS v, c_custkey AS k1, round(c_acctbal) AS k2, c_mktsegment AS k3 FROM customer),
    a AS (SELECT k1, min(v) AS v FROM r GROUP BY k1), b AS (SELECT k2, min(v) AS v FROM r GROUP BY k2 HAVING count(*) = 1), c AS (SELECT k3, min(v) AS v FROM r GROUP BY k3 HAVING count(*) = 1)
    SELECT c_custkey, coalesce(a.v, b.v, c.v) AS v, CASE WHEN a.v IS NOT NULL THEN 'k1' WHEN b.v IS NOT NULL THEN 'k2' WHEN c.v IS NOT NULL THEN 'k3' END AS step
    FROM l LEFT JOIN a USING (k1) LEFT JOIN b ON l.k2 = b.k2 LEFT JOIN c ON l.k3 = c.k3""")
def cascade_key_join(spark, sf):
    keys = [F.round("c_acctbal").alias("k2"), F.col("c_mktsegment").alias("k3")]
    c = table(spark, sf, "customer")
    left = c.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("k1"), *keys)
    right = c.select(F.col("c_custkey").alias("v"), F.col("c_custkey").alias("k1"), *keys)
    return J.cascade(left, right, [("k1", False), ("k2", True), ("k3", True)], "v").select("c_custkey", "v", "step")


@query("""
    WITH p AS (SELECT p_name AS path, p_partkey FROM part), n AS (SELECT p_name, count(*) AS n FROM part GROUP BY 1)
    SELECT p_partkey, CASE WHEN n = 1 THEN p_name END AS unique_name FROM part JOIN n USING (p_name)""")
def unique_name_join(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    once = J.only_once(p, ["p_name"]).select("p_partkey", F.col("p_name").alias("unique_name"))
    return p.select("p_partkey").join(once, "p_partkey", "left")


@query("""
    WITH a AS (SELECT o_custkey AS k, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth FROM orders),
    b AS (SELECT user_id AS k, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events)
    SELECT coalesce(a.k, b.k) AS k, coalesce(a.nth, b.nth) AS nth, o_orderkey, event_id FROM a FULL JOIN b ON a.k = b.k AND a.nth = b.nth""")
def positional_kth_join(spark, sf):
    a = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_orderdate")
    b = table(spark, sf, "events").select(F.col("user_id").alias("k"), "event_id", "ts")
    return J.positional(a, b, "k", ["o_orderdate", "o_orderkey"], ["ts", "event_id"]).select("k", F.col("nth").cast("long").alias("nth"), "o_orderkey", "event_id")


@query("""
    WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events), r AS (SELECT event_id AS range_id, user_id AS u, CAST(ts AS DATE) - 1 AS lo, CAST(ts AS DATE) + 1 AS hi FROM events WHERE event_type = 'purchase')
    SELECT event_id, range_id FROM e JOIN r ON user_id = u AND d BETWEEN lo AND hi WHERE event_id <> range_id""")
def interval_join_events(spark, sf):
    """Every event with every purchase of its user within a day: the result is as large as their product for each user and day."""
    e = table(spark, sf, "events").withColumn("d", F.col("ts").cast("date"))
    ranges = e.where("event_type = 'purchase'").select(F.col("event_id").alias("range_id"), "user_id", F.date_sub("d", 1).alias("lo"), F.date_add("d", 1).alias("hi"))
    return J.interval(e.select("event_id", "user_id", "d"), ranges, "d", "lo", "hi", 7, ["user_id"]).where("event_id <> range_id").select("event_id", "range_id")


@query("""
    SELECT o_orderkey, (SELECT max(p.o_orderdate) FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderkey < o.o_orderkey) AS before,
      (SELECT min(p.o_orderdate) FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderkey > o.o_orderkey) AS after FROM orders o""")
def nearest_before_after(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return J.neighbours(o, ["o_custkey"], "o_orderkey", "o_orderdate").select("o_orderkey", "before", "after")


@query("""
    WITH n AS (SELECT n_nationkey, lower(n_name) AS n_name FROM nation), s AS (SELECT s_suppkey, lower(s_name) AS name FROM supplier),
    m AS (SELECT s_suppkey, n_name AS match, levenshtein(name, n_name) AS distance, row_number() OVER (PARTITION BY s_suppkey ORDER BY levenshtein(name, n_name), n_nationkey) AS rn FROM s, n)
    SELECT s_suppkey, match, distance FROM m WHERE rn = 1""")
def fuzzy_best_match(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.lower("s_name").alias("name"))
    n = table(spark, sf, "nation").select("n_nationkey", F.lower("n_name").alias("n_name"))
    return S.best_match(s, "name", n, "n_name", "n_nationkey").select("s_suppkey", "match", F.col("distance").cast("long").alias("distance"))


@query("""
    WITH o AS (SELECT p_partkey, p_name || ' ' || p_brand AS name, CASE WHEN p_partkey % 2 = 0 THEN p_name || 's' || p_brand ELSE replace(p_name, 'e', '') || ' ' || p_brand END AS typed FROM part),
    l AS (SELECT name AS match, min(p_partkey) AS p FROM o GROUP BY 1), t AS (SELECT DISTINCT typed FROM o),
    m AS (SELECT typed, match, levenshtein(typed, match) AS distance, row_number() OVER (PARTITION BY typed ORDER BY levenshtein(typed, match), p) AS rn FROM t, l)
    SELECT p_partkey, match, distance FROM o JOIN m USING (typed) WHERE rn = 1""")
def mistyped_names(spark, sf):
    """All names and brands of parts as the reference list; what is looked up has a letter too many, or none of the letter e."""
    p = table(spark, sf, "part")
    name = F.concat("p_name", F.lit(" "), "p_brand")
    typed = F.when(F.col("p_partkey") % 2 == 0, F.concat("p_name", F.lit("s"), "p_brand")).otherwise(F.concat(F.replace("p_name", F.lit("e"), F.lit("")), F.lit(" "), "p_brand"))
    rows, listed = p.select("p_partkey", typed.alias("typed")), p.select("p_partkey", name.alias("name"))
    return S.best_match(rows, "typed", listed, "name", "p_partkey").select("p_partkey", "match", F.col("distance").cast("long").alias("distance"))


@query("""
    WITH p AS (SELECT DISTINCT p_type AS t, list_sort(list_distinct(str_split(lower(p_type), ' '))) AS all_ FROM part),
    l AS (SELECT DISTINCT list_sort(list_distinct(str_split(lower(p_name), ' '))) AS toks FROM part),
    l2 AS (SELECT p_partkey, list_sort(list_distinct(str_split(lower(p_type), ' ')))[1:1] AS toks FROM part),
    m AS (SELECT p_partkey, min(t) AS t, count(DISTINCT t) AS n FROM l2 JOIN p ON list_has_all(all_, toks) GROUP BY 1)
    SELECT p_partkey, CASE WHEN n = 1 THEN t END AS t FROM l2 LEFT JOIN m USING (p_partkey)""")
def token_subset_match(spark, sf):
    tokens = F.array_sort(F.array_distinct(F.split(F.lower("p_type"), " ")))
    p = table(spark, sf, "part")
    left = p.select("p_partkey", F.slice(tokens, 1, 1).alias("toks"))
    return J.token_subset(left, p.select(F.col("p_type").alias("t"), tokens.alias("all")).distinct(), "toks", "all", "t").select("p_partkey", "t")


@query("""
    WITH u AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS path FROM pages), p AS (SELECT DISTINCT path FROM u)
    SELECT page_id, u.path, (SELECT max_by(p.path, length(p.path)) FROM p WHERE starts_with(u.path, p.path || '/')) AS parent FROM u""")
def parent_child_join(spark, sf):
    u = table(spark, sf, "pages").select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("path"))
    return J.parents(u, "path").select("page_id", "path", "parent")


@query("""
    SELECT a.p_partkey, b.p_partkey AS other FROM part a JOIN part b ON a.p_name = b.p_name AND a.p_brand = b.p_brand AND a.p_size <> b.p_size""")
def homonym_warning(spark, sf):
    """All pairs of a name and brand that differ in size: their number is the result's, and grows with the square of how often a name is taken. The rows are few
    MB, so they are dealt by name to all cores; else the few tasks that read them would make all pairs."""
    p = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size"), "p_name", "p_brand")
    other = p.select(F.col("p_partkey").alias("other"), "p_name", "p_brand", F.col("p_size").alias("other_size"))
    return p.join(other, ["p_name", "p_brand"]).where("p_size <> other_size").select("p_partkey", "other")


@query("""
    SELECT key, min(n_name) AS name FROM (SELECT lower(r_name) AS key, n_name FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY key""")
def dimension_lookup(spark, sf):
    r = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), match_key("r_name").alias("key"))
    return table(spark, sf, "nation").join(r, "n_regionkey").groupBy("key").agg(F.min("n_name").alias("name"))


@query("""
    SELECT event_type AS t FROM (SELECT event_type FROM events INTERSECT SELECT DISTINCT event_type FROM events WHERE value > 50)""")
def set_intersect(spark, sf):
    e = table(spark, sf, "events")
    return J.in_both(e.select(F.col("event_type").alias("t")), e.where("value > 50").select(F.col("event_type").alias("t")))


@query("""
    SELECT c_custkey AS k, 'customer' AS side FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL
    SELECT DISTINCT user_id, 'events' FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)""")
def both_differences(spark, sf):
    c, o, e = table(spark, sf, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "events").select(F.col("user_id").alias("k"))
    return c.join(o, "k", "left_anti").withColumn("side", F.lit("customer")).unionByName(e.distinct().join(c, "k", "left_anti").withColumn("side", F.lit("events")))


@query("""
    WITH u AS (SELECT doc_id AS k, 0 AS q FROM documents WHERE lang = 'fr' UNION ALL SELECT doc_id, 1 FROM documents WHERE n_chars < 1000 UNION ALL SELECT doc_id, 2 FROM labels)
    SELECT k, min(q) AS q FROM u GROUP BY k""")
def union_by_identity(spark, sf):
    d, one = table(spark, sf, "documents"), lambda df, q: df.select(F.col("doc_id").alias("k"), F.lit(q).alias("q"))
    rows = one(d.where("lang = 'fr'"), 0).unionByName(one(d.where("n_chars < 1000"), 1)).unionByName(one(table(spark, sf, "labels"), 2))
    return rows.groupBy("k").agg(F.min("q").alias("q"))


@query("""
    WITH d AS (SELECT o_orderkey, o_custkey, bool_or(o_orderstatus = 'P') OVER (PARTITION BY o_custkey) AS flagged FROM orders) SELECT * FROM d""")
def flag_propagation(spark, sf):
    from pyspark.sql import Window

    flag = F.bool_or(F.col("o_orderstatus") == "P").over(Window.partitionBy("o_custkey"))
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", flag.alias("flagged"))
