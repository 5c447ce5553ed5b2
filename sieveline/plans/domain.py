"""Composites of documents, orders and pages."""

from pyspark.sql import functions as F

from sieveline.functions import values as V
from sieveline.operators import domain as D
from sieveline.operators import groups as G
from sieveline.plans.registry import query, table

_PATH = "regexp_replace(url, '^[a-z]+://', '')"


@query(f"""
    WITH u AS (SELECT array_to_string(list_filter(str_split({_PATH}, '/'), lambda x: x <> ''), '/') AS path FROM pages),
    a AS (SELECT DISTINCT array_to_string(p[1:k], '/') AS path FROM (SELECT p, unnest(range(1, len(p) + 1)) AS k FROM (SELECT str_split(path, '/') AS p FROM u))),
    m AS (SELECT path, count(*) AS members FROM u GROUP BY path)
    SELECT path, members IS NULL AS synthetic, coalesce(members, 0) AS members, nullif(regexp_extract(path, '^(.*)/[^/]*$', 1), '') AS parent FROM a LEFT JOIN m USING (path)""")
def tree_synthetic_parents(spark, sf):
    path = F.array_join(F.filter(F.split(F.regexp_replace("url", "^[a-z]+://", ""), "/"), lambda x: x != ""), "/")
    return D.full_tree(table(spark, sf, "pages").select(path.alias("path")), "path")


@query("""
    WITH m AS (SELECT l_orderkey, unnest(range(1, max(l_linenumber) + 1)) AS l_linenumber FROM lineitem GROUP BY l_orderkey),
    g AS (SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber FROM m ANTI JOIN lineitem USING (l_orderkey, l_linenumber))
    SELECT g.l_orderkey, l_linenumber, CASE WHEN o.o_orderkey IS NULL THEN 'orphan' WHEN o.o_orderstatus = 'F' THEN 'absent' ELSE 'recoverable' END AS diagnosis FROM g LEFT JOIN orders o ON g.l_orderkey = o.o_orderkey""")
def gap_diagnosis(spark, sf):
    gaps = G.missing_numbers(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    d = D.verdict((F.col("o_orderstatus").isNull(), "orphan"), (F.col("o_orderstatus") == "F", "absent"), rest="recoverable")
    return gaps.join(o, "l_orderkey", "left").select("l_orderkey", "l_linenumber", d.alias("diagnosis"))


@query("""
    WITH t AS (SELECT DISTINCT text FROM documents JOIN labels USING (doc_id)), s AS (SELECT DISTINCT source, lang FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
    SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'labelled' WHEN text IN (SELECT text FROM t) THEN 'copy labelled' WHEN s.source IS NOT NULL THEN 'source known' ELSE 'absent' END AS verdict
    FROM documents d LEFT JOIN s ON d.source = s.source AND d.lang = s.lang""")
def coverage_verdict(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "lang", F.sha2("text", 256).alias("h"))
    labels = table(spark, sf, "labels").select("doc_id", "toxic").withColumn("own", F.lit(True))
    known = d.join(labels, "doc_id")
    twins, sources = known.select("h").distinct().withColumn("twin", F.lit(True)), known.where("toxic = 1").select("source", "lang").distinct().withColumn("known", F.lit(True))
    joined = d.join(labels, "doc_id", "left").join(twins, "h", "left").join(sources, ["source", "lang"], "left")
    return joined.select("doc_id", D.verdict((F.col("own"), "labelled"), (F.col("twin"), "copy labelled"), (F.col("known"), "source known"), rest="absent").alias("verdict"))


@query("""
    SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1995 + o_orderkey % 7 THEN 'agree' WHEN abs(year(o_orderdate) - (1995 + o_orderkey % 7)) = 1 AND month(o_orderdate) IN (1, 12) THEN 'border' ELSE 'printed date' END AS rule FROM orders""")
def source_disagreement(spark, sf):
    folder, printed = F.lit(1995) + F.col("o_orderkey") % 7, F.year("o_orderdate")
    rule = D.verdict((printed == folder, "agree"), ((F.abs(printed - folder) == 1) & F.month("o_orderdate").isin(1, 12), "border"), rest="printed date")
    return table(spark, sf, "orders").select("o_orderkey", rule.alias("rule"))


@query("""
    SELECT event_id, event_type IN ('purchase', 'signup') AS in_force, CASE event_type WHEN 'purchase' THEN 'norm' WHEN 'signup' THEN 'norm' ELSE 'note' END AS class,
      CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 ELSE 9 END AS priority FROM events""")
def validity_by_type(spark, sf):
    force = F.struct(F.lit(True).alias("in_force"), F.lit("norm").alias("class"), F.when(F.col("event_type") == "purchase", 1).otherwise(2).alias("priority"))
    note = F.struct(F.lit(False).alias("in_force"), F.lit("note").alias("class"), F.lit(9).alias("priority"))
    g = F.when(F.col("event_type").isin("purchase", "signup"), force).otherwise(note)
    return table(spark, sf, "events").select("event_id", g.alias("g")).select("event_id", "g.*")


@query("""
    SELECT p_partkey, CASE WHEN length(trim(p_name)) >= 12 THEN p_name WHEN length(trim(p_type)) >= 12 THEN p_type WHEN length(trim(p_brand)) >= 12 THEN p_brand END AS text,
      CASE WHEN length(trim(p_name)) >= 12 THEN 'official' WHEN length(trim(p_type)) >= 12 THEN 'local' WHEN length(trim(p_brand)) >= 12 THEN 'manual' ELSE 'none' END AS reason FROM part""")
def text_repair(spark, sf):
    return table(spark, sf, "part").select("p_partkey", *D.repaired(("p_name", "official"), ("p_type", "local"), ("p_brand", "manual"), least=12))


@query(r"""
    SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '(?:License|BY-NC|Licence),? (?:[Vv]ersion )?[0-9]+(?:\.[0-9]+)*'))) AS citation FROM documents""")
def citation_list(spark, sf):
    found = F.regexp_extract_all("text", F.lit(r"((?:License|BY-NC|Licence),? (?:[Vv]ersion )?[0-9]+(?:\.[0-9]+)*)"), F.lit(1))
    return table(spark, sf, "documents").select("doc_id", F.explode(F.array_distinct(found)).alias("citation"))


@query(r"""
    WITH s AS (SELECT doc_id, str_split(regexp_replace(regexp_replace(text, '([A-Z][a-z]+)', chr(1) || 'A\1' || chr(1), 'g'), '([0-9]+)', chr(1) || 'M\1' || chr(1), 'g'), chr(1)) AS p FROM documents),
    x AS (SELECT doc_id, unnest(range(0, len(p))) AS pos, unnest(p) AS part FROM s),
    y AS (SELECT doc_id, pos, part, last_value(CASE WHEN part[1:1] = 'A' THEN part[2:] END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS anchor FROM x WHERE pos % 2 = 1)
    SELECT doc_id, CAST(pos AS INTEGER) AS at, part[2:] AS mention, anchor FROM y WHERE part[1:1] = 'M'""".replace("AS at,", "AS \"at\","))
def paired_mentions(spark, sf):
    # the window sees odd pieces only, as even ones are the text between marks
    return D.nearest_before(table(spark, sf, "documents"), "doc_id", "text", "[0-9]+", "[A-Z][a-z]+")


@query("""
    WITH o AS (SELECT lower(event_type) AS o, count(*) AS n FROM events GROUP BY 1) SELECT o AS option, n FROM o WHERE o NOT IN ('click', 'view')""")
def new_options(spark, sf):
    known = spark.createDataFrame([("click",), ("view",)], "option string")
    return table(spark, sf, "events").groupBy(F.lower("event_type").alias("option")).agg(F.count("*").alias("n")).join(known, "option", "left_anti")


@query(r"""
    SELECT page_id, CASE WHEN regexp_matches(url, '^https?://[^/]*\.(gov|edu)(/|$)') THEN 'official' WHEN regexp_matches(url, '/(news|blog)/') THEN 'news' WHEN regexp_matches(url, '\?') THEN 'search' ELSE 'other' END AS class FROM pages""")
def url_classes(spark, sf):
    rules = [(r"^https?://[^/]*\.(gov|edu)(/|$)", "official"), ("/(news|blog)/", "news"), (r"\?", "search")]
    return table(spark, sf, "pages").select("page_id", V.first_rule("url", rules, "other").alias("class"))


@query(r"""
    SELECT doc_id, array_to_string(list_filter(str_split(text, ' '), lambda w: length(w) BETWEEN 5 AND 9 AND regexp_matches(w, '^[A-Z][a-z]+$') AND NOT regexp_matches(w, '^(There|Their|The)')), ' ') AS names FROM documents""")
def entity_validity(spark, sf):
    ok = lambda w: F.length(w).between(5, 9) & w.rlike("^[A-Z][a-z]+$") & ~w.rlike("^(There|Their|The)")
    return table(spark, sf, "documents").select("doc_id", F.array_join(F.filter(F.split("text", " "), ok), " ").alias("names"))


@query("""
    WITH s AS (SELECT o_custkey, list(o_orderpriority ORDER BY o_orderdate, o_orderkey)[1:4] AS l FROM orders GROUP BY 1)
    SELECT o_custkey, l[1] AS item_1, CASE WHEN l[2] = l[1] THEN NULL ELSE l[2] END AS item_2, CASE WHEN l[3] IN (l[1], l[2]) THEN NULL ELSE l[3] END AS item_3, CASE WHEN l[4] IN (l[1], l[2], l[3]) THEN NULL ELSE l[4] END AS item_4 FROM s""")
def list_to_columns(spark, sf):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    first = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", nth.alias("nth")).where("nth <= 4")
    g = first.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("nth", F.col("o_orderpriority").alias("p")))).alias("r")).select("o_custkey", F.col("r.p").alias("l"))
    return g.select("o_custkey", *D.to_columns(F.col("l"), 4, "item"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) WHEN o_custkey % 2 = 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) ELSE NULL END AS date,
      CASE WHEN o_orderkey % 3 = 0 THEN 'exif' WHEN o_custkey % 2 = 0 THEN 'name' END AS source, CASE WHEN o_orderkey % 3 = 0 THEN 'day' WHEN o_custkey % 2 = 0 THEN 'month' END AS grain FROM orders""")
def date_cascade(spark, sf):
    day = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate").cast("date"))
    month = F.when(F.col("o_custkey") % 2 == 0, F.trunc("o_orderdate", "month"))
    d = D.first_dated((day, "exif", "day"), (month, "name", "month"), low="1990-01-01", high="2026-12-31")
    return table(spark, sf, "orders").select("o_orderkey", d.alias("d")).select("o_orderkey", "d.date", "d.source", "d.grain")


@query("""
    WITH w AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1 AS lo, CAST(o_orderdate AS DATE) + CAST(least(o_orderkey % 60, 45) AS INTEGER) AS hi FROM orders)
    SELECT o_orderkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM w""")
def date_window(spark, sf):
    day = F.col("o_orderdate").cast("date")
    span = F.sequence(F.date_sub(day, 1), F.date_add(day, F.least(F.col("o_orderkey") % 60, F.lit(45)).cast("int")))
    return table(spark, sf, "orders").select("o_orderkey", F.explode(span).alias("day"))


@query(r"""
    WITH u AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS u FROM pages)
    SELECT page_id, coalesce(list_filter(u, lambda x: regexp_matches(x, '^https'))[1], u[1]) AS first FROM u""")
def first_domain(spark, sf):
    u = F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)))
    ordered = D.by_priority(u, "^https")
    return table(spark, sf, "pages").select("page_id", F.get(ordered, F.lit(0)).alias("first"))


@query("""
    SELECT count(*) AS rows, count(o_custkey) - count(DISTINCT o_custkey) AS repeated, count(*) FILTER (NOT coalesce(year(o_orderdate) BETWEEN 1995 AND 2000, false)) AS year_range,
      count(*) FILTER (NOT coalesce(o_orderpriority <> '', false)) AS named FROM orders""")
def plan_sanity(spark, sf):
    rules = {"year_range": F.year("o_orderdate").between(1995, 2000), "named": F.col("o_orderpriority") != ""}
    return D.checked(table(spark, sf, "orders"), rules, "o_custkey")


@query("""
    SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'new' WHEN doc_id % 4 = 1 THEN 'size' WHEN doc_id % 4 = 2 THEN 'time' ELSE 'known' END AS why FROM documents""")
def incremental_hash_scan(spark, sf):
    """Files to hash anew: not in the cache, of another size, or modified two seconds or more apart."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars", (F.col("doc_id") * 10).alias("mtime"))
    k = F.col("doc_id") % 4
    cache = d.where(k != 0).select("doc_id", (F.col("n_chars") + F.when(k == 1, 1).otherwise(0)).alias("size"), (F.col("mtime") + F.when(k == 2, 2).otherwise(1)).alias("seen"))
    why = D.verdict((F.col("size").isNull(), "new"), (F.col("size") != F.col("n_chars"), "size"), (F.abs(F.col("mtime") - F.col("seen")) >= 2, "time"), rest="known")
    return d.join(cache, "doc_id", "left").select("doc_id", why.alias("why"))


@query("""
    SELECT d.doc_id, coalesce(l.quality, CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END) AS quality, l.quality IS NULL AS computed FROM documents d LEFT JOIN labels l USING (doc_id)""")
def checkpoint_resume(spark, sf):
    """Rows of an earlier run are restored; only the others are computed."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.select("doc_id", F.coalesce("quality", F.when(F.col("n_chars") > 1000, 1).otherwise(0)).alias("quality"), F.col("quality").isNull().alias("computed"))


@query("""
    WITH RECURSIVE k AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 50 = 1 THEN NULL WHEN p_partkey % 97 = 0 THEN -p_partkey WHEN p_partkey % 41 = 0 THEN p_partkey + 41 * (CASE WHEN p_partkey % 82 = 0 THEN -1 ELSE 1 END) ELSE p_partkey - 1 END AS p FROM part),
    t AS (SELECT k.k, k.p, o.k IS NOT NULL AS known FROM k LEFT JOIN k o ON k.p = o.k),
    r AS (SELECT k, k AS root, CAST(0 AS BIGINT) AS depth, CASE WHEN p IS NULL THEN 'root' ELSE 'orphan' END AS kind FROM t WHERE p IS NULL OR NOT known UNION ALL SELECT t.k, r.root, r.depth + 1, 'child' FROM t JOIN r ON t.p = r.k WHERE t.known)
    SELECT k AS p_partkey, root, depth, coalesce(kind, 'cycle') AS kind FROM k LEFT JOIN r USING (k)""")
def parent_trees(spark, sf):
    """Parts linked by parent keys in chains of fifty; some parents aren't there, and some parts are each other's parents."""
    from sieveline.operators.trees import rooted

    k = F.col("p_partkey")
    other = F.when(k % 82 == 0, k - 41).otherwise(k + 41)
    parent = F.when(k % 50 == 1, F.lit(None)).when(k % 97 == 0, -k).when(k % 41 == 0, other).otherwise(k - 1)
    return rooted(table(spark, sf, "part").select("p_partkey", parent.alias("parent")), "p_partkey", "parent")
