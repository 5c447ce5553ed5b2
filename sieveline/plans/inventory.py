"""Inventories: counts, sums, roll-ups and integrity."""

from pyspark.sql import functions as F

from sieveline.functions import values as V
from sieveline.operators import groups as G
from sieveline.plans.registry import query, table

#: Ids of several rows that are broadcast, at most.
FEW_IDS = 200_000


def money(c):
    return F.col(c).cast("decimal(18,2)")


@query("SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ALL")
def inventory_by_lang_source(spark, sf):
    return table(spark, sf, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT year(o_orderdate) AS year, o_orderstatus AS status, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY ALL")
def inventory_by_year(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.year("o_orderdate").cast("long").alias("year"), F.col("o_orderstatus").alias("status"))
    return o.agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).cast("double").alias("total"))


@query(r"""
    WITH p AS (SELECT list_filter(str_split(regexp_replace(url, '^[a-z]+://', ''), '/'), lambda x: x <> '') AS parts, strlen(html) AS size FROM pages),
    x AS (SELECT array_to_string(parts[1:k], '/') AS prefix, size FROM (SELECT parts, size, unnest(range(1, len(parts) + 1)) AS k FROM p))
    SELECT prefix, count(*) AS n, CAST(sum(size) AS BIGINT) AS total FROM x GROUP BY prefix""")
def path_prefix_rollup(spark, sf):
    p = table(spark, sf, "pages").withColumn("path", F.regexp_replace("url", "^[a-z]+://", ""))
    return G.prefix_rollup(p, V.prefixes("path"), F.octet_length("html").cast("long"))


@query("""
    SELECT count(*) AS groups, CAST(sum(n - 1) AS BIGINT) AS excess FROM (SELECT text, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1)""")
def duplicate_excess(spark, sf):
    g = table(spark, sf, "documents").groupBy(F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("s")).agg(F.count("*").alias("n")).where("n > 1")
    return g.agg(F.count("*").alias("groups"), F.sum(F.col("n") - 1).alias("excess"))


@query("""
    SELECT count(*) AS rows, count(*) FILTER (text IS NULL OR trim(text) = '') AS empty, count(DISTINCT doc_id) AS ids, count(*) - count(DISTINCT doc_id) AS repeated_ids,
      count(*) FILTER (length(text) <> n_chars) AS wrong_length, count(*) FILTER (lang NOT IN ('en', 'fr', 'de', 'es')) AS other_lang,
      (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS orphan_labels, max(n_chars) AS longest, min(n_chars) AS shortest,
      count(*) FILTER (source IS NULL OR trim(source) = '') AS no_source, count(*) FILTER (n_chars < 100) AS short, count(*) FILTER (contains(text, chr(65533))) AS undecoded,
      count(*) FILTER (regexp_matches(text, '[ \t]$')) AS open_ended, count(DISTINCT lang || '/' || source) AS kinds FROM documents""")
def integrity_profile(spark, sf):
    d, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    orphans = labels.join(d.select("doc_id"), "doc_id", "left_anti").agg(F.count("*").alias("orphan_labels"))
    one = d.agg(
        F.count("*").alias("rows"),
        F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("empty"),
        F.count_distinct("doc_id").alias("ids"),
        (F.count("*") - F.count_distinct("doc_id")).alias("repeated_ids"),
        F.count_if(F.length("text") != F.col("n_chars")).alias("wrong_length"),
        F.count_if(~F.col("lang").isin("en", "fr", "de", "es")).alias("other_lang"),
        F.max("n_chars").alias("longest"),
        F.min("n_chars").alias("shortest"),
        F.count_if(F.coalesce(F.trim("source"), F.lit("")) == "").alias("no_source"),
        F.count_if(F.col("n_chars") < 100).alias("short"),
        F.count_if(F.col("text").contains("\ufffd")).alias("undecoded"),
        F.count_if(F.col("text").rlike(r"[ \t]\z")).alias("open_ended"),
        F.count_distinct(F.concat("lang", F.lit("/"), "source")).alias("kinds"),
    )
    return one.withColumn("k", F.lit(1)).join(orphans.withColumn("k", F.lit(1)), "k").drop("k")  # one row each


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 5")
def top_classes(spark, sf):
    return G.most_common(table(spark, sf, "documents"), ["source"], 5)


@query("""
    SELECT source, lang, n FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS rn FROM
      (SELECT source, lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY ALL HAVING count(*) >= 2)) WHERE rn = 1""")
def mode_per_group(spark, sf):
    return G.mode(table(spark, sf, "documents"), ["source"], "lang", 2)


@query("""
    SELECT o_orderpriority AS priority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS closed, count(*) FILTER (o_totalprice > 200000) AS large,
      count(*) FILTER (c.c_custkey IS NULL) AS unknown_customer FROM orders LEFT JOIN customer c ON o_custkey = c_custkey GROUP BY ALL""")
def conditional_counts(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return o.groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("closed"),
        F.count_if(F.col("o_totalprice") > 200000).alias("large"),
        F.count_if(F.col("c_custkey").isNull()).alias("unknown_customer"),
    )


@query("""
    SELECT source, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'fr') AS fr, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'es') AS es FROM documents GROUP BY source""")
def two_level_pivot(spark, sf):
    counts = table(spark, sf, "documents").groupBy("source").pivot("lang", ["en", "fr", "de", "es"]).count()
    return counts.na.fill(0)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag) + 2 * grouping(l_linestatus) AS level FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def class_cube(spark, sf):
    c = table(spark, sf, "lineitem").cube("l_returnflag", "l_linestatus")
    return c.agg(F.count("*").alias("n"), (F.grouping("l_returnflag") + 2 * F.grouping("l_linestatus")).cast("long").alias("level"))


@query("SELECT l_orderkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY l_orderkey HAVING count(*) > 6")
def groups_having(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("quantity"))
    return g.where("n > 6")


@query("SELECT event_type, min(ts) AS first, max(ts) AS last, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def period_by_type(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count_distinct("user_id").alias("users"))


@query("""
    SELECT n_regionkey AS region, string_agg(n_name, ', ' ORDER BY n_name) AS nations, count(*) AS n FROM nation GROUP BY n_regionkey""")
def set_aggregate(spark, sf):
    g = table(spark, sf, "nation").groupBy(F.col("n_regionkey").alias("region"))
    return g.agg(F.array_join(F.sort_array(F.collect_set("n_name")), ", ").alias("nations"), F.count("*").alias("n"))


@query("""
    WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ', ' ORDER BY rn) FILTER (rn <= 6) || CASE WHEN n > 6 THEN ', …' ELSE '' END AS refs FROM r GROUP BY o_custkey, n""")
def ordered_list(spark, sf):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    first = table(spark, sf, "orders").select("o_custkey", "o_orderkey", nth.alias("nth")).where("nth <= 7")
    g = first.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("nth", F.col("o_orderkey").cast("string").alias("k")))).alias("r"))
    return g.select("o_custkey", F.concat(F.array_join(F.slice("r.k", 1, 6), ", "), F.when(F.size("r") > 6, ", …").otherwise("")).alias("refs"))


@query("SELECT p_brand, p_name, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_name DESC, p_partkey) AS rn FROM part) WHERE rn = 1")
def longest_per_group(spark, sf):
    p = table(spark, sf, "part")
    return G.first_of(p, ["p_brand"], [F.desc(F.length("p_name")), F.desc("p_name"), "p_partkey"]).select("p_brand", "p_name", "p_partkey")


@query("""
    WITH o AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, l_partkey FROM lineitem),
    u AS (SELECT l_suppkey AS k, d, count(*) AS n FROM o GROUP BY ALL)
    SELECT k AS supplier, d AS day, n FROM u WHERE n >= 3""")
def co_occurrence(spark, sf):
    return table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("supplier"), F.col("l_shipdate").cast("date").alias("day")).agg(F.count("*").alias("n")).where("n >= 3")


@query("""
    SELECT (SELECT count(*) FROM (SELECT text FROM documents EXCEPT ALL SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))) AS only_all,
      (SELECT count(*) FROM (SELECT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) EXCEPT ALL SELECT text FROM documents)) AS only_labelled""")
def bag_equality(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    part = d.join(table(spark, sf, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    count = lambda a, b, n: a.select("h").exceptAll(b.select("h")).agg(F.count("*").alias(n)).withColumn("k", F.lit(1))
    return count(d, part, "only_all").join(count(part, d, "only_labelled"), "k").drop("k")


@query(r"""
    WITH t AS (SELECT DISTINCT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: length(x) > 3)) AS term FROM documents),
    n AS (SELECT count(*) AS n FROM documents), c AS (SELECT term, count(*) AS df FROM t GROUP BY term)
    SELECT term, df FROM c, n WHERE df <= 0.45 * n AND df >= 20""")
def df_filter_terms(spark, sf):
    terms = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: F.length(x) > 3)
    return G.document_frequency(table(spark, sf, "documents"), terms, 0.45).where("df >= 20")


@query(r"""
    WITH t AS (SELECT doc_id, lang, list_filter(regexp_split_to_array(lower(text), '[^a-z]+'), lambda x: length(x) > 3 AND x NOT IN ('that', 'with', 'from', 'this', 'have')) AS ws FROM documents),
    w AS (SELECT doc_id, unnest(ws) AS term, 1 AS weight FROM t
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])), 2 FROM t
      UNION ALL SELECT doc_id, lang, 3 FROM t),
    s AS (SELECT doc_id, term, CAST(sum(weight) AS BIGINT) AS score FROM w GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rn FROM s)
    SELECT doc_id, term, score, rn FROM r WHERE rn <= 8""")
def keyword_scores(spark, sf):
    """A document whose id stands once is scored where it is read. Documents that share an id are scored together, as rows of terms."""
    from pyspark.sql import Window

    d, stop = table(spark, sf, "documents").select("doc_id", "text", "lang"), ("that", "with", "from", "this", "have")
    again = d.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    again = F.broadcast(again) if again.limit(FEW_IDS + 1).count() <= FEW_IDS else again
    once = d.join(again, "doc_id", "left_anti").where("doc_id is not null")
    alone = G.scored_terms(once, "doc_id", F.lower("text"), "[a-z]{4,}", stop, "lang", 3, 8)
    shared = d.join(again, "doc_id", "left_semi").unionByName(d.where("doc_id is null"))
    words = F.filter(F.split(F.lower("text"), "[^a-z]+"), lambda x: (F.length(x) > 3) & ~x.isin(*stop))
    listed = shared.select("doc_id", F.explode(F.array(words)).alias("ws"))
    pairs = F.when(F.size("ws") > 1, F.transform(F.slice("ws", 1, F.size("ws") - 1), lambda w, i: F.concat(w, F.lit(" "), F.get("ws", i + 1))))
    weigh = lambda items, weight: F.transform(items, lambda t: F.struct(t.alias("term"), F.lit(weight).alias("weight")))
    both = F.concat(weigh(F.col("ws"), 1), F.coalesce(weigh(pairs, 2), F.array().cast("array<struct<term:string,weight:int>>")))
    body = listed.select("doc_id", F.explode(both).alias("t")).select("doc_id", "t.*")
    scored = body.unionByName(shared.select("doc_id", F.col("lang").alias("term"), F.lit(3).alias("weight"))).groupBy("doc_id", "term").agg(F.sum("weight").alias("score"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), F.asc_nulls_last("term"))
    return alone.unionByName(scored.withColumn("rn", F.row_number().over(w).cast("long")).where("rn <= 8"))


@query("""
    SELECT count(*) AS rows, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic, round(count(*) FILTER (quality = 1) / count(*), 6) AS good_share FROM labels""")
def batch_stats(spark, sf):
    return table(spark, sf, "labels").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("quality") == 1).alias("good"),
        F.count_if(F.col("toxic") == 1).alias("toxic"),
        F.round(F.count_if(F.col("quality") == 1) / F.count("*"), 6).alias("good_share"),
    )


@query("SELECT CAST(date_trunc('week', ts) AS DATE) AS period, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total, true AS close FROM events GROUP BY 1")
def period_sketches(spark, sf):
    """Four files' inventories are stored, one of them with rows missing; it comes again, and only its own rows are written. Sums are exact, numbers of users within 8 % (five standard errors)."""
    from sieveline.operators import sketches as K
    from sieveline.operators.stored import StoredTable
    from sieveline.streaming import root_of

    e = table(spark, sf, "events").withColumn("file", F.pmod(F.xxhash64("event_id"), F.lit(4)))
    week = F.date_trunc("week", "ts").cast("date")
    made = lambda rows: K.inventory(rows, F.col("file"), week, "user_id", "event_id")
    stored = StoredTable(spark, root_of(spark, "inventory"), "id string, file bigint, period date, n bigint, total bigint, seen binary", "id", part_of=F.split("id", r"\|")[0].cast("long"))
    stored.merge(made(e.where("file <> 2 or event_id % 3 = 0")))
    stored.merge(made(e.where("file = 2")))
    users = e.groupBy(week.alias("period")).agg(F.count_distinct("user_id").alias("users"))
    close = (F.abs(F.col("different") - F.col("users")) <= 0.08 * F.col("users")).alias("close")
    return K.periods(stored.read()).join(users, "period").select("period", "n", "total", close)
