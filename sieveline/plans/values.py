"""Dates, numbers, lists, JSON and scores."""

from pyspark.sql import functions as F

from sieveline.functions import text as T
from sieveline.functions import values as V
from sieveline.plans.registry import query, table


@query("SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS week, CAST(date_trunc('week', ts) AS DATE) + 6 AS week_end FROM events")
def week_bucket(spark, sf):
    return table(spark, sf, "events").select("event_id", V.week_start("ts").alias("week"), V.week_end("ts").alias("week_end"))


@query("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') ELSE 'n/a' END AS raw,
      CASE o_orderkey % 4 WHEN 3 THEN NULL WHEN 2 THEN CASE WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) ELSE CAST(o_orderdate AS DATE) END ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders""")
def mixed_date_parse(spark, sf):
    k = F.pmod(F.col("o_orderkey"), F.lit(4))
    raw = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).when(k == 2, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise("n/a")
    return table(spark, sf, "orders").select("o_orderkey", raw.alias("raw")).withColumn("parsed", V.any_date("raw"))


@query("SELECT o_orderkey, month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) AS mdy, strftime(o_orderdate, '%d/%m/%Y') AS dmy FROM orders")
def date_formats(spark, sf):
    o = table(spark, sf, "orders").withColumn("iso", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", V.month_first("iso").alias("mdy"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("dmy"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed FROM orders")
def written_date_parse(spark, sf):
    months = F.array(*[F.lit(m) for m in V.MONTHS_PT])
    o = table(spark, sf, "orders")
    text = F.concat(F.lit("Em "), F.day("o_orderdate"), F.lit(" de "), F.element_at(months, F.month("o_orderdate")), F.lit(" de "), F.year("o_orderdate"))
    return o.select("o_orderkey", text.alias("t")).select("o_orderkey", V.written_date("t").alias("parsed"))


@query("SELECT p_partkey, CASE WHEN p_retailprice >= 1500 THEN 'critical' WHEN p_retailprice >= 1200 THEN 'high' WHEN p_retailprice >= 1000 THEN 'medium' ELSE 'low' END AS band, greatest(least(p_size, 40), 10) AS size FROM part")
def band_and_clamp(spark, sf):
    bands = V.band("p_retailprice", [(1500, "critical"), (1200, "high"), (1000, "medium")], "low")
    return table(spark, sf, "part").select("p_partkey", bands.alias("band"), V.clamp("p_size", 10, 40).alias("size"))


@query("""
    WITH d AS (SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || lpad(CAST(o_custkey % 100 AS VARCHAR), 2, '0') || year(o_orderdate) || '6' || '01' || '0123' AS d FROM orders)
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN d[1:9] ELSE d[1:7] || '-' || d[8:9] || '.' || d[10:13] || '.' || d[14:14] || '.' || d[15:16] || '.' || d[17:20] END AS number FROM d""")
def format_case_number(spark, sf):
    raw = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 7, "0"), F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0"), F.year("o_orderdate").cast("string"), F.lit("6010123"))
    raw = F.when(F.col("o_orderkey") % 5 == 0, F.substring(raw, 1, 9)).otherwise(raw)
    return table(spark, sf, "orders").select("o_orderkey", V.case_number(raw).alias("number"))


@query(r"SELECT p_partkey, regexp_replace(p_name, '[^0-9]', '', 'g') AS found, CASE WHEN regexp_replace(p_name, '[^0-9]', '', 'g') = '' THEN trim(p_name) ELSE regexp_replace(p_name, '[^0-9]', '', 'g') END AS digits FROM part")
def digits_only(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.regexp_replace("p_name", "[^0-9]", "").alias("found"), V.digits("p_name").alias("digits"))


@query("SELECT o_orderkey, replace(format('{:,}', o_orderkey), ',', '.') AS number FROM orders")
def law_number_thousands(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", V.thousands("o_orderkey").alias("number"))


@query(r"""
    SELECT page_id, TRY_CAST(regexp_extract(html, '\b((?:19|20)[0-9]{2})\b', 1) AS INTEGER) AS year FROM pages""")
def year_extraction(spark, sf):
    return table(spark, sf, "pages").select("page_id", V.year_in("html", 1900, 2099).alias("year"))


@query("""
    WITH x AS (SELECT s_suppkey, s_name, s_nationkey FROM supplier), n AS (SELECT n_nationkey, n_name FROM nation)
    SELECT s_suppkey, s_name || '/' || n_name AS label FROM x JOIN n ON s_nationkey = n_nationkey""")
def label_composition(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select("s_suppkey", V.label("s_name", F.lit(" "), "n_name").alias("label"))


@query("""
    SELECT doc_id, lang || ', ' || source AS items FROM documents""")
def multiselect_dedup(spark, sf):
    raw = F.concat("lang", F.lit(", "), "source", F.lit(" ; "), F.upper("lang"), F.lit("|"), "lang", F.lit(",,"), F.upper("source"))
    return table(spark, sf, "documents").select("doc_id", F.array_join(V.listed(raw, "[,;|]"), ", ").alias("items"))


@query("SELECT doc_id, lang || ', ' || source || ', extra' AS items FROM documents")
def multiselect_merge(spark, sf):
    lists = V.merged(F.array("lang", "source"), F.array(F.upper("source"), F.lit("extra")), F.array(F.lit("EXTRA")))
    return table(spark, sf, "documents").select("doc_id", F.array_join(lists, ", ").alias("items"))


@query(r"""
    SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, array_to_string(list_filter(str_split(regexp_extract(url, '^[a-z]+://[^/]+(/[^?#]*)', 1), '/'), lambda x: x <> ''), ' > ') AS path FROM pages""")
def url_parts(spark, sf):
    p = table(spark, sf, "pages")
    path = F.filter(F.split(F.coalesce(F.try_parse_url("url", F.lit("PATH")), F.lit("")), "/"), lambda x: x != "")
    return p.select("page_id", F.try_parse_url("url", F.lit("HOST")).alias("host"), F.array_join(path, " > ").alias("path"))


@query(r"""
    WITH u AS (SELECT page_id, regexp_extract_all(html, '(https?://[^\s"''<>]+)', 1) AS u FROM pages)
    SELECT page_id, unnest(list_distinct(list_transform(u, lambda x: regexp_replace(x, '[.,;:)]+$', '')))) AS url FROM u""")
def extract_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.explode(V.urls("html")).alias("url"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, props IS NOT NULL AS present FROM events")
def json_prop_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"), F.col("props").isNotNull().alias("present"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_in_noisy_text(spark, sf):
    noisy = F.concat(F.lit("Answer: "), F.col("props"), F.lit(" (end)"))
    return table(spark, sf, "events").select("event_id", V.json_in(noisy, "k int")["k"].alias("k"))


@query("""SELECT n_nationkey, sha256('{"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}') AS hash FROM nation""")
def content_hashes(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", V.content_hash("n_regionkey", "n_name").alias("hash"))


@query("""
    SELECT p_partkey, CASE WHEN p_name = upper(p_name) AND length(p_name) <= 3 THEN p_name ELSE list_aggregate(list_transform(str_split(lower(trim(p_name)), ' '), lambda x: upper(x[1:1]) || x[2:]), 'string_agg', ' ') END AS title FROM part""")
def title_case(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.title_case(F.lower("p_name")).alias("title"))


@query("SELECT vec_id, bit_count(xor(vec_id, vec_id * 7)) AS distance FROM embeddings")
def hamming_distance(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", V.hamming("vec_id", F.col("vec_id") * 7).alias("distance"))


@query(r"""
    WITH p AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS hrefs, len(regexp_extract_all(html, '<h[1-6][ >]')) AS headings, len(regexp_extract_all(html, '<p[ >]')) AS paragraphs FROM pages)
    SELECT page_id, len(hrefs) AS links, len(list_distinct(hrefs)) AS targets, headings, paragraphs FROM p""")
def html_link_scan(spark, sf):
    count = lambda p: F.regexp_count("html", F.lit(p)).cast("long")
    hrefs = F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), F.lit(1))
    p = table(spark, sf, "pages")
    return p.select("page_id", F.size(hrefs).cast("long").alias("links"), F.size(F.array_distinct(hrefs)).cast("long").alias("targets"), count("<h[1-6][ >]").alias("headings"), count("<p[ >]").alias("paragraphs"))
