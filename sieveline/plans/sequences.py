"""Windows, frames, gaps and bins."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline.operators import groups as G
from sieveline.plans.registry import query, table


def turns(spark, sf):
    return table(spark, sf, "conversations")


@query("""
    WITH c AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN role END AS raw FROM conversations)
    SELECT conv_id, turn, raw, last_value(raw IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS role FROM c""")
def forward_fill_role(spark, sf):
    c = turns(spark, sf).select("conv_id", "turn", F.when(F.col("turn") % 3 == 0, F.col("role")).alias("raw"))
    return G.forward_fill(c, ["conv_id"], ["turn"], "raw", "role")


@query("SELECT conv_id, turn, string_agg(role, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS frame FROM conversations")
def context_frame_0_11(spark, sf):
    return G.context(turns(spark, sf), ["conv_id"], ["turn"], "role", 0, 11, "frame").select("conv_id", "turn", "frame")


@query("SELECT conv_id, turn, string_agg(role, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 5 FOLLOWING) AS frame FROM conversations")
def context_frame_m2_p5(spark, sf):
    return G.context(turns(spark, sf), ["conv_id"], ["turn"], "role", 2, 5, "frame").select("conv_id", "turn", "frame")


@query("""
    WITH s AS (SELECT l_orderkey, unnest(range(1, max(l_linenumber) + 1)) AS l_linenumber FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber FROM s ANTI JOIN lineitem USING (l_orderkey, l_linenumber)""")
def missing_line_numbers(spark, sf):
    return G.missing_numbers(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("""
    WITH p AS (SELECT *, lag(p_retailprice) OVER w AS prev FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey))
    SELECT p_partkey, p_brand, CAST(sum(CASE WHEN prev IS NOT NULL AND abs(p_retailprice - prev) / prev > 0.01 THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM p""")
def islands_by_tolerance(spark, sf):
    w = Window.partitionBy("p_brand").orderBy("p_retailprice", "p_partkey")
    p = table(spark, sf, "part").withColumn("prev", F.lag("p_retailprice").over(w))
    breaks = F.coalesce(F.abs(F.col("p_retailprice") - F.col("prev")) / F.col("prev") > 0.01, F.lit(False))
    return G.islands(p, ["p_brand"], ["p_retailprice", "p_partkey"], breaks).select("p_partkey", "p_brand", "island")


@query("""
    WITH m AS (SELECT conv_id, turn, text, length(text) < 60 AS short FROM conversations),
    s AS (SELECT *, CASE WHEN coalesce(lag(short) OVER (PARTITION BY conv_id ORDER BY turn), false) THEN 0 ELSE 1 END AS starts FROM m),
    i AS (SELECT *, sum(starts) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS island FROM s)
    SELECT conv_id, min(turn) AS first, count(*) AS parts, string_agg(text, ' ' ORDER BY turn) AS text FROM i GROUP BY conv_id, island""")
def lead_merge(spark, sf):
    return G.merge_runs(turns(spark, sf), ["conv_id"], "turn", F.length("text") < 60, "text")


@query()
def greedy_bins(spark, sf):
    d = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return G.greedy_bins(d, ["source"], ["doc_id"], "n_chars", 50_000, before=False)


@query()
def greedy_bins_capped(spark, sf):
    d = table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return G.greedy_bins(d, ["source"], ["doc_id"], "n_chars", 50_000, before=True)


@query("""
    SELECT o_orderkey, CASE WHEN count(*) OVER (PARTITION BY o_orderpriority) > 1.4 * 2000 THEN o_orderpriority || '-' || year(o_orderdate) ELSE o_orderpriority END AS shelf FROM orders""")
def adaptive_subdivision(spark, sf):
    return G.subdivided(table(spark, sf, "orders"), "o_orderpriority", F.year("o_orderdate").cast("string"), 2000).select("o_orderkey", "shelf")


@query("""
    WITH b AS (SELECT doc_id, source, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 40 AS b FROM documents)
    SELECT doc_id, source, CASE WHEN b >= 702 THEN chr(CAST(97 + (b - 702) // 676 % 26 AS INTEGER)) ELSE '' END || CASE WHEN b >= 26 THEN chr(CAST(97 + (b - 26) // 26 % 26 AS INTEGER)) ELSE '' END || chr(CAST(97 + b % 26 AS INTEGER)) AS block FROM b""")
def block_labels(spark, sf):
    nth = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    return table(spark, sf, "documents").select("doc_id", "source", G.letters(F.floor(nth / 40)).alias("block"))


@query("""
    SELECT doc_id, source || CASE WHEN n > 1 THEN ' (' || n || ')' ELSE '' END AS name FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY lower(source) ORDER BY doc_id) AS n FROM documents)""")
def collision_suffix(spark, sf):
    n = F.row_number().over(Window.partitionBy(F.lower("source")).orderBy("doc_id"))
    return table(spark, sf, "documents").withColumn("n", n).select("doc_id", F.when(F.col("n") > 1, F.concat("source", F.lit(" ("), "n", F.lit(")"))).otherwise(F.col("source")).alias("name"))


@query("""
    WITH l AS (SELECT doc_id, unnest(range(1, len(str_split(text, chr(10))) + 1)) AS line_no, unnest(str_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, line_no, 1 + count(*) FILTER (regexp_matches(line, '\\|')) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS page FROM l""")
def running_page_number(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    w = Window.partitionBy("doc_id").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    page = F.coalesce(F.sum(F.col("line").contains("|").cast("long")).over(w), F.lit(0)) + 1
    return lines.select("doc_id", (F.col("k") + 1).cast("long").alias("line_no"), page.alias("page"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) AS nth FROM orders")
def reverse_order(spark, sf):
    return G.numbered(table(spark, sf, "orders").select("o_orderkey"), [F.desc("o_orderkey")], "nth")


@query("""
    WITH t AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN 'S' WHEN 'user' THEN 'U' END AS h FROM conversations)
    SELECT conv_id, turn, last_value(h IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section,
      CAST(count(CASE WHEN h = 'U' THEN 1 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS paragraph FROM t""")
def heading_state(spark, sf):
    h = F.when(F.col("role") == "system", "S").when(F.col("role") == "user", "U")
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return turns(spark, sf).withColumn("h", h).select("conv_id", "turn", F.last("h", ignorenulls=True).over(w).alias("section"), F.count(F.when(F.col("h") == "U", 1)).over(w).alias("paragraph"))


@query("""
    WITH RECURSIVE c AS (SELECT conv_id, turn, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
    r AS (SELECT conv_id, turn, k, 0 AS bin, 1 AS rows, n AS total FROM c WHERE k = 1 UNION ALL
      SELECT c.conv_id, c.turn, c.k, CASE WHEN r.rows >= 3 OR r.total + c.n > 400 THEN r.bin + 1 ELSE r.bin END, CASE WHEN r.rows >= 3 OR r.total + c.n > 400 THEN 1 ELSE r.rows + 1 END, CASE WHEN r.rows >= 3 OR r.total + c.n > 400 THEN c.n ELSE r.total + c.n END
      FROM r JOIN c ON c.conv_id = r.conv_id AND c.k = r.k + 1)
    SELECT conv_id, turn, CAST(bin AS INTEGER) AS bin FROM r""")
def turns_by_count_and_size(spark, sf):
    """Turns of a conversation into requests of at most three turns and 400 characters."""
    return G.folded_bins(turns(spark, sf).withColumn("size", F.length("text")), ["conv_id"], "turn", "size", 3, 400)
