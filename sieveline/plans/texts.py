"""Text passes over documents, pages and conversations."""

from pyspark.sql import functions as F

from sieveline.functions import text as T
from sieveline.functions import values as V
from sieveline.plans.registry import query, table


def docs(spark, sf):
    return table(spark, sf, "documents")


@query("SELECT doc_id, md5(regexp_replace(strip_accents(lower(text)), '[^0-9a-z]', '', 'g')) AS form FROM documents")
def normal_form_aggressive(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.aggressive_form("text")).alias("form"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(strip_accents(lower(text)), '\s+', ' ', 'g'))) AS form FROM documents")
def normal_form_match_key(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.match_key("text")).alias("form"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS squeezed FROM documents")
def whitespace_clean(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.squeeze("text")).alias("squeezed"))


@query(r"""
    WITH v AS (SELECT doc_id, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\x00-\x1F\x7F]', ' ', 'g'), '\s+', ' ', 'g')) AS v FROM documents)
    SELECT doc_id, v[1:200] AS value, length(v) > 200 AS cut FROM v""")
def cell_clean(spark, sf):
    return docs(spark, sf).select("doc_id", T.clean_cell("text", 200).alias("c")).select("doc_id", "c.*")


@query(r"SELECT s_suppkey, lower(s_name) AS name, regexp_replace(regexp_replace(strip_accents(lower(s_name)), '[^0-9a-z]+', '-', 'g'), '^-+|-+$', '', 'g')[1:96] AS slug FROM supplier")
def slugs(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", F.lower("s_name").alias("name"), T.slug("s_name").alias("slug"))


@query(r"""
    SELECT doc_id, length(text) AS chars, len(regexp_extract_all(text, '[0-9]')) AS digits, len(regexp_extract_all(text, '[|\\$^{}<>]')) AS residue,
      len(regexp_extract_all(text, '\n')) AS line_ends, len(regexp_extract_all(text, '  +')) AS double_spaces FROM documents""")
def noise_metrics(spark, sf):
    return docs(spark, sf).select("doc_id", *T.noise_counts("text"))


@query(r"""
    SELECT conv_id, turn, regexp_replace(text || '-' || chr(10) || lower(text), '([\p{L}\p{N}_])-\n([\p{Ll}])', '\1\2', 'g') AS text FROM conversations""")
def dehyphenate(spark, sf):
    c = table(spark, sf, "conversations")
    return c.select("conv_id", "turn", T.dehyphenate(F.concat("text", F.lit("-\n"), F.lower("text"))).alias("text"))


@query("SELECT doc_id, CAST(greatest(1, ceil(length(text) / 4)) AS BIGINT) AS tokens FROM documents")
def token_estimate(spark, sf):
    return docs(spark, sf).select("doc_id", T.token_estimate("text").alias("tokens"))


@query(r"""
    SELECT doc_id, CASE WHEN regexp_matches(text, '[Ll]icen[sc]e') THEN 'license' WHEN regexp_matches(text, '[A-Za-z0-9]@[A-Za-z0-9]') THEN 'contact'
      WHEN regexp_matches(text, '\|') THEN 'table' WHEN regexp_matches(text, '[0-9]{3}') THEN 'numbers' ELSE 'prose' END AS kind FROM documents""")
def first_rule_classify(spark, sf):
    rules = [("[Ll]icen[sc]e", "license"), ("[A-Za-z0-9]@[A-Za-z0-9]", "contact"), (r"\|", "table"), ("[0-9]{3}", "numbers")]
    return docs(spark, sf).select("doc_id", V.first_rule("text", rules, "prose").alias("kind"))


@query(r"""
    WITH v AS (SELECT doc_id, coalesce(trim(text), '') AS v FROM documents)
    SELECT doc_id, CASE WHEN length(v) < 20 THEN 'critical' WHEN regexp_matches(v, 'Ã[\x{80}-\x{BF}]|\x{FFFD}') THEN 'critical' WHEN regexp_matches(v, '(\.\.\.|,| (and|of|the|de|und))$') THEN 'check' ELSE 'ok' END AS alert FROM v""")
def quality_alerts(spark, sf):
    return docs(spark, sf).select("doc_id", T.quality_alert("text").alias("alert"))


@query(r"""
    WITH v AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS v FROM documents)
    SELECT doc_id, CASE WHEN length(v) <= 80 THEN v ELSE regexp_replace(regexp_replace(v[1:78], '\s*\S*$', ''), '[,;:\s]+$', '') || '...' END AS head FROM v""")
def smart_truncation(spark, sf):
    return docs(spark, sf).select("doc_id", T.truncated("text", 80).alias("head"))


@query(r"SELECT conv_id, turn, regexp_matches(lower(trim(text)), '(\b(and|or|of|the|to|in|with|de|la|und|der)|[,;:-])$') AS unfinished FROM conversations")
def incompleteness(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", T.looks_unfinished("text").alias("unfinished"))


@query(r"""
    WITH v AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS v FROM documents)
    SELECT doc_id, v || ' ' || v AS doubled, v AS single FROM v WHERE length(v) > 2""")
def collapse_doubled(spark, sf):
    d = docs(spark, sf).withColumn("v", T.squeeze("text")).where(F.length("v") > 2)
    d = d.withColumn("doubled", F.concat("v", F.lit(" "), "v"))
    return d.select("doc_id", "doubled", T.collapse_doubled("doubled").alias("single"))


@query("SELECT doc_id, unnest(range(0, CAST(ceil(length(text) / 2000) AS BIGINT))) AS nth, text[unnest(range(0, CAST(ceil(length(text) / 2000) AS BIGINT))) * 2000 + 1 : unnest(range(0, CAST(ceil(length(text) / 2000) AS BIGINT))) * 2000 + 2000] AS piece FROM documents")
def fixed_pieces(spark, sf):
    d = docs(spark, sf).select("doc_id", F.posexplode(T.pieces("text", 2000)).alias("nth", "piece"))
    return d.select("doc_id", F.col("nth").cast("long").alias("nth"), "piece")


@query(r"""
    WITH v AS (SELECT conv_id, turn, regexp_extract(trim(regexp_replace(text, '\s+', ' ', 'g')), '^(.*?[.!?])(\s|$)', 1) AS v FROM conversations)
    SELECT conv_id, turn, CASE WHEN length(v) <= 60 THEN v ELSE regexp_replace(regexp_replace(v[1:58], '\s*\S*$', ''), '[,;:\s]+$', '') || '...' END AS summary FROM v""")
def summaries(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", T.short_summary("text", 60).alias("summary"))


@query(r"""
    WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda x: x <> '') AS w FROM documents)
    SELECT doc_id, CASE WHEN len(w) < 120 OR len(list_filter(w, lambda x: x IN ('the', 'of', 'and', 'to', 'de', 'la', 'der', 'und'))) / greatest(len(w), 1) < 0.14 THEN 'hard' ELSE 'easy' END AS difficulty FROM w""")
def difficulty(spark, sf):
    return docs(spark, sf).select("doc_id", T.difficulty("text", ("the", "of", "and", "to", "de", "la", "der", "und")).alias("difficulty"))


@query(r"""
    WITH l AS (SELECT page_id, unnest(range(1, len(str_split(html, chr(10))) + 1)) AS line_no, unnest(str_split(html, chr(10))) AS line FROM pages)
    SELECT page_id, line_no, trim(line) AS line FROM l WHERE regexp_matches(line, '[\\$]|\^\{|[0-9][a-z]{2}[0-9]')""")
def suspicious_lines(spark, sf):
    lines = table(spark, sf, "pages").select("page_id", F.posexplode(F.split("html", "\n")).alias("k", "line"))
    rows = lines.where(F.col("line").rlike(r"[\\$]|\^\{|[0-9][a-z]{2}[0-9]"))
    return rows.select("page_id", (F.col("k") + 1).cast("long").alias("line_no"), F.trim("line").alias("line"))


@query("""
    SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn)[1:8000] AS text, count(*) AS turns FROM conversations GROUP BY conv_id""")
def assembled_text(spark, sf):
    parts = F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("t"))))
    g = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda x: x["t"]), "\n").alias("text"), F.count("*").alias("turns"))
    return g.withColumn("text", F.substring("text", 1, 8000))


@query(r"""
    WITH p AS (SELECT doc_id, str_split(text, chr(10)) AS lines FROM documents),
    x AS (SELECT doc_id, unnest(range(0, len(lines))) AS k, unnest(lines) AS line FROM p),
    f AS (SELECT *, count(*) OVER (PARTITION BY doc_id, lower(trim(line))) AS n FROM x)
    SELECT doc_id, count(*) AS lines, count(*) FILTER (n >= 2 AND trim(line) <> '' AND length(trim(line)) < 40) AS footers FROM f GROUP BY doc_id""")
def repeated_footers(spark, sf):
    from pyspark.sql import Window

    x = docs(spark, sf).select("doc_id", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.lower(F.trim("line")))
    x = x.withColumn("n", F.count("*").over(Window.partitionBy("doc_id", "line")))
    return x.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if((F.col("n") >= 2) & (F.col("line") != "") & (F.length("line") < 40)).alias("footers"))


@query(r"SELECT doc_id, unnest(range(0, len(s))) AS nth, unnest(s) AS piece FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)")
def clause_pieces(spark, sf):
    s = docs(spark, sf).select("doc_id", F.posexplode(T.sentences("text")).alias("nth", "piece"))
    return s.select("doc_id", F.col("nth").cast("long").alias("nth"), "piece")


@query()
def sentence_split(spark, sf):
    """Each sentence as a row; ends inside parentheses are none."""
    s = docs(spark, sf).select("doc_id", F.posexplode(T.whole_sentences("text")).alias("nth", "sentence"))
    return s.select("doc_id", F.col("nth").cast("long").alias("nth"), "sentence")


@query()
def fidelity_gate(spark, sf):
    """Cleaned texts against their originals: same digits, similar length, token ratio of at least 0.85."""
    from sieveline.operators.gates import fidelity

    d = docs(spark, sf).withColumn("after", T.squeeze(T.no_images(T.plain_characters(T.dehyphenate("text")))))
    return fidelity(d, "doc_id", "text", "after")


@query()
def overlap_chunks(spark, sf):
    from sieveline.operators.groups import chunked

    return chunked(docs(spark, sf), "doc_id", "text", 1200, 200, 100)


@query()
def deletion_gate(spark, sf):
    """Texts without their first line, and with words replaced in one text of seven, against the originals; tested by brute force."""
    from sieveline.operators.gates import deletion_only

    after = F.regexp_replace("text", r"^[^\n]*\n", "")
    after = F.when(F.col("doc_id") % 7 == 0, F.regexp_replace(after, r"\bthe\b", "teh")).otherwise(after)
    return deletion_only(docs(spark, sf).withColumn("after", after), "doc_id", "text", "after")
