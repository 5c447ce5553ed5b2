"""Duplicates of documents: plans, keepers, confrontation, clusters."""

from pyspark.sql import functions as F

from sieveline.functions.text import aggressive_form, squeeze
from sieveline.operators import groups as G
from sieveline.operators.joins import confront
from sieveline.plans.registry import query, table
from sieveline.streaming import root_of

LEAST = 300
_FORM = "regexp_replace(strip_accents(lower(text)), '[^0-9a-z]', '', 'g')"


def forms(spark, sf, name="documents"):
    return table(spark, sf, name).withColumn("form", aggressive_form("text"))


@query(f"""
    WITH f AS (SELECT d.doc_id, n_chars, coalesce(quality, 0) AS quality, md5({_FORM}) AS hash, length({_FORM}) AS len FROM documents d LEFT JOIN labels USING (doc_id)),
    g AS (SELECT *, count(*) OVER w AS n, row_number() OVER (PARTITION BY hash, len ORDER BY quality DESC, n_chars DESC, doc_id) AS rn,
            first_value(doc_id) OVER (PARTITION BY hash, len ORDER BY quality DESC, n_chars DESC, doc_id) AS keeper FROM f WHERE len >= {LEAST} WINDOW w AS (PARTITION BY hash, len))
    SELECT doc_id AS loser, keeper, hash, CAST(len AS BIGINT) AS len FROM g WHERE rn > 1""")
def dedup_plan_normalized_text(spark, sf):
    """Stage A writes a hash and the length of each form, made once; of forms that share them, the best by quality, length and id is a minimum, so a large group is never sorted."""
    form = F.explode(F.array(aggressive_form("text"))).alias("form")  # explode, so that the form isn't made again for each use
    made = table(spark, sf, "documents").select("doc_id", "n_chars", form).select("doc_id", "n_chars", F.md5("form").alias("hash"), F.length("form").cast("long").alias("len"))
    path = root_of(spark, "forms")
    made.where(F.col("len") >= LEAST).write.mode("overwrite").parquet(path)
    quality = table(spark, sf, "labels").select("doc_id", "quality")
    f = spark.read.parquet(path).join(quality, "doc_id", "left")
    place = F.struct((-F.coalesce("quality", F.lit(0))).alias("q"), (-F.col("n_chars")).alias("n"), "doc_id")
    best = f.groupBy("hash", "len").agg(F.min(place).alias("best"), F.count("*").alias("rows")).where("rows > 1")
    return f.join(best, ["hash", "len"]).select(F.col("doc_id").alias("loser"), F.col("best.doc_id").alias("keeper"), "hash", "len").where("loser <> keeper")


@query("SELECT sha256(text) AS hash, count(*) AS n, min(doc_id) AS first_id, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY text HAVING count(*) > 1")
def exact_dup_groups(spark, sf):
    d = table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("hash"))
    return d.agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.sum("n_chars").alias("chars")).where("n > 1")


@query("""
    SELECT doc_id AS loser, keeper, hash FROM (SELECT doc_id, sha256(text) AS hash, first_value(doc_id) OVER w AS keeper, row_number() OVER w AS rn
      FROM documents WINDOW w AS (PARTITION BY sha256(text) ORDER BY CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 ELSE 99 END, length(source) DESC, doc_id)) WHERE rn > 1""")
def keeper_election(spark, sf):
    from sieveline.functions.values import rank_of

    d = table(spark, sf, "documents").withColumn("hash", F.sha2("text", 256))
    return G.keepers(d, ["hash"], [rank_of("lang", ["en", "fr"]), F.desc(F.length("source"))], "doc_id")


@query(f"""
    WITH d AS (SELECT doc_id, text, {_FORM} AS form FROM documents), b AS (SELECT text, {_FORM} AS form FROM benchmark),
    f AS (SELECT *, row_number() OVER (PARTITION BY form ORDER BY doc_id) = 1 AS first FROM d)
    SELECT doc_id, CASE WHEN text IN (SELECT text FROM b) THEN 'binary' WHEN form = '' THEN 'empty' WHEN NOT first THEN 'internal' WHEN form IN (SELECT form FROM b) THEN 'text' ELSE 'missing' END AS level FROM f""")
def confront_corpora(spark, sf):
    side = lambda df: df.withColumn("exact", F.sha2("text", 256)).withColumn("form", F.when(F.col("form") == "", "").otherwise(F.sha2("form", 256)))
    return confront(side(forms(spark, sf)), side(forms(spark, sf, "benchmark")), "exact", "form", "doc_id").select("doc_id", "level")


@query(r"""
    SELECT doc_id, fingerprint FROM (SELECT doc_id, md5(lower(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS fingerprint, row_number() OVER (PARTITION BY lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def keep_first_by_fingerprint(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5(F.lower(squeeze("text"))).alias("fingerprint"))
    return G.first_of(d, ["fingerprint"], ["doc_id"])


@query(r"""
    WITH l AS (SELECT doc_id, unnest(str_split(text, chr(10))) AS line FROM documents),
    n AS (SELECT doc_id, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS line FROM l)
    SELECT doc_id, line, count(*) AS n FROM n WHERE line <> '' GROUP BY ALL HAVING count(*) >= 2""")
def repeated_lines(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", squeeze(F.lower("line")))
    return lines.where("line <> ''").groupBy("doc_id", "line").agg(F.count("*").alias("n")).where("n >= 2")


@query("""
    WITH b AS (SELECT doc_id, lower(regexp_replace(source, '[0-9]+$', '')) AS base, lang, n_chars FROM documents)
    SELECT base, lang, n_chars, count(*) AS n, min(doc_id) AS first_id FROM b GROUP BY base, lang, n_chars HAVING count(*) > 1""")
def logical_duplicates(spark, sf):
    d = table(spark, sf, "documents").withColumn("base", F.lower(F.regexp_replace("source", "[0-9]+$", "")))
    return d.groupBy("base", "lang", "n_chars").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query(rf"""
    WITH RECURSIVE d AS (SELECT doc_id, md5(text) AS k1, md5({_FORM}) AS k2, md5(lang || chr(1) || source || chr(1) || trim(regexp_replace(lower(text), '\s+', ' ', 'g'))[1:64]) AS k3, length({_FORM}) AS len FROM documents),
    k AS (SELECT doc_id, 'a' || k1 AS k FROM d UNION ALL SELECT doc_id, 'b' || k2 FROM d WHERE len > 0 UNION ALL SELECT doc_id, 'c' || k3 FROM d WHERE len >= 64),
    m AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS low FROM k), s AS (SELECT doc_id AS a, low AS b FROM m WHERE doc_id <> low UNION SELECT low, doc_id FROM m WHERE doc_id <> low),
    r AS (SELECT a AS node, a AS comp FROM s UNION SELECT s.b, r.comp FROM r JOIN s ON r.node = s.a WHERE r.comp < s.b)
    SELECT node, min(comp) AS comp FROM r GROUP BY node""")
def dup_clusters(spark, sf):
    """Documents of the same bytes, of the same normal form, or (gated by language, source and length) with the same beginning, carried through."""
    form = F.explode(F.array(aggressive_form("text"))).alias("form")
    d = table(spark, sf, "documents").select("doc_id", "text", form, F.md5(F.concat("lang", F.lit("\x01"), "source", F.lit("\x01"), F.substring(squeeze(F.lower("text")), 1, 64))).alias("start"))
    keys = F.array(F.concat(F.lit("a"), F.md5("text")), F.when(F.length("form") > 0, F.concat(F.lit("b"), F.md5("form"))), F.when(F.length("form") >= 64, F.concat(F.lit("c"), "start")))
    keyed = d.select("doc_id", F.explode(F.array_compact(keys)).alias("k"))
    low = keyed.groupBy("k").agg(F.min("doc_id").alias("b"), F.count("*").alias("n")).where("n > 1")
    return G.clusters(keyed.join(low.hint("merge"), "k").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct())


@query("""
    SELECT hash, n, first_id FROM (SELECT left(md5(text), 2) AS hash, count(*) AS n, min(doc_id) AS first_id, count(DISTINCT text) AS texts FROM documents GROUP BY 1) WHERE n BETWEEN 2 AND 20 AND texts = n""")
def low_entropy_review(spark, sf):
    """Groups of 2 to 20 under a weak key in which no two are equal: for review, not for merging."""
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("m")).withColumn("hash", F.substring("m", 1, 2))
    g = d.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.count_distinct("m").alias("texts"))
    return g.where("n between 2 and 20 and texts = n").drop("texts")


_SIGN = "(1 - 2 * (bit_count(((i * 40503 + j * 30011) * 2654435761) & 4294967295)::BIGINT % 2))"


@query(f"""
    WITH RECURSIVE q AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS q FROM embeddings),
    v AS (SELECT vec_id AS id, label, q FROM q UNION ALL SELECT -1 - vec_id, label, list_transform(q, lambda x: CAST(8 * floor((x + 4) / 8) AS BIGINT)) FROM q),
    d AS (SELECT id, label, list_sum(list_transform(q, lambda x: x * x)) AS n, list_transform(range(1, 65), lambda j: list_sum(list_transform(q, lambda x, i: x * {_SIGN})) > 0) AS bits FROM v),
    p AS (SELECT a.id AS a, b.id AS b FROM d a JOIN d b ON a.label = b.label AND a.id < b.id AND 100 * greatest(a.n, b.n) <= 121 * least(a.n, b.n)
      WHERE list_sum(list_transform(list_zip(a.bits, b.bits), lambda z: CASE WHEN z[1] = z[2] THEN 0 ELSE 1 END)) <= 3),
    s AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
    r AS (SELECT a AS node, a AS comp FROM s UNION SELECT s.b, r.comp FROM r JOIN s ON r.node = s.a WHERE r.comp < s.b)
    SELECT node, min(comp) AS comp FROM r GROUP BY node""")
def vector_clusters(spark, sf):
    """The gated tier of duplicate clusters: vectors of two sources, one of which keeps 1/32 of a unit only, are one cluster where their signatures are at most three bits apart, gated by label and norm."""
    from sieveline.operators.signatures import near_links, signature

    q = table(spark, sf, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("q"))
    coarse = q.select((-1 - F.col("vec_id")).alias("vec_id"), "label", F.transform("q", lambda x: 8 * F.floor((x + 4) / 8)).alias("q"))
    both = q.unionByName(coarse).select("vec_id", "label", signature(F.col("q")).alias("sig"), F.aggregate("q", F.lit(0).cast("long"), lambda t, x: t + x * x).alias("norm"))
    path = root_of(spark, "signatures")
    both.write.parquet(path)
    return G.clusters(near_links(spark.read.parquet(path), "vec_id", "label", "sig", "norm", 3))
