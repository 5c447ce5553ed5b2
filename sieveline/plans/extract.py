"""Extraction, labels, filters and matches over texts made up from the rows of the tables; the SQL says what must come out."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sieveline.functions import extract as E
from sieveline.functions import text as T
from sieveline.functions import values as V
from sieveline.operators import joins as J
from sieveline.operators import similar as S
from sieveline.plans.registry import query, spread, table

L = F.lit


def said(*parts):
    """A text of literals and columns; names in braces are columns."""
    return F.concat(*[F.col(p[1:-1]).cast("string") if p[:1] == "{" and p[-1:] == "}" else L(p) for p in parts])


def orders(spark, sf):
    o = spread(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return o.withColumns({"d": F.col("o_orderkey") % 9 + 1, "n": F.col("o_orderkey") + 1000, "year": F.year("o_orderdate"), "day": F.date_format("o_orderdate", "dd/MM/yyyy"), "iso": F.date_format("o_orderdate", "yyyy-MM-dd")})


_O = "o AS (SELECT *, o_orderkey % 9 + 1 AS d, o_orderkey + 1000 AS n, replace(format('{:,}', o_orderkey + 1000), ',', '.') AS th, year(o_orderdate) AS year, strftime(o_orderdate, '%d/%m/%Y') AS day, month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) AS mdy FROM orders)"


@query(f"WITH {_O} SELECT o_orderkey, 'art. ' || d || 'º, § 2º, Lei nº ' || th || '/' || year || '; art. 37, Constituição Federal; art. 1' || d || '-A, Código Eleitoral' AS refs FROM o")
def legal_references(spark, sf):
    one, two = said("Conforme o art. ", "{d}", "º, § 2o, da Lei n. ", "{n}", " de ", "{year}", " e os arts. 37 da Constituição Federal."), said("Ver artigo ", "{d}", ", § 2º, da Lei nº ", "{n}", "/", "{year}", "; Art. 1", "{d}", "-A do Código Eleitoral")
    return orders(spark, sf).select("o_orderkey", F.array_join(E.legal_references(one, two), "; ").alias("refs"))


@query(f"WITH {_O} SELECT o_orderkey, 'REspe ' || n || ', ADI 5' || d || '01, Súmula ' || d AS decisions FROM o")
def decision_references(spark, sf):
    text = F.concat(L("No REspe nº "), V.thousands("n"), said(" e na ADI n. 5", "{d}", "01, como no REspe ", "{n}", " e na Súmula ", "{d}", "."))
    return orders(spark, sf).select("o_orderkey", F.array_join(E.decisions(text), ", ").alias("decisions"))


@query(f"WITH {_O} SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || '-1' || d || '.' || year || '.6.01.0123' AS numbers FROM o")
def fuzzy_case_numbers(spark, sf):
    text = F.concat(L("Autos 12 3 e "), F.lpad(F.col("o_orderkey").cast("string"), 7, "0"), said(" - 1 ", "{d}", ". ", "{year}", " 6 . 01 0123, folha 12"))
    return orders(spark, sf).select("o_orderkey", F.array_join(E.fuzzy_case_numbers(text), ",").alias("numbers"))


_ROMAN = "['', 'X', 'XX', 'XXX', 'XL', 'L'][p_size // 10 + 1] || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][p_size % 10 + 1]"


def sized(spark, sf):
    pick = lambda items, k: F.element_at(F.array(*[L(x) for x in items]), (k + 1).cast("int"))
    numeral = F.concat(pick(["", "X", "XX", "XXX", "XL", "L"], F.floor(F.col("p_size") / 10)), pick(["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"], F.col("p_size") % 10))
    return spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", "p_name", "p_size", "p_type", "p_brand", numeral.alias("numeral"))


@query(f"SELECT p_partkey, {_ROMAN} AS numeral, p_size AS n, CAST(NULL AS INTEGER) AS none FROM part")
def roman_numbers(spark, sf):
    return sized(spark, sf).select("p_partkey", "numeral", E.roman("numeral").alias("n"), E.roman(F.concat("numeral", L("IIX"))).alias("none"))


@query("""
    SELECT p_partkey, 'Art. ' || p_size || CASE WHEN p_size < 10 THEN 'º' ELSE '' END || '-A' AS article, '§ ' || p_size || CASE WHEN p_size < 10 THEN 'º' ELSE '' END AS paragraph, 'Parágrafo único' AS sole, 'Alínea b' AS letter FROM part""")
def device_labels(spark, sf):
    p = sized(spark, sf)
    article = F.when(F.col("p_partkey") % 2 == 0, said("ARTIGO ", "{p_size}", "o - a")).otherwise(said("art.", "{p_size}", "º-A, caput"))
    return p.select("p_partkey", E.device_label(article).alias("article"), E.device_label(said("Parágrafo ", "{p_size}", "º")).alias("paragraph"), E.device_label(L("PARÁGRAFO ÚNICO - Fica")).alias("sole"), E.device_label(L("alínea B")).alias("letter"))


@query(f"WITH {_O} SELECT o_orderkey, 'Sessão de ' || mdy || ' e ' || mdy || ', não 99/99/9999.' AS text FROM o")
def dates_in_text(spark, sf):
    return orders(spark, sf).select("o_orderkey", E.dates_rewritten(said("Sessão de ", "{day}", " e ", "{iso}", ", não 99/99/9999.")).alias("text"))


@query("SELECT c_custkey, trim(c_name) AS name FROM customer")
def name_trim(spark, sf):
    c = spread(table(spark, sf, "customer"), "c_custkey")
    title = F.element_at(F.array(*[L(x) for x in ("Min. ", "Exmo. Sr. Dr. ", "RELATORA: ", "o Desembargador ", "")]), (F.col("c_custkey") % 5 + 1).cast("int"))
    return c.select("c_custkey", E.bare_name(F.concat(title, "c_name", F.when(F.col("c_custkey") % 2 == 0, ", OAB/SP 12.345").otherwise(" (CPF 1)"))).alias("name"))


@query("SELECT p_partkey, p_name || '|' || p_type || '|' || CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE '-' END AS points FROM part")
def bullet_points(spark, sf):
    third = F.when(F.col("p_partkey") % 2 == 0, F.concat(L("\n2) "), "p_brand", L("\n* more"))).otherwise("")
    return spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", F.array_join(E.bullets(F.concat(L("- "), "p_name", L("\n\n• "), "p_type", third)), "|").alias("points"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_name || '; eleitoral' WHEN p_size % 3 = 1 THEN 'Penal; Processo penal' ELSE p_name || '; ' || p_brand END AS branches FROM part")
def branch_pairs(spark, sf):
    raw = F.when(F.col("p_size") % 3 == 0, F.array(L("Outros"), "p_name", F.upper("p_name"), L("eleitoral"), L("civil"))).when(F.col("p_size") % 3 == 1, F.array(L("Penal"), L("civil"))).otherwise(F.array("p_name", L("outros"), "p_brand"))
    return spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", F.array_join(E.limited(raw, 2, ["outros"], {"penal": "Processo penal"}), "; ").alias("branches"))


@query("SELECT c_custkey, 'relator' AS label, c_name AS text FROM customer UNION ALL SELECT c_custkey, 'requerente', c_mktsegment FROM customer UNION ALL SELECT c_custkey, 'advogado', 'none' FROM customer WHERE c_custkey % 2 = 0")
def header_blocks(spark, sf):
    text = F.concat(L("Processo 1. RELATOR: "), "c_name", L(";\nRequerente: "), "c_mktsegment", L(" Requerido: "), F.when(F.col("c_custkey") % 2 == 0, " Advogado: none.").otherwise(""))
    blocks = F.explode(E.label_blocks(text, ["relator", "requerente", "requerido", "advogado"])).alias("b")
    return spread(table(spark, sf, "customer"), "c_custkey").select("c_custkey", blocks).select("c_custkey", "b.label", F.regexp_replace("b.text", "[.]$", "").alias("text"))


@query("SELECT s_suppkey, CAST(0 AS BIGINT) AS nth, '' AS title, s_name AS text FROM supplier UNION ALL SELECT s_suppkey, 1, 'SEÇÃO I', 'first' || chr(10) || 'of ' || s_suppkey FROM supplier UNION ALL SELECT s_suppkey, 2, 'SEÇÃO II', '' FROM supplier")
def section_split(spark, sf):
    text = F.concat("s_name", L("\nSEÇÃO I\nfirst\nof "), "s_suppkey", L("\nSEÇÃO II\n"))
    s = spread(table(spark, sf, "supplier"), "s_suppkey").select("s_suppkey", F.posexplode(E.sections(text, "SEÇÃO [IVX]+")).alias("nth", "s"))
    return s.select("s_suppkey", F.col("nth").cast("long").alias("nth"), "s.title", "s.text")


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'ABC/SP,REDE' WHEN s_suppkey % 3 = 1 THEN 'REDE,AVANTE' ELSE 'AVANTE/SP' END AS parties FROM supplier")
def party_inference(spark, sf):
    k = F.col("s_suppkey") % 3
    entries = F.when(k == 0, F.array(L("Diretório Regional do Partido A (ABC)"), L("a Rede"), L("nobody"))).when(k == 1, F.array(L("Rede sustentável"), L("AVANTE nacional"), L("rede"))).otherwise(F.array(L("Comissão Provisória do Avan"), L("x")))
    return spread(table(spark, sf, "supplier"), "s_suppkey").select("s_suppkey", F.array_join(E.parties(entries, ["REDE", "AVANTE"], L("SP")), ",").alias("parties"))


@query("SELECT c_custkey, c_name || '|Ana Sá|Rui Lima|Zé Nó' AS names FROM customer")
def composition(spark, sf):
    longer = F.concat(L("Sessão. Composição: Min. "), "c_name", L(", Dra. Ana Sá e Rui Lima. Ausente: ninguém."))
    return spread(table(spark, sf, "customer"), "c_custkey").select("c_custkey", F.array_join(E.composition(L("Presentes: Ana Sá; Zé Nó"), longer, L(None)), "|").alias("names"))


@query("SELECT c_custkey, c_name || ' e Filhos|Banco do Sul S/A' AS entities FROM customer")
def whole_entities(spark, sf):
    items = F.array("c_name", F.concat("c_name", L(" e Filhos")), L("Banco do  Sul"), L("Banco do Sul S/A"), L("BANCO DO SUL S/A"), L("sul"), L(""))
    return spread(table(spark, sf, "customer"), "c_custkey").select("c_custkey", F.array_join(E.whole_entities(items), "|").alias("entities"))


@query("SELECT p_partkey, CASE WHEN length(p_name) <= 40 THEN 'O tribunal julgou ' || p_name END AS heading, 'The court heard the case of ' || p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN p_name || ' ' || p_brand ELSE p_name END AS terms FROM part")
def headings_and_titles(spark, sf):
    p = spread(table(spark, sf, "part"), "p_partkey")
    text = F.concat(L("O tribunal julgou "), "p_name", L(", e o recurso de um terceiro que não tinha parte no processo foi negado, por unanimidade."))
    body = F.concat(L("Página 3 de 9\n12/5\nVistos.\nThe court heard the case of "), "p_name", L(".\nIt ended."))
    heading = F.when(F.length("p_name") <= 40, E.best_heading(text, 60))
    terms = E.lookup_terms(["p_name", L(" "), F.upper("p_name"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")), F.repeat(L("x"), 200)], 120)
    return p.select("p_partkey", heading.alias("heading"), E.local_title(body, 100).alias("title"), F.array_join(terms, " ").alias("terms"))


@query(f"""
    WITH {_O} SELECT o_orderkey, (CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END) + (CASE WHEN year = 1997 THEN 1 ELSE 0 END) + (CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS score FROM o
    WHERE (CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 0 END) + (CASE WHEN year = 1997 THEN 1 ELSE 0 END) + (CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) >= 2""")
def evidence_score(spark, sf):
    """Candidates with a score of at least 2."""
    score = E.weighted((F.col("o_orderstatus") == "O", 2), (F.col("year") == 1997, 1), (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 1))
    return orders(spark, sf).select("o_orderkey", score.alias("score")).where("score >= 2")


@query("""
    WITH s AS (SELECT p_partkey, (CASE WHEN p_size > 40 THEN 35 ELSE 0 END) + (CASE WHEN p_type LIKE '%A%' THEN 10 ELSE 0 END) AS interest, (CASE WHEN p_retailprice > 1500 THEN 20 ELSE 0 END) + (CASE WHEN p_brand LIKE '%1' THEN 15 ELSE 0 END) AS impact FROM part)
    SELECT p_partkey, interest, impact, least(100, interest + impact) AS total, CASE WHEN interest >= 35 THEN 'federal' WHEN impact >= 20 THEN 'high' ELSE 'local' END AS scope FROM s""")
def interest_scores(spark, sf):
    p = table(spark, sf, "part")
    p = p.select("p_partkey", E.weighted((F.col("p_size") > 40, 35), (F.col("p_type").contains("A"), 10)).alias("interest"), E.weighted((F.col("p_retailprice") > 1500, 20), (F.col("p_brand").endswith("1"), 15)).alias("impact"))
    scope = F.when(F.col("interest") >= 35, "federal").when(F.col("impact") >= 20, "high").otherwise("local")
    return p.select("*", F.least(L(100), F.col("interest") + F.col("impact")).alias("total"), scope.alias("scope"))


@query(r"""
    WITH l AS (SELECT doc_id, unnest(range(0, len(str_split(text, chr(10))))) AS k, unnest(str_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, count(*) AS lines, count(*) FILTER (length(trim(line)) < 12 OR regexp_matches(line, '^[0-9\s./-]+$') OR regexp_matches(line, '^[-–—_=*.\s]*$')) AS noise FROM l GROUP BY doc_id""")
def noise_lines(spark, sf):
    x = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return x.groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(E.is_noise("line", 12)).alias("noise"))


@query("SELECT doc_id, n_chars FROM documents WHERE lang = 'de' OR regexp_matches(text, '(?i)licen[sc]e') OR least(100, n_chars // 200) >= 35")
def tiered_filter(spark, sf):
    d = table(spark, sf, "documents")
    return d.where((F.col("lang") == "de") | F.col("text").rlike("(?i)licen[sc]e") | (F.least(L(100), F.floor(F.col("n_chars") / 200)) >= 35)).select("doc_id", "n_chars")


@query("SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS publishable FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus IN ('O', 'F')")
def membership_filter(spark, sf):
    o = orders(spark, sf).where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM") & F.col("o_orderstatus").isin("O", "F"))
    return o.select("o_orderkey", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM").alias("publishable"))


@query("SELECT page_id, url FROM pages WHERE starts_with(url, 'https://') AND len(list_intersect(str_split(url, '/'), ['en', 'de'])) > 0")
def path_filters(spark, sf):
    """URLs by prefix and by a segment of a protected set."""
    segments = F.arrays_overlap(F.split("url", "/"), F.array(*[L(x) for x in ("en", "de")]))
    return table(spark, sf, "pages").where(F.col("url").startswith("https://") & segments).select("page_id", "url")


@query("""
    WITH i AS (SELECT p_partkey, p_name || '/' || CASE WHEN p_size % 4 = 0 THEN '.thumbnails/' ELSE '' END || 'x.jpg' AS path, p_size * 10 AS w, p_partkey % 500 AS h FROM part)
    SELECT p_partkey, CASE WHEN least(w, h) < 50 THEN 'small' WHEN regexp_matches(path, '(?i)(?:^|/)[.]?(?:thumbnails?|cache)/') AND greatest(w, h) <= 320 THEN 'cache' END AS why FROM i WHERE least(w, h) < 50 OR (regexp_matches(path, '(?i)(?:^|/)[.]?(?:thumbnails?|cache)/') AND greatest(w, h) <= 320)""")
def thumbnails(spark, sf):
    i = table(spark, sf, "part").select("p_partkey", F.concat("p_name", L("/"), F.when(F.col("p_size") % 4 == 0, ".thumbnails/").otherwise(""), L("x.jpg")).alias("path"), (F.col("p_size") * 10).alias("w"), (F.col("p_partkey") % 500).alias("h"))
    why = F.when(F.least("w", "h") < 50, "small").when(F.col("path").rlike("(?i)(?:^|/)[.]?(?:thumbnails?|cache)/") & (F.greatest("w", "h") <= 320), "cache")
    return i.select("p_partkey", why.alias("why")).where("why IS NOT NULL")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Sentença ' || p_size || '.pdf' WHEN p_size % 3 = 1 THEN p_name || ' ' || p_size || '.pdf' ELSE 'doc_' || p_size || '.pdf' END AS name FROM part")
def file_names(spark, sf):
    k = F.col("p_size") % 3
    p = spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", F.element_at(F.array(L("jur/a"), L("est"), L("x")), k.cast("int") + 1).alias("folder"), F.when(k == 0, F.concat(L("sent_"), "p_size", L(" (copia).pdf"))).when(k == 1, F.concat("p_name", L("__"), "p_size", L(".pdf"))).otherwise(F.concat(L("doc_"), "p_size", L(".pdf"))).alias("name"))
    rules = [("jur", [("^sent_", "Sentença "), (r" \(copia\)", "")]), ("est", [("_+", " ")]), ("jur/a", [(".*", "never")])]
    return p.select("p_partkey", E.renamed("folder", "name", rules).alias("name"))


@query("""
    WITH f AS (SELECT doc_id, source || CASE WHEN doc_id % 3 = 0 THEN ' (' || (doc_id % 5 + 2) || ')' ELSE '' END AS name, source AS base, doc_id % 7 AS folder FROM documents),
    t AS (SELECT DISTINCT folder, name FROM f), o AS (SELECT f.*, row_number() OVER (PARTITION BY folder, base ORDER BY doc_id) AS rn FROM f WHERE name <> base AND NOT EXISTS (SELECT 1 FROM t WHERE t.folder = f.folder AND t.name = f.base))
    SELECT f.doc_id, CASE WHEN o.rn = 1 THEN f.base ELSE f.name END AS name FROM f LEFT JOIN o USING (doc_id)""")
def orphan_suffixes(spark, sf):
    name = F.concat("source", F.when(F.col("doc_id") % 3 == 0, F.concat(L(" ("), F.col("doc_id") % 5 + 2, L(")"))).otherwise(""))
    f = table(spark, sf, "documents").select("doc_id", (F.col("doc_id") % 7).alias("folder"), name.alias("name"))
    return J.without_orphan_suffixes(f, ["folder"], "name", "doc_id").select("doc_id", "name")


@query("""
    WITH a AS (SELECT s_nationkey AS g, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn, count(*) OVER (PARTITION BY s_nationkey) AS c FROM supplier),
    b AS (SELECT s_nationkey AS g, s_suppkey AS other, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS rn, count(*) OVER (PARTITION BY s_nationkey) AS c FROM supplier WHERE s_acctbal > 0)
    SELECT s_suppkey, other FROM a JOIN b ON a.g = b.g AND a.rn = b.rn AND a.c = b.c""")
def row_index_join(spark, sf):
    """Groups of equal sizes are paired row by row; others not at all. Suppliers by key with those by balance, in nations where none is in debt."""
    s = table(spark, sf, "supplier")
    a, b = s.select(F.col("s_nationkey").alias("g"), "s_suppkey"), s.where("s_acctbal > 0").select(F.col("s_nationkey").alias("g"), F.col("s_suppkey").alias("other"), "s_acctbal")
    return J.by_row_index(a, b, ["g"], ["s_suppkey"], ["s_acctbal", "other"]).select("s_suppkey", "other")


@query("""
    WITH r AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, CAST(o_orderdate AS DATE) AS lo, CAST(o_orderdate AS DATE) + 3 AS hi FROM orders WHERE o_orderkey % 50 = 0)
    SELECT DISTINCT o_orderkey, r.k FROM orders o JOIN r ON (o.o_custkey = r.c AND o.o_orderstatus = r.s) OR (o.o_orderpriority = '1-URGENT' AND CAST(o.o_orderdate AS DATE) BETWEEN lo AND hi) WHERE o_orderkey <> r.k""")
def conditional_match(spark, sf):
    """(same customer and status) or (urgent and in the range of days): one equi-join each, no OR in a join. The reference is every fiftieth order.

    The pairs by days grow with the square of the orders of a day, and so does the result. A pair found both ways is left to the first join,
    so pairs of orders whose keys stand once are different as they come, and none is shuffled. Those of keys that repeat are made distinct.
    """
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    again = o.groupBy("o_orderkey").count().where("count > 1").select("o_orderkey")
    once, more = o.join(again, "o_orderkey", "left_anti"), o.join(again, "o_orderkey", "left_semi")

    def pairs(left, right):
        r = right.where("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("s"), "day")
        alike = (F.col("o_custkey") == F.col("c")) & (F.col("o_orderstatus") == F.col("s"))
        same = left.join(r.drop("day"), alike).select("o_orderkey", "k")
        days = r.select("k", "c", "s", F.explode(F.sequence("day", F.date_add("day", 3))).alias("day"))
        near = spread(left.where("o_orderpriority = '1-URGENT'"), "day").join(spread(days, "day"), "day").where(~F.coalesce(alike, L(False)))
        return same.unionByName(near.select("o_orderkey", "k")).where("o_orderkey <> k")

    return pairs(once, once).unionByName(pairs(more, o).unionByName(pairs(once, more)).distinct())


@query("""
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders),
    p AS (SELECT o.o_orderkey, r.o_orderkey AS k FROM o JOIN o r USING (o_custkey, o_orderstatus) UNION SELECT o.o_orderkey, r.o_orderkey FROM o JOIN o r ON o.day BETWEEN r.day AND r.day + 3 WHERE o.o_orderpriority = '1-URGENT')
    SELECT o_orderkey, count(*) AS n, CAST(sum(k) AS BIGINT) AS key_sum FROM p WHERE o_orderkey <> k GROUP BY 1""")
def conditional_match_totals(spark, sf):
    """(same customer and status) or (urgent and in the range of days), all orders against all: how many each meets, and the sum of their keys."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day"))
    return J.either(o, "o_orderkey", ["o_custkey", "o_orderstatus"], F.col("o_orderpriority") == "1-URGENT", "day", 3)


@query("""
    WITH c AS (SELECT p_brand AS g, p_partkey AS cand, p_name || ' ' || p_type AS full_text FROM part), t AS (SELECT p_brand AS g, p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN p_type ELSE 'zzz' END AS text FROM part),
    m AS (SELECT p_partkey, cand, CASE WHEN starts_with(full_text, text) THEN 2 WHEN contains(full_text, text) THEN 1 ELSE 0 END AS score FROM t JOIN c USING (g)),
    r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, cand) AS rn FROM m WHERE score > 0) SELECT p_partkey, cand, score FROM r WHERE rn = 1""")
def prefix_match(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey") % 3
    t = p.select(F.col("p_brand").alias("g"), "p_partkey", F.when(k == 0, F.col("p_name")).when(k == 1, F.col("p_type")).otherwise("zzz").alias("text"))
    c = p.select(F.col("p_brand").alias("g"), F.col("p_partkey").alias("cand"), F.concat("p_name", L(" "), "p_type").alias("full_text"))
    return S.by_prefix(t, c, ["g"], "text", "full_text", "p_partkey", "cand").select("p_partkey", "cand", "score")


@query()
def similar_text_match(spark, sf):
    """Within a brand, the part whose name and type are most like a part's type and name; tested by brute force."""
    p = table(spark, sf, "part")
    t = p.select("p_brand", "p_size", "p_partkey", F.concat("p_type", L(" "), "p_name").alias("text"))
    c = p.select("p_brand", "p_size", F.col("p_partkey").alias("cand"), F.concat("p_name", L(" "), "p_type").alias("other"))
    return S.most_alike(t, c, ["p_brand", "p_size"], "text", "other", "p_partkey", "cand", 0.5)


@query("""
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'dir/short ' || p_size || '.pdf' ELSE 'dir/' || rtrim((p_name || ' ' || repeat('longa ', 60))[1:223]) || ' - 0000001-02.2020.6.01.0001.pdf' END AS path FROM part""")
def path_shortening(spark, sf):
    name = F.when(F.col("p_partkey") % 2 == 0, F.concat(L("short "), "p_size", L(".pdf"))).otherwise(F.concat("p_name", L(" "), F.repeat(L("longa "), 60), L("- 0000001-02.2020.6.01.0001.pdf")))
    return spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", E.shortened(L("dir"), name).alias("path"))


@query("SELECT p_partkey, 'Café e ação ' || p_name AS text, p_name AS plain FROM part")
def mojibake_repair(spark, sf):
    return spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", T.repair_mojibake(F.concat(L("CafÃ© e aÃ§Ã£o "), "p_name")).alias("text"), T.repair_mojibake("p_name").alias("plain"))


@query("SELECT p_partkey, 'cerca de ' || p_size || '% no ' || p_size || 'º ou 1/' || p_size || '.' || chr(10) || 'Art. ' || p_size || ' - x;' || chr(10) || '§ 2 y' AS text, CAST(1 AS INTEGER) AS residue FROM part")
def latex_and_provisions(spark, sf):
    raw = said("cerca de $", "{p_size}", " \\%$ no $", "{p_size}", "^{\\circ}$ ou $\\frac{1}{", "{p_size}", "}$. Art. ", "{p_size}", " - x; § 2 y")
    return spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", T.split_provisions(T.latex_plain(raw)).alias("text"), T.latex_residue(F.concat(T.latex_plain(raw), L(" \\alpha"))).alias("residue"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 1 THEN o_orderstatus ELSE 'none' END AS filled FROM orders")
def first_filled(spark, sf):
    k = F.col("o_orderkey") % 3
    return table(spark, sf, "orders").select("o_orderkey", T.first_filled(F.when(k == 0, F.col("o_orderpriority")).otherwise("  "), F.when(k == 1, F.col("o_orderstatus")), L("none")).alias("filled"))


@query("""
    WITH n AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE upper(source) END AS plain FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY lower(plain) ORDER BY doc_id) AS k FROM n)
    SELECT doc_id, plain || CASE WHEN k > 1 THEN ' (' || k || ')' ELSE '' END AS name FROM r""")
def unaccented_names(spark, sf):
    """Names without accents, numbered where two become one."""
    plain = T.fold(F.when(F.col("doc_id") % 2 == 0, F.translate("source", "aeo", "áêõ")).otherwise(F.upper(F.translate("source", "aeo", "áêõ"))))
    d = table(spark, sf, "documents").select("doc_id", plain.alias("plain")).withColumn("k", F.row_number().over(Window.partitionBy(F.lower("plain")).orderBy("doc_id")))
    return d.select("doc_id", F.when(F.col("k") > 1, F.concat("plain", L(" ("), "k", L(")"))).otherwise(F.col("plain")).alias("name"))


@query("""
    WITH c AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS date, CASE o_orderkey % 3 WHEN 0 THEN 'exif' WHEN 1 THEN 'name' ELSE 'file' END AS source, CASE WHEN o_orderkey % 2 = 0 THEN 'day' ELSE 'month' END AS grain, o_orderstatus = 'F' AS champion FROM orders),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE source WHEN 'exif' THEN 0 WHEN 'name' THEN 1 ELSE 99 END, CASE grain WHEN 'day' THEN 0 ELSE 99 END, champion DESC, date, o_orderkey) AS rn FROM c)
    SELECT o_custkey, date, source, grain FROM r WHERE rn = 1""")
def best_date_in_group(spark, sf):
    """By source, grain, champion and date; a minimum over each group, so a large one is never gathered."""
    k = F.col("o_orderkey") % 3
    source, grain = F.when(k == 0, "exif").when(k == 1, "name").otherwise("file"), F.when(F.col("o_orderkey") % 2 == 0, "day").otherwise("month")
    c = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("date"), source.alias("source"), grain.alias("grain"), (F.col("o_orderstatus") != "F").alias("other"))
    place = F.struct(V.rank_of("source", ["exif", "name"]).alias("s"), V.rank_of("grain", ["day"]).alias("g"), "other", "date", "o_orderkey")
    return c.groupBy("o_custkey").agg(F.min_by(F.struct("date", "source", "grain"), place).alias("b")).select("o_custkey", "b.*")


@query(f"WITH {_O} SELECT o_orderkey, 'strict:REspe ' || n || ', fuzzy:ADI-' || d || ', strict:HC ' || d AS spans FROM o")
def citation_spans(spark, sf):
    """Strict citations first, looser ones only in what is left between them."""
    text = said("No REspe ", "{n}", " e na ADI-", "{d}", ", e HC ", "{d}", " aqui.")
    found = E.spans(text, r"\b(?:REspe|HC) [0-9]+", r"\b(?:REspe|HC|ADI)[ -]*[0-9]+")
    return orders(spark, sf).select("o_orderkey", F.array_join(F.transform(found, lambda x: F.concat(x["kind"], L(":"), x["text"])), ", ").alias("spans"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) AS b FROM orders")
def detected_dates(spark, sf):
    """Two columns of dates, one with the day first and one with the month first; each tells its order itself."""
    o = orders(spark, sf).select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("a"), F.date_format("o_orderdate", "M/d/yyyy").alias("b"))
    return V.detected_date(V.detected_date(o, "a"), "b")


@query("""
    WITH c AS (SELECT p_partkey, CASE WHEN p_type LIKE '%PROMO%' OR p_type LIKE '%STANDARD%' THEN 'market' ELSE 'other' END AS subject FROM part)
    SELECT p_partkey, subject, CASE subject WHEN 'market' THEN 'economy > trade' ELSE 'general' END AS path FROM c""")
def subject_taxonomy(spark, sf):
    """Subjects by weighted rules, then their places in a taxonomy by a dimension join."""
    from sieveline.operators import groups as G

    rules = [("market", "PROMO", 2), ("market", "STANDARD", 1)]
    taxonomy = spark.createDataFrame([("market", "economy > trade"), ("other", "general")], "subject string, path string")
    subject = F.coalesce(F.get(G.rules_score(F.col("p_type"), rules), L(0))["label"], L("other"))
    return table(spark, sf, "part").select("p_partkey", subject.alias("subject")).join(F.broadcast(taxonomy), "subject", "left").select("p_partkey", "subject", "path")


@query("""
    WITH n AS (SELECT p_name, count(*) AS n FROM part GROUP BY 1), l AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 0 THEN p_partkey END AS exact FROM part)
    SELECT l.p_partkey, coalesce(exact, CASE WHEN n = 1 THEN l.p_partkey END) AS v FROM l JOIN n USING (p_name)""")
def exact_else_unique_name(spark, sf):
    p = table(spark, sf, "part")
    left = p.select("p_partkey", "p_name", F.when(F.col("p_partkey") % 2 == 0, F.col("p_partkey")).alias("exact"))
    return J.exact_else_unique(left, p.select(F.col("p_partkey").alias("exact"), "p_name", F.col("p_partkey").alias("v")), "exact", "p_name", "v").select("p_partkey", "v")


@query("""
    WITH n AS (SELECT p_partkey, p_brand, CASE WHEN row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1 THEN '' ELSE ' (' || row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) || ')' END AS mark FROM part)
    SELECT p_partkey, p_brand || '/' || rtrim(repeat('longa ', 60)[1:259 - length(p_brand) - 1 - 4 - length(mark)]) || mark || '.pdf' AS path FROM n""")
def path_collisions(spark, sf):
    """All names of a brand are the same once cut; they are numbered and still fit."""
    from sieveline.operators.domain import distinct_paths

    named = spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", "p_brand", F.concat(F.repeat(L("longa "), 60), F.col("p_partkey").cast("string"), L(".pdf")).alias("name"))
    return distinct_paths(named, "p_partkey", "p_brand", "name").select("p_partkey", "path")


@query(r"""
    SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'no § ' || p_size || 'º, II' WHEN 1 THEN 'cerca de ' || p_size || ',5% da ' || p_size || 'ª parte' WHEN 2 THEN p_name || '/' || p_size || ' de x'
      WHEN 3 THEN 'fica $\alpha_{' || p_size || '}$ assim' WHEN 4 THEN 'R$ ' || p_size || ',00 e R$ 7,00' WHEN 5 THEN 'ângulo ' || p_size || '′ e ' || p_size || '″' ELSE 'art. ' || p_size || 'º sem cifra' END AS text FROM part""")
def latex_forms(spark, sf):
    """Spans of several kinds; what can't be said in plain text and sums of money stay."""
    size, name = "{p_size}", "{p_name}"
    kinds = [
        ("no $\\S ", size, "^{\\circ}$, $\\mathrm{II}$"), ("cerca de $", size, ",5 \\%$ da $", size, "^{a}$ parte"), ("$\\frac{\\text{", name, "}}{", size, "}$ de x"),
        ("fica $\\alpha_{", size, "}$ assim"), ("R$ ", size, ",00 e R$ 7,00"), ("ângulo $", size, "^{\\prime}$ e $", size, "^{\\prime\\prime}$"), ("art. ", size, "^{\\circ} sem cifra"),
    ]
    raw = F.lit(None).cast("string")
    for k, kind in enumerate(kinds):
        raw = F.when(F.col("p_partkey") % len(kinds) == k, said(*kind)).otherwise(raw)
    return spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", T.latex_plain(raw).alias("text"))
