"""Line passes over texts made up of some forty lines, of which each part has others, so that each line meets many neighbours. The SQL works on rows of lines with LAG and LEAD."""

from pyspark.sql import functions as F

from sieveline.functions import passes as P
from sieveline.plans.registry import query, spread, table

#: {k} is the part's key, {n} its size, {w} its name.
LINES = (
    "Relator: {w}", "Requerente: Partido {w}, advogado: {w}", "", "# PARTIDO {k}", "# ESTATUTO DO PARTIDO {k}:", "## TÍTULO", "I", "Da {w}.", "", "### CAPÍTULO II", "# SEÇÃO IV -", "Dos fins;", "",
    "## Art. 9 - Disposições", "Art. 1", "- O membro de {w},", "{n}", "que paga no mínimo", "{n}%", "> citado,", "(do valor) segue a Lei n.", "º", "{k}, de 1995.", "| Art. 5 - | assinado eletronicamente |", "Assinado eletronicamente por {w}",
    "Art. {n}º - Fica {w}", "Art. 3 - Número do documento: {k} no Art. 12º e § 10º", "§ 2 - O prazo", "Parágrafo", "7 -", "de {w}", "I- {w}", "a)item {n}", "> a)item {n}", "# {w}", "#### Título de {w}:", "[IMAGEM n={n} w=3] {w}", "[IMAGEM n=2]", "",
    "  ", "", "Página {n} de 60", "", "Art. 4 0º - Texto", "[TABELA] {n}", "{k}{k}{k}{k}{k}", "Esta lei entra em vigor.", "II - fica", "", "Brasília, 12 de março de 1995", "SECRETARIA GERAL", "Certidão do cartório, selo digital", "Texto que segue o fim", "",
)
#: Line j stands in the text of part k where (PACE * k + STEP * j) % 7 is below FEW.
PACE, STEP, FEW = 31, 17, 5


def statutes(spark, sf):
    one = lambda x: F.replace(F.replace(F.replace(F.lit(x), F.lit("{k}"), F.col("p_partkey").cast("string")), F.lit("{n}"), F.col("p_size").cast("string")), F.lit("{w}"), F.col("p_name"))
    own = F.array_compact(F.array(*[F.when((F.col("p_partkey") * PACE + STEP * j) % 7 < FEW, one(x)) for j, x in enumerate(LINES)]))
    return spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", F.array_join(own, "\n").alias("text"))


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _like(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {_quoted(pattern)})"


_KIND = "CASE " + " ".join(f"WHEN {_like('t', p)} THEN '{k}'" for k, p in P.KINDS.items()) + " ELSE '' END"
_ROWS = rf"""w(j, line) AS (VALUES {', '.join(f"({j}, {_quoted(x)})" for j, x in enumerate(LINES))}),
    q AS (SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY j) - 1 AS INT) AS i, CAST(count(*) OVER (PARTITION BY p_partkey) AS INT) AS n,
        replace(replace(replace(line, '{{k}}', CAST(p_partkey AS VARCHAR)), '{{n}}', CAST(p_size AS VARCHAR)), '{{w}}', p_name) AS x FROM part, w WHERE (p_partkey * {PACE} + j * {STEP}) % 7 < {FEW}),
    l AS (SELECT *, regexp_replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), '^#{{1,6}}\s+', '') AS t, {_like('x', P.GUARDED)} AS guarded, {_like('x', P.HASHES)} AS heading FROM q),
    k AS (SELECT *, {_KIND} AS kind, {_like('t', P.OPEN)} AS open FROM l),
    f AS (SELECT *, struct_pack(t := t, guarded := guarded, heading := heading, kind := kind, open := open) AS s FROM k WHERE t <> ''),
    e AS (SELECT *, lag(s, 1) OVER v AS one, lag(s, 2) OVER v AS two, lead(s) OVER v AS nxt, repeat(chr(10), i - coalesce(lag(i) OVER v, 0)) AS ends, lead(i) OVER v IS NULL AS final FROM f WINDOW v AS (PARTITION BY p_partkey ORDER BY i))"""


def by_line(line: str) -> str:
    return f"WITH {_ROWS} SELECT p_partkey, string_agg(CASE WHEN guarded THEN x ELSE {line} END, chr(10) ORDER BY i) AS text FROM k GROUP BY p_partkey"


def reflowed(before: str, text: str) -> str:
    """before and text see a line's columns, and one, two and nxt."""
    return rf"""WITH {_ROWS}, g AS (SELECT *, {before} AS before FROM e)
        SELECT p_partkey, string_agg(coalesce(before, ends) || {text} || CASE WHEN final THEN repeat(chr(10), n - 1 - i) ELSE '' END, '' ORDER BY i) AS text FROM g GROUP BY p_partkey"""


_FOLDED = r"regexp_replace(strip_accents(lower(x)), '^\s+|\s+$', '', 'g')"


@query(f"WITH {_ROWS} SELECT p_partkey, string_agg(x, chr(10) ORDER BY i) AS text FROM k WHERE guarded OR {_like('x', P.KINDS['provision'])} OR {_like('x', P.KINDS['item'])} OR NOT ({' OR '.join(_like(_FOLDED, p) for p in P.STAMPS)}) GROUP BY p_partkey")
def stamp_lines(spark, sf):
    return statutes(spark, sf).withColumn("text", P.without_stamps("text"))


@query(rf"""
    WITH {_ROWS}, p AS (SELECT *, {_like('t', '^[0-9]{1,4}$')} AND NOT heading AS page,
            coalesce({_like('one.t', '^[0-9]{1,4}$')} AND NOT one.heading AND two.open AND NOT two.guarded AND NOT two.heading AND {_like('t', r'^\p{Ll}')} AND kind <> 'item' AND NOT guarded AND NOT heading, false) AS parted FROM e),
    g AS (SELECT *, lag(page) OVER v AS was, lead(parted) OVER v AS next_joins FROM p WINDOW v AS (PARTITION BY p_partkey ORDER BY i))
    SELECT p_partkey, string_agg(CASE WHEN parted THEN ' ' || t WHEN page THEN CASE WHEN was OR next_joins THEN '' ELSE ends END WHEN was THEN x ELSE ends || x END
        || CASE WHEN final THEN repeat(chr(10), greatest(0, n - 1 - i - CAST(page AS INT))) ELSE '' END, '' ORDER BY i) AS text FROM g GROUP BY p_partkey""")
def page_numbers(spark, sf):
    return statutes(spark, sf).withColumn("text", P.without_page_numbers("text"))


_LOW, _DASHED = _like("t", P.LOWER), _like("t", f"^{P.DASH}")
_WHOLE = f"(one.kind = 'bare' OR (one.kind = 'number' AND coalesce(two.kind = 'label' AND {_like('two.t', f'^{P.LABEL}$')}, false)))"


@query(reflowed(rf"""CASE WHEN one IS NULL OR one.guarded OR guarded THEN NULL
    WHEN one.kind = 'label' AND (kind = 'number' OR {_like('t', P.NUMBERED)}) THEN ' '
    WHEN {_WHOLE} AND ({_DASHED} OR ({_LOW} AND {_like('one.t', P.DASH + '$')})) THEN ' '
    WHEN {_WHOLE} AND {_LOW} THEN ' - '
    WHEN one.heading THEN NULL
    WHEN kind = 'sign' THEN ''
    WHEN one.kind = 'sign' AND two IS NOT NULL AND {_like('t', '^[0-9]')} THEN ' '
    WHEN kind = 'share' AND one.open THEN ' '
    WHEN one.kind = 'share' AND coalesce(two.open AND NOT two.guarded AND NOT two.heading, false) AND {_LOW} THEN ' ' END""", "CASE WHEN before IS NULL THEN x ELSE t END"))
def parted_blocks(spark, sf):
    return statutes(spark, sf).withColumn("text", P.put_together("text"))


def _ordinals(x: str) -> str:
    part = lambda k: f"regexp_extract({x}, {_quoted(P.PROVISION)}, {k})"
    number = f"replace({part(2)}, ' ', '')"
    sign = f"CASE WHEN NOT regexp_matches({number}, '^[1-9]$') THEN '' WHEN upper({part(1)}[1]) = 'P' THEN {part(3)} ELSE 'º' END"
    gap = f"CASE WHEN {_like(x, f'^{P.LABEL} ')} THEN ' ' ELSE '' END"
    first = f"CASE WHEN {_like(x, P.PROVISION)} THEN concat({part(1)}, {gap}, {number}, {sign}, {part(4)}, {part(5)}, {part(6)}) ELSE {x} END"
    first = f"regexp_replace({first}, {_quoted(rf'((?:^|[^\p{{L}}])(?:{P.LABEL}|art\.?|artigo|par[áa]grafo) ?[0-9]{{2,3}}) ?[º°]')}, '\\1', 'g')"
    return f"regexp_replace(regexp_replace({first}, '^({P.ROMAN}) ?{P.DASH} *(\\S)', '\\1 - \\2'), '^([a-z]) ?\\) *(\\S)', '\\1) \\2')"


@query(by_line(_ordinals("x")))
def ordinal_style(spark, sf):
    return statutes(spark, sf).withColumn("text", P.ordinal_style("text"))


def _name(s: str) -> str:
    return f"regexp_replace({s}t, '[:;.,]+$', '')"


def _fits(s: str) -> str:
    return f"(NOT {s}guarded AND {s}kind NOT IN ('group', 'provision', 'bare') AND length({_name(s)}) <= 90 AND {_name(s)} <> '')"


@query(reflowed(f"CASE WHEN one.heading AND one.kind = 'group' AND {_fits('')} THEN ' — ' END", rf"""CASE WHEN before IS NOT NULL THEN {_name('')}
    WHEN heading AND kind = 'group' AND nxt IS NOT NULL AND {_fits('nxt.')} THEN regexp_replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), {_quoted(P.CUT_OFF)}, '') ELSE x END"""))
def heading_names(spark, sf):
    return statutes(spark, sf).withColumn("text", P.named_headings("text"))


@query(by_line(r"CASE WHEN heading THEN regexp_replace(regexp_replace(x, '^\s+|\s+$', '', 'g'), '\s*[:;.,]+$', '') ELSE x END"))
def heading_ends(spark, sf):
    return statutes(spark, sf).withColumn("text", P.bare_headings("text"))


_DEPTH = "CASE " + " ".join(f"WHEN {_like('t', rf'^{P.spelled([w])}(?:[^\p{{L}}]|$)')} THEN {d}" for w, d in P.GROUPINGS.items()) + " END"


@query(rf"""
    WITH {_ROWS}, h AS (SELECT *, {_like('t', P.KINDS['provision'])} AS provision, {_DEPTH} AS depth, length(regexp_extract(x, {_quoted(P.HASHES)}, 1)) AS own FROM k),
    v AS (SELECT *, i = min(CASE WHEN heading AND NOT provision THEN i END) OVER z AS first, coalesce(bool_or(heading AND NOT provision AND depth = 0) OVER z, false) AS top FROM h WINDOW z AS (PARTITION BY p_partkey))
    SELECT p_partkey, string_agg(CASE WHEN NOT heading THEN x WHEN provision THEN t
        ELSE repeat('#', CAST(CASE depth WHEN 0 THEN 2 WHEN 1 THEN CASE WHEN top THEN 3 ELSE 2 END WHEN 2 THEN 3 ELSE CASE WHEN first THEN 1 ELSE least(greatest(own, 2), 3) END END AS INT)) || ' ' || t END, chr(10) ORDER BY i) AS text
    FROM v GROUP BY p_partkey""")
def heading_levels(spark, sf):
    return statutes(spark, sf).withColumn("text", P.levelled_headings("text"))


def _hits(words) -> str:
    return f"len(list_filter(string_split_regex(m, '[^a-z]+'), lambda y: y IN ({', '.join(map(_quoted, words))})))"


@query(rf"""
    WITH {_ROWS}, m AS (SELECT p_partkey, i, n, x, t, guarded, heading, kind, translate(t, {_quoted(P.CHARS_FROM)}, {_quoted(P.CHARS_TO)}) AS u, strip_accents(lower(translate(t, {_quoted(P.CHARS_FROM)}, {_quoted(P.CHARS_TO)}))) AS m FROM k),
    a AS (SELECT *, {_hits(P.PROCEEDINGS)} AS trial, {_hits(P.CLOSINGS)} > 0 AS closes, regexp_extract(m, '^([a-z]+)', 1) AS first, {_like('u', P.KINDS['item'])} AS item,
        NOT guarded AND ({_like('u', P.KINDS['provision'])} OR {_like('m', 'entra(ra)? em vigor')}) AS normative,
        {_like('m', '^(titulo|capitulo) *(i|1|primeiro)([^a-z0-9]|$)|^art(igo|[.])? *1 *[ºo°]? *[-–—.]')} AS weak FROM m),
    b AS (SELECT *, (first IN ('estatuto', 'estatutos') OR (heading AND first IN ({', '.join(map(_quoted, P.TITLES))}))) AND trial = 0 AS strong, heading AND trial = 0 AS joins,
        length(u) < 4 OR closes OR ({_like('u', '^[^a-zà-ü]{6,90}$')} AND {_like('u', '[A-ZÀ-Ü]{2}')}) OR {_like('m', '^[a-z. ]{3,40}, (aos? )?[0-9]{1,2}º? de [a-z]+ de [0-9]{4}')} AS loose FROM a),
    c AS (SELECT p_partkey, any_value(n) AS n, coalesce(min(i) FILTER (strong), min(i) FILTER (weak), 0) AS anchor, coalesce(max(i) FILTER (normative), -1) AS norm, coalesce(max(i) FILTER (NOT loose), -1) AS firm FROM b GROUP BY 1),
    d AS (SELECT p_partkey, c.n, anchor, norm, firm, coalesce(max(i) FILTER (i < anchor AND u <> '' AND NOT joins), -1) AS stop, coalesce(min(i) FILTER (i > norm AND u <> '' AND NOT item AND NOT normative), c.n) AS past
        FROM c JOIN b USING (p_partkey) GROUP BY p_partkey, c.n, anchor, norm, firm),
    z AS (SELECT p_partkey, d.n, coalesce(min(i) FILTER (i > stop AND i < anchor AND u <> ''), anchor) AS begins, CASE WHEN norm >= 0 THEN coalesce(max(i) FILTER (i < past AND u <> ''), -1) ELSE firm END AS ends
        FROM d JOIN b USING (p_partkey) GROUP BY p_partkey, d.n, anchor, norm, firm),
    s AS (SELECT p_partkey, z.n, CASE WHEN begins > 0 AND coalesce(sum(trial) FILTER (i < begins), 0) >= 2 AND count(*) FILTER (i < begins AND normative) < 3 AND begins <= z.n * 0.4 THEN begins ELSE 0 END AS cut_before,
        CASE WHEN coalesce(bool_or(closes) FILTER (i > ends), false) AND count(*) FILTER (i > ends AND u <> '') <= {P.MOST_CLOSING} AND z.n - 1 - ends <= z.n * 0.4 THEN z.n - 1 - ends ELSE 0 END AS cut_after
        FROM z JOIN b USING (p_partkey) GROUP BY p_partkey, z.n, begins, ends)
    SELECT p_partkey, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (i >= cut_before AND i < s.n - cut_after), '') AS text, CAST(cut_before AS INT) AS cut_before, CAST(cut_after AS INT) AS cut_after FROM s JOIN b USING (p_partkey) GROUP BY p_partkey, cut_before, cut_after""")
def scope_cut(spark, sf):
    return statutes(spark, sf).select("p_partkey", P.cut_scope("text").alias("c")).select("p_partkey", "c.*")


def _final(lines: str, where: str = "true") -> str:
    ended = rf"regexp_replace(regexp_replace(string_agg(rtrim({lines}), chr(10) ORDER BY i) FILTER ({where}), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"
    return f"WITH {_ROWS} SELECT p_partkey, {ended} AS text FROM k GROUP BY p_partkey"


@query(_final("x", f"NOT {_like('x', P.IMAGE)}"))
def image_marks(spark, sf):
    return statutes(spark, sf).withColumn("text", P.image_lines("text"))


@query(_final(f"CASE WHEN {_like('x', P.IMAGE)} THEN '> Figura ' || regexp_extract(x, {_quoted(P.IMAGE)}, 1) || ' — ' || coalesce(nullif(regexp_extract(x, {_quoted(P.IMAGE)}, 2), ''), 'imagem do documento original') ELSE x END"))
def image_captions(spark, sf):
    return statutes(spark, sf).withColumn("text", P.image_lines("text", keep=True))


def _plain_sql(text: str) -> str:
    text = f"translate(translate({text}, {_quoted(P.CHARS_FROM)}, {_quoted(P.CHARS_TO)}), chr(173) || chr(65279), '')"
    for a, b in P.FULL_WIDTH:
        text = f"replace({text}, {_quoted(a)}, {_quoted(b)})"
    for pattern, put in P.SPACING:
        text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(put.replace('$', chr(92)))}, 'g')"
    return text


_WIDE = "'“' || p_name || '”  ，（' || p_size || '） № ' || p_partkey || ' ：Τίτυο' || chr(173) || ' Αrt． 2ㅇ … “a” ！ ' || p_size || ' / 3 de ' || p_size || ' 0 % dias,contados.Fim'"


@query(f"SELECT p_partkey, {_plain_sql(_WIDE)} AS text FROM part")
def plain_forms(spark, sf):
    wide = F.concat(F.lit("“"), "p_name", F.lit("”  ，（"), "p_size", F.lit("） № "), "p_partkey", F.lit(" ：Τίτυο­ Αrt． 2ㅇ … “a” ！ "), "p_size", F.lit(" / 3 de "), "p_size", F.lit(" 0 % dias,contados.Fim"))
    return spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", P.plain_forms(wide).alias("text"))


@query(rf"""
    WITH t AS (SELECT p_partkey, repeat('Art. ' || p_size || ' - x' || chr(10), CAST(p_partkey % 12 AS INTEGER)) AS text FROM part)
    SELECT p_partkey, CASE WHEN len(regexp_extract_all(lower(text), {_quoted(P.ARTICLE)})) >= 8 THEN 'normative' ELSE 'generic' END AS class FROM t""")
def text_class(spark, sf):
    text = F.repeat(F.concat(F.lit("Art. "), "p_size", F.lit(" - x\n")), (F.col("p_partkey") % 12).cast("int"))
    return table(spark, sf, "part").select("p_partkey", P.text_class(text).alias("class"))
