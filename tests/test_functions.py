"""Literal cases of Column functions and operators, nulls and ties included."""

import datetime
import unicodedata

import pytest
from pyspark.sql import functions as F

from sieveline.functions import extract as E
from sieveline.functions import text as T
from sieveline.functions import values as V
from sieveline.operators import gates
from sieveline.operators import groups as G
from sieveline.operators import joins as J
from sieveline.operators import merge as M
from sieveline.operators import similar as S
from sieveline.sources import html_blocks, read_csv, zip_members


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first()[0]


@pytest.mark.parametrize(
    "column, value, wanted",
    [
        (T.aggressive_form, "Ça va, Ünïté 7!", "cavaunite7"),
        (T.aggressive_form, "Straße", "strae"),
        (T.match_key, "  Été   à la  mer. ", "ete a la mer."),
        (T.dehyphenate, "exem-\nplo and A-\nB", "exemplo and A-\nB"),
        (T.latex_plain, r"about $ 12,5 \% $ or $3^{o}$ or $\frac{1}{2}$ or $x$", "about 12,5% or 3º or 1/2 or $x$"),
        (T.latex_residue, r"$x$ and \alpha", 2),
        (T.no_images, "a\n![x](y.png)\n\n\n\nb", "a\n\nb"),
        (T.split_provisions, "end. Art. 5 starts; § 2 too", "end.\nArt. 5 starts;\n§ 2 too"),
        (T.collapse_doubled, "one two one two", "one two"),
        (T.collapse_doubled, "one two one", "one two one"),
        (T.repair_mojibake, "CafÃ© e aÃ§Ã£o", "Café e ação"),
        (lambda c: T.truncated(c, 12), "alpha, beta gamma", "alpha..."),
        (T.looks_unfinished, "signed by the", True),
        (T.title_case, "TRE and THE house", "TRE and the House"),
        (T.slug, " Ação Penal nº 5 ", "acao-penal-n-5"),
        (T.token_estimate, "", 1),
        (T.clean, "  ", None),
        (V.any_date, "31/12/1999", datetime.date(1999, 12, 31)),
        (V.any_date, "12/31/1999", datetime.date(1999, 12, 31)),
        (V.any_date, "02/03/2001", datetime.date(2001, 3, 2)),
        (lambda c: V.any_date(c, False), "02/03/2001", datetime.date(2001, 2, 3)),
        (V.any_date, "31/02/2001", None),
        (V.month_first, "not a date", "not a date"),
        (V.written_date, "Em 12 de março de 1935.", datetime.date(1935, 3, 12)),
        (V.case_number, "12345678920206010123", "1234567-89.2020.6.01.0123"),
        (V.case_number, "123", "123"),
        (V.thousands, "9504", "9.504"),
        (V.digits, " n/a ", "n/a"),
        (lambda c: V.year_in(c, 1990, 2026), "from 1889 to 1995 and 2001", 1995),
        (lambda c: F.array_join(V.listed(c), "|"), "Civil, penal; PENAL,, civil", "Civil|penal"),
        (lambda c: F.array_join(V.prefixes(c), " "), "a/b//c", "a a/b a/b/c"),
        (lambda c: F.array_join(V.urls(c), " "), "see https://a.example/x). and https://a.example/x", "https://a.example/x"),
        (lambda c: V.json_in(c, "k int")["k"], 'so {"k": 3} it is', 3),
        (lambda c: V.band(c.cast("int"), [(9, "a"), (7, "b")], "c"), "7", "b"),
        (lambda c: V.label(c, F.lit("SP")), " ", "SP"),
        (T.quality_alert, "A text that breaks off and", "check"),
        (lambda c: V.json_in(c, "a struct<b:int>, c int")["a"]["b"], 'so {"a": {"b": 1}, "c": 2} and {"a": 3}', 1),
        (V.first_object, "x {a {b} c} d}", "{a {b} c}"),
        (V.first_object, "no { end", None),
        (lambda c: F.array_join(E.legal_references(c), "|"), "art. 5º, § 2º, da Lei nº 9.504/97; arts. 1 do Decreto 10; art. 5, § 2, da Lei n. 9504/97", "art. 5º, § 2º, Lei nº 9.504/97|art. 1º, Decreto nº 10"),
        (lambda c: F.array_join(E.decisions(c), "|"), "ADI 5.394, REspe nº 12 e adi 1", "ADI 5394|REspe 12"),
        (lambda c: F.array_join(E.fuzzy_case_numbers(c), "|"), "0600123 - 45.2020 6.26 .0001 x 123", "0600123-45.2020.6.26.0001"),
        (E.roman, "MCMXCIV", 1994),
        (E.roman, "IIX", None),
        (E.device_label, "Artigo XII - b", "Art. 12-B"),
        (E.device_label, "caput", None),
        (E.dates_rewritten, "em 31/12/1999, 2001-02-03 e 31/02/2001", "em 12/31/1999, 2/3/2001 e 31/02/2001"),
        (E.bare_name, "Min. Dra. Ana Sá, OAB/DF 123", "Ana Sá"),
        (lambda c: F.array_join(E.bullets(c), "|"), "- a\n* b", "a|b|-"),
        (lambda c: F.array_join(E.whole_entities(F.split(c, ",")), "|"), "Ana,Ana Sá,SÁ,Rui, ana sá", "Ana Sá|Rui"),
        (lambda c: E.best_heading(c, 30), "O tribunal negou o pedido, por unanimidade, nos termos do voto do relator.", "O tribunal negou o pedido"),
        (lambda c: E.local_title(c, 60), "Página 1\nO recurso foi provido em parte.", "O recurso foi provido em parte"),
        (lambda c: F.array_join(E.lookup_terms([c, F.lit("b"), c, F.lit("long word")], 8), "|"), "a", "a|b"),
        (lambda c: F.array_join(F.transform(E.label_blocks(c, ["relator", "parte"]), lambda b: F.concat(b["label"], F.lit("="), b["text"])), "|"), "x Relator: A B; PARTE: C relator:", "relator=A B|parte=C"),
        (lambda c: E.shortened(F.lit("d"), c, 40), "nome muito longo de arquivo 0000001-02.2020.6.01.0001.pdf", "d/nome mui 0000001-02.2020.6.01.0001.pdf"),
    ],
)
def test_column(spark, column, value, wanted):
    assert one(spark, value, column) == wanted


def test_letters(spark):
    df = spark.createDataFrame([(k,) for k in (0, 25, 26, 701, 702, 18277)], "k int").select("k", G.letters(F.col("k")).alias("l"))
    assert dict(map(tuple, df.collect())) == {0: "a", 25: "z", 26: "aa", 701: "zz", 702: "aaa", 18277: "zzz"}


def test_sniffed_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿x,y\ncafé,1\n".encode())
    (tmp_path / "b.csv").write_bytes("y;z\n2;ação – €\n".encode("cp1252"))
    got = read_csv(spark, str(tmp_path)).fillna("")
    assert sorted(tuple(r) for r in got.select("x", "y", "z").collect()) == [("", "2", "ação – €"), ("café", "1", "")]


def test_orphan_suffixes_and_names(spark):
    files = spark.createDataFrame([(1, "f", "a (2)"), (2, "f", "b (2)"), (3, "f", "b"), (4, "f", "c (3)"), (5, "f", "c (2)"), (6, "g", "a")], "id int, folder string, name string")
    assert rows(J.without_orphan_suffixes(files, ["folder"], "name", "id").select("id", "name"), "id") == [(1, "a"), (2, "b (2)"), (3, "b"), (4, "c"), (5, "c (2)"), (6, "a")]
    left = spark.createDataFrame([("p1", "n1"), ("px", "n2"), ("py", "n3"), ("pz", "n3"), ("pw", "n4")], "path string, name string")
    right = spark.createDataFrame([("p1", "n9", 1), ("q2", "n2", 2), ("q3", "n3", 3), ("q4", "n4", 4), ("q5", "n4", 5)], "path string, name string, v int")
    assert rows(J.exact_else_unique(left, right, "path", "name", "v").select("path", "v"), "path") == [("p1", 1), ("pw", None), ("px", 2), ("py", None), ("pz", None)]


def test_fold_is_nfd():
    table = dict(zip(*T._fold_table(), strict=True))
    assert table["é"] == "e" and "ß" not in table
    assert all(unicodedata.normalize("NFD", c)[0] == b for c, b in table.items())


def test_headers():
    assert T.clean_headers(["﻿a", "a", None, "a", ""]) == ["a", "a_2", "column", "a_3", "column_2"]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_keepers_break_ties_by_key(spark):
    df = spark.createDataFrame([(3, "x", 1), (1, "x", 1), (2, "x", 0), (4, None, 1), (5, None, 2)], "id int, g string, s int")
    assert rows(G.keepers(df, ["g"], [F.desc("s")], "id"), "loser") == [(2, 1, "x"), (3, 1, "x"), (4, 5, None)]


def test_greedy_bins(spark):
    df = spark.createDataFrame([("g", k, n) for k, n in enumerate([3, 4, 5, 9, 1])], "g string, k int, n int")
    assert [r["bin"] for r in G.greedy_bins(df, ["g"], ["k"], "n", 7, before=False).orderBy("k").collect()] == [0, 0, 1, 1, 2]
    assert [r["bin"] for r in G.greedy_bins(df, ["g"], ["k"], "n", 7, before=True).orderBy("k").collect()] == [0, 0, 1, 2, 3]


@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("target", [1, 30, 2000])
def test_greedy_bins_over_blocks(spark, monkeypatch, before, target):
    """Bins that cross blocks of seven rows are those of a plain fold."""
    import random

    r = random.Random(target)
    rows = [(r.choice(["hot", "hot", "hot", "b", None]), k, r.choice([0, 0, 1, 5, 9, 40])) for k in range(600)]
    want, state = {}, {}
    for g, k, n in rows:
        b, total = state.get(g, (0, 0))
        if before and total and total + n > target:
            b, total = b + 1, 0
        want[k], total = b, total + n
        state[g] = (b + 1, 0) if not before and total >= target else (b, total)
    monkeypatch.setattr(G, "BIN_ROWS", 7)
    got = G.greedy_bins(spark.createDataFrame(rows, "g string, k int, n int"), ["g"], ["k"], "n", target, before)
    found = got.withColumn("task", F.spark_partition_id()).collect()
    assert {x["k"]: x["bin"] for x in found} == want and len(found) == 600
    assert got.columns == ["g", "k", "n", "bin"]


def test_numbers_over_several_partitions(spark):
    df = spark.range(0, 1000, 1, 7).withColumnRenamed("id", "k")
    assert {r["k"]: r["nth"] for r in G.numbered(df, [F.desc("k")], "nth").collect()} == {k: 1000 - k for k in range(1000)}


def test_sentences_outside_parentheses(spark):
    for text, wanted in [
        ("One. Two (a. b (c. d) e. f) g. Three", ["One.", "Two (a. b (c. d) e. f) g.", "Three"]),
        ("An open ( one. Two. Three) four. Five", ["An open ( one. Two. Three) four.", "Five"]),
        ("A (b. C. D) e. F", ["A (b. C. D) e.", "F"]),
        ("A) b. C (d. E", ["A) b.", "C (d.", "E"]),
        ("", []),
        (None, None),
    ]:
        assert one(spark, text, T.whole_sentences) == wanted


def test_shrink_to_cuts_the_largest_first(spark):
    df = spark.createDataFrame([("g", 1, 100), ("g", 2, 50), ("g", 3, 10), ("h", 4, 5)], "g string, k int, n int")
    assert [r["allowed"] for r in G.shrink_to(df, ["g"], "n", 90, 5).orderBy("k").collect()] == [40, 40, 10, 5]


def test_chunks_cover_the_text():
    text = "One sentence here. Another one follows. " * 20 + "\n\n" + "word " * 300
    parts = G.chunks(text, 200, 40, 0)
    assert " ".join(parts).split() == text.split() and all(len(p) <= 240 for p in parts)
    assert G.chunks("", 200, 40, 20) == []


def test_protected_top(spark):
    df = spark.createDataFrame([(k, 10 - k, k in (8, 9)) for k in range(10)], "k int, s int, p boolean")
    assert [r["k"] for r in G.protected_top(df, F.col("p"), [F.desc("s")], 4).collect()] == [0, 1, 8, 9]


def test_missing_numbers(spark):
    df = spark.createDataFrame([("a", 2), ("a", 4), ("b", 1)], "g string, n int")
    assert rows(G.missing_numbers(df, ["g"], "n"), "g", "n") == [("a", 1), ("a", 3)]
    assert rows(G.missing_numbers(df, ["g"], "n", from_one=False), "g", "n") == [("a", 3)]


def test_clusters(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 101)], "a long, b long")
    assert {r["node"]: r["comp"] for r in G.clusters(links).collect()} == {k: 1 for k in range(1, 41)} | {100: 100, 101: 100}


def test_interval_equals_brute_force(spark):
    pts = spark.createDataFrame([(k, k * 3 % 50) for k in range(60)], "p int, d int").selectExpr("p", "date_add(date'2020-01-01', d) as at")
    rng = spark.createDataFrame([(k, k * 5 % 45, k % 9) for k in range(30)], "r int, a int, w int").selectExpr("r", "date_add(date'2020-01-01', a) as lo", "date_add(date'2020-01-01', a + w) as hi")
    got = {(r["p"], r["r"]) for r in J.interval(pts, rng, "at", "lo", "hi", 7).collect()}
    assert got == {(p, r) for p in range(60) for r in range(30) if r * 5 % 45 <= p * 3 % 50 <= r * 5 % 45 + r % 9}


def test_best_match_takes_the_first_of_ties(spark):
    left = spark.createDataFrame([("cat",), ("dgo",), (None,)], "n string")
    ref = spark.createDataFrame([("bat", 2), ("rat", 1), ("dog", 3)], "r string, o int")
    assert {r["n"]: r["match"] for r in S.best_match(left, "n", ref, "r", "o").collect()} == {"cat": "rat", "dgo": "dog", None: None}


def test_merge(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "d"), (4, "e")], "k int, v string")
    assert rows(M.two_phase(old, new, "k", ["v"]), "k") == [(1, "a", "archived"), (2, None, "kept"), (3, "d", "updated"), (4, "e", "inserted")]
    assert M.guarded_purge(old, new.limit(0), "k").count() == 3
    assert rows(M.upsert(old, new, "k"), "k") == [(1, "a"), (2, None), (3, "d"), (4, "e")]


def test_gates(spark):
    long = "word " * 40 + "12"
    df = spark.createDataFrame([(1, long, long + " "), (2, long, long + "3"), (3, long, "12"), (4, None, None)], "k int, a string, b string")
    assert [r["passed"] for r in gates.fidelity(df, "k", "a", "b").orderBy("k").collect()] == [True, False, False, False]
    cut = spark.createDataFrame([(1, "a b c d e", "a b c d"), (2, "a b c d e", "a b"), (3, "a b c", "a b c x")], "k int, a string, b string")
    assert [r["passed"] for r in gates.deletion_only(cut, "k", "a", "b").orderBy("k").collect()] == [True, False, False]


def test_html_blocks(spark):
    page = "<h1>Top</h1><p>one <b>two</b></p><h2>Sub</h2><script>no</script><ul><li>three</li></ul>"
    df = spark.createDataFrame([(1, page), (2, None)], "id int, html string")
    assert [tuple(r)[1:] for r in html_blocks(df, "id", "html").orderBy("nth").collect()] == [(0, "h1", "Top", "Top"), (1, "p", "Top", "one two"), (2, "h2", "Top > Sub", "Sub"), (3, "li", "Top > Sub", "three")]


def test_zip_members(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/ação.txt", "hello")
    assert [(r["member"], bytes(r["content"])) for r in zip_members(spark, str(tmp_path)).collect()] == [("x/ação.txt", b"hello")]


@pytest.mark.parametrize(("make", "times"), [(lambda c: V.unique(F.split(c, ",")), 1), (lambda c: E.whole_entities(F.split(c, ",")), 1), (lambda c: E.composition(c, c), 2), (lambda c: E.local_title(c, 60), 1)])
def test_what_is_compared_with_others_is_made_once(spark, make, times):
    """A list stands in the plan once for each time it is given, and isn't made again for each of its items or pairs of items."""
    plan = spark.createDataFrame([("a,b",)], "v string").select(make(F.lower("v")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("lower(v") == times
