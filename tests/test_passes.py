"""Before and after of each line pass, tables and quotations among them."""

import pytest
from pyspark.sql import functions as F

from sieveline.functions import passes as P

CASES = [
    (P.without_stamps, "Art. 1 assinado eletronicamente\nAssinado eletronicamente por X\n12345678\ntexto\n| a | assinado eletronicamente |\n> Página 2 de 3\nI - Página 2 de 3\nPágina 2 de 3", "Art. 1 assinado eletronicamente\ntexto\n| a | assinado eletronicamente |\n> Página 2 de 3\nI - Página 2 de 3"),
    (P.without_page_numbers, "a palavra\n\n12\n\ncontinua aqui\n7\nFim", "a palavra continua aqui\nFim"),
    (P.without_page_numbers, "termina.\n12\nOutra\n\n\n3\n4\n", "termina.\nOutra\n\n\n"),
    (P.without_page_numbers, "12\nOutra\n> cita,\n5\nlower\nabc\n6\n| t |", "Outra\n> cita,\nlower\nabc\n| t |"),
    (P.put_together, "Art.\n5º\n- Fica", "Art. 5º - Fica"),
    (P.put_together, "## TÍTULO\nI\nDa x", "## TÍTULO I\nDa x"),
    (P.put_together, "Art. 5º\n\ntexto\n§ 2º -\nminha", "Art. 5º - texto\n§ 2º - minha"),
    (P.put_together, "da Lei n.\nº\n9096/95", "da Lei n.º 9096/95"),
    (P.put_together, "no mínimo\n20%\n(vinte)", "no mínimo 20% (vinte)"),
    (P.put_together, "| Art. |\n5º\n> no mínimo\n20%\n\n\nx", "| Art. |\n5º\n> no mínimo\n20%\n\n\nx"),
    (P.ordinal_style, "Art. 7 0º - x\nArt. 3 - y no art. 12º\nI- z\na)w\n§ 2 - k\n| I- z |\nArt. 5-A - m\nParágrafo 3 - o", "Art. 70 - x\nArt. 3º - y no art. 12\nI - z\na) w\n§ 2º - k\n| I- z |\nArt. 5º-A - m\nParágrafo 3 - o"),
    (P.named_headings, "## CAPÍTULO I -\n\nDos fins:", "## CAPÍTULO I — Dos fins"),
    (P.named_headings, "## CAPÍTULO I\n# TÍTULO II\n# Nome;\n# TÍTULO III\nArt. 1 - x", "## CAPÍTULO I\n# TÍTULO II — Nome\n# TÍTULO III\nArt. 1 - x"),
    (P.bare_headings, "# Nome;.\ntexto;", "# Nome\ntexto;"),
    (P.levelled_headings, "### Nome\n# TÍTULO I\n# CAPÍTULO I\n# Art. 5 x\n#### Outro", "# Nome\n## TÍTULO I\n### CAPÍTULO I\nArt. 5 x\n### Outro"),
    (lambda c: P.cut_scope(c)["text"], "Relator: A\nRequerente: B\nESTATUTO\na b c d\ne f g h\ni j k l\nm n o p\nCertidão\n", "ESTATUTO\na b c d\ne f g h\ni j k l\nm n o p"),
    (lambda c: P.cut_scope(c)["text"], "Prefácio\nESTATUTO\na b c d\nFIM GERAL", "Prefácio\nESTATUTO\na b c d\nFIM GERAL"),
    (lambda c: P.cut_scope(c)["text"], "Relator: A\nRequerente: B\n# PARTIDO X\n\n## Τίτυlο I\nArt. 1º - a\nArt. 2 - b\na) c\n\nI - d\nJoão Silva\nCartório de registro", "# PARTIDO X\n\n## Τίτυlο I\nArt. 1º - a\nArt. 2 - b\na) c\n\nI - d"),
    (P.image_lines, "a\n[IMAGEM n=1] x\n\n\n\nb ", "a\n\nb"),
    (P.plain_forms, "（a）：“b” , c", ' (a):"b", c'),
    (P.plain_forms, "2 / 3 e 5 0% dos dias,contados em vigor.Artigo", '2/3 e 50% dos dias, contados em vigor. Artigo'),
    (P.put_together, "", ""),
    (P.put_together, "\n\n", "\n\n"),(P.put_together, "\n a \n", "\n a \n"),(P.put_together, None, None),(lambda c: P.cut_scope(c)["text"], "", ""),
]


@pytest.mark.parametrize("at", range(len(CASES)))
def test_pass(spark, at):
    column, before, after = CASES[at]
    assert spark.createDataFrame([(before,)], "v string").select(column(F.col("v"))).first()[0] == after


@pytest.mark.parametrize("column", [P.without_stamps, P.without_page_numbers, P.put_together, P.ordinal_style, P.named_headings, P.bare_headings])
def test_tables_and_quotations_stay(spark, column):
    text = "| Art. |\n> 12\n| 12 |\n> Assinado eletronicamente\n[TABELA] I- x;\n> I- x;"
    assert spark.createDataFrame([(text,)], "v string").select(column(F.col("v"))).first()[0] == text


def test_a_long_text_is_linear(spark):
    text = "Art.\n5º\n- Fica\nno mínimo\n20%\n(vinte)\n\n" * 20_000
    found = spark.createDataFrame([(text,)], "v string").select(P.put_together("v")).first()[0]
    assert found == "Art. 5º - Fica\nno mínimo 20% (vinte)\n\n" * 20_000


def test_statutes_are_dealt_to_many_tasks(spark):
    """The table is one small file, and one task would make and read all texts."""
    from sieveline.plans.passes import statutes

    assert statutes(spark, "/root/testdata/sf0.01").select(F.spark_partition_id()).distinct().count() >= 4 * spark.sparkContext.defaultParallelism


def test_cheaper_looks_find_what_the_patterns_find(spark):
    odd = ["", " \x0b\t| a", "\x0c> x", " [TABELA]", "[TABELA", "a | b", "\t## Nome ", "##x", "# ", "#", "x # y", "  ####### z", " a ", "Art", "art. 5", "PARÁGRAFO", "Seção", "º", "7 -", "§", "Ç|", "I - x", "20%", " # Título"]
    row = lambda x: (P.guarded(x) == x.rlike(P.GUARDED)) & (P.hashed(x) == x.rlike(P.HASHES)) & (P.trimmed(x) == F.regexp_replace(x, r"^\s+|\s+$", ""))
    assert not spark.createDataFrame([(x,) for x in odd], "v string").where(~row(F.col("v"))).collect()
