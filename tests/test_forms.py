"""Math spans as before/after texts, paths against a loop, sketches and quotas against exact counts."""

import random

import pytest
from pyspark.sql import functions as F

from sieveline.functions import extract as E
from sieveline.functions import text as T
from sieveline.operators import domain as D
from sieveline.operators import groups as G
from sieveline.operators import sketches as K


@pytest.mark.parametrize(
    ("before", "after"),
    [
        (r"cerca de $12,5 \%$ do total", "cerca de 12,5% do total"),
        (r"no $5^{\circ}$ e no $6 ^ \circ$ dia, $3^{a}$ vez, $2^o$", "no 5º e no 6º dia, 3ª vez, 2º"),
        (r"art. 7^{\circ} e art. 8^\circ", "art. 7º e art. 8º"),
        (r"$\frac{1}{3}$ dos votos, $\frac{\text{voto}}{2}$", "1/3 dos votos, voto/2"),
        (r"inciso $\mathrm{IV}$ e $XII$ e $ V $", "inciso IV e XII e V"),
        (r"$\S\,2^{\circ}$", "§ 2º"),
        (r"$10^{\prime}$ e $20^{\prime\prime}$", "10′ e 20″"),
        (r"pagou R$ 10,00 e R$ 20,00 de multa", "pagou R$ 10,00 e R$ 20,00 de multa"),
        ("custa $10 e $20", "custa $10 e $20"),
        (r"$\alpha_{1} + 5^{\circ}$ fica, $5\%$ sai", r"$\alpha_{1} + 5^{\circ}$ fica, 5% sai"),
        (r"$\text{a}\ldots$ e $2 \times 3$", r"a… e $2 \times 3$".replace(r"$2 \times 3$", "2 × 3")),
        ("um $ só\ne outro $ só", "um $ só\ne outro $ só"),
        ("", ""),
        (None, None),
    ],
)
def test_math_spans(spark, before, after):
    rows = spark.createDataFrame([(before,)], "t string").select(T.latex_plain("t").alias("a"), T.latex_plain(T.latex_plain("t")).alias("b")).first()
    assert rows["a"] == after and rows["b"] == after


def test_paths_that_collide_are_told_apart(spark):
    long, number = "x" * 300, " 0000001-02.2020.6.01.0001"
    names = ["a.pdf", "b.pdf", long + "1.pdf", long + "2.pdf", long.upper() + "3.PDF", long + "4" + number + ".pdf", long + "5" + number + ".pdf", "x" * 255 + ".pdf", "x" * 249 + " (2).pdf", long + "6.pdf"]
    rows = spark.createDataFrame([(k, "d", n, "kept") for k, n in enumerate(names)] + [(50, "e", long + "1.pdf", "kept")], "k long, folder string, name string, other string")
    got = {x["k"]: x["path"] for x in D.distinct_paths(rows, "k", "folder", "name").collect()}
    assert len(got) == 11 and len({p.lower() for p in got.values()}) == 11 and max(map(len, got.values())) <= 259
    assert got[0] == "d/a.pdf" and got[8] == "d/" + names[8] and got[2] == "d/" + "x" * 253 + ".pdf"
    assert got[3].startswith("d/xx") and " (2-" in got[3] and got[4].endswith(" (3).PDF")
    assert got[5].endswith(number + ".pdf") and got[6].endswith(" (2)" + number + ".pdf")
    assert D.distinct_paths(rows.limit(0), "k", "folder", "name").count() == 0
    assert rows.select(E.shortened("folder", "name").alias("p")).where("length(p) > 259").count() == 0


def test_inventories_add_up(spark):
    """A value in several files counts once; nulls count in n only; the estimate is near the exact number of values."""
    r = random.Random(5)
    rows = [(r.randrange(3), r.choice(["p", "q", None]), r.randrange(20_000), r.randrange(100)) for _ in range(30_000)] + [(0, "p", None, None)]
    df = spark.createDataFrame(rows, "f long, p string, v long, a long")
    made = K.inventory(df, F.col("f"), F.col("p"), "v", "a")
    assert made.select("id").distinct().count() == made.count() == 9
    for x in K.periods(made).collect():
        own = [t for t in rows if t[1] == x["period"]]
        exact = len({t[2] for t in own} - {None})
        assert (x["n"], x["total"]) == (len(own), sum(t[3] or 0 for t in own)) and abs(x["different"] - exact) <= 0.08 * exact


def test_quota_looks_at_all_rows(spark):
    """The refill comes from rows far down."""
    rows = [(k, k < 990) for k in range(1000)]
    got = G.quota(spark.createDataFrame(rows, "k long, c boolean"), [F.col("k")], F.col("c"), 6, 20).collect()
    assert sorted((x["place"], x["k"]) for x in got) == [(n, k) for n, k in enumerate([*range(6), *range(990, 1000), *range(6, 10)], 1)]


def test_paths_are_numbered_once(spark):
    """The numbering stands in no plan any more; three uses would each do it again."""
    rows = spark.createDataFrame([(k, "f", "x" * 300 + ".pdf") for k in range(5)], "k long, folder string, name string")
    found = D.distinct_paths(rows, "k", "folder", "name")
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.select("path").distinct().count() == 5
