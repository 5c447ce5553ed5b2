"""Joins by likeness, containment and edit distance against all pairs."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from sieveline.operators import similar as S


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def phrases(n, words, most, seed):
    r = random.Random(seed)
    return [" ".join(r.choice(words) for _ in range(r.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("least", [0.3, 0.5, 0.8, 1.0])
def test_most_alike_is_all_pairs(spark, least):
    left = phrases(60, "ab cd ef gh ij kl".split(), 7, 1) + ["ab cd ef", " \t", "x" * 300, None, "ab ab ab ab", "cd ef"]
    right = phrases(60, "ab cd ef gh ij kl".split(), 7, 2) + ["ab cd ef", "", "x" * 300, "x" * 300, None, "ab ab ab"]
    a = spark.createDataFrame([(k % 2, k, t) for k, t in enumerate(left)], "g long, k long, t string")
    b = spark.createDataFrame([(k % 2, 1000 - k, t) for k, t in enumerate(right)], "g long, c long, o string")
    want = {}
    for k, t in enumerate(left):
        for c, o in enumerate(right):
            if k % 2 == c % 2 and t is not None and o is not None:
                ratio = round((SequenceMatcher(None, t.split(), o.split(), autojunk=False).ratio() if t != o else 1.0) + 0.05 * (t in o or o in t), 6)
                if ratio >= least:
                    want[k] = min(want.get(k, (9, 0)), (-ratio, 1000 - c))
    got = {r["k"]: (-r["ratio"], r["c"]) for r in S.most_alike(a, b, ["g"], "t", "o", "k", "c", least).collect()}
    assert got == want


def test_most_alike_of_a_large_group(spark):
    """One group of 100,000 rows on either side: 10,000,000,000 pairs, of which only those with rare words in common are made."""
    words = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", i), F.lit(200_000)).cast("string")))
    text = F.concat_ws(" ", F.lit("of the"), F.array_join(words, " "))
    a = spark.range(100_000).select(F.lit(1).alias("g"), F.col("id").alias("k"), text.alias("t"))
    b = spark.range(100_000).select(F.lit(1).alias("g"), F.col("id").alias("c"), F.regexp_replace(text, " w[0-9]+$", " other").alias("o"))
    found = S.most_alike(a, b, ["g"], "t", "o", "k", "c", 0.7)
    assert found.where("k = c and ratio = 0.875").count() == 100_000


def test_beginnings_and_containment_are_all_pairs(spark):
    r = random.Random(3)
    text = lambda n: "".join(r.choice("abc") for _ in range(n))
    left = [text(r.randint(0, 9)) for _ in range(150)] + [None, "", "é漢", "a" * 500]
    right = [text(r.randint(0, 30)) for _ in range(60)] + [None, "", "xé漢y", "b" + "a" * 600, "b" + "a" * 600]
    a = spark.createDataFrame([(k % 3, k, t) for k, t in enumerate(left)], "g long, k long, t string")
    b = spark.createDataFrame([(c % 3, 500 - c, f) for c, f in enumerate(right)], "g long, c long, f string")
    want = {}
    for k, t in enumerate(left):
        for c, f in enumerate(right):
            if k % 3 == c % 3 and t is not None and f is not None and t in f:
                want[k] = min(want.get(k, (0, 0)), (-2 if f.startswith(t) else -1, 500 - c))
    assert {x["k"]: (-x["score"], x["c"]) for x in S.by_prefix(a, b, ["g"], "t", "f", "k", "c").collect()} == want


def test_best_match_is_all_pairs(spark, monkeypatch):
    """Names at all distances, short and long ones, ties, and blocks of a few names."""
    monkeypatch.setattr(S, "BLOCK", 7)
    r = random.Random(4)
    text = lambda n: "".join(r.choice("abcd") for _ in range(n))
    listed = [text(r.randint(0, 14)) for _ in range(60)] + [None, "é漢字", "a" * 80]

    def typed(t):
        t = list(t)
        for _ in range(r.randint(0, 4)):
            at = r.randint(0, len(t))
            t[at : at + r.randint(0, 1)] = r.choice(["", "a", "x"])
        return "".join(t)

    names = [typed(r.choice(listed) or "") for _ in range(150)] + [None, "", "zzzzzzzzzzzzzzzzzzzz", "é字"]
    got = S.best_match(spark.createDataFrame(list(enumerate(names)), "k long, name string"), "name", spark.createDataFrame(list(enumerate(listed)), "o long, listed string"), "listed", "o").collect()
    want = {k: min((edits(n, x), o, x) for o, x in enumerate(listed) if x is not None) if n is not None else None for k, n in enumerate(names)}
    assert {x["k"]: (x["distance"], x["match"]) if x["match"] is not None else None for x in got} == {k: (w[0], w[2]) if w else None for k, w in want.items()}
    assert len(got) == len(names)


def test_best_match_of_a_long_list(spark):
    """50,000 listed names and as many mistyped ones."""
    name = F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 24)
    listed = spark.range(50_000).select("id", name.alias("n"))
    typed = spark.range(50_000).select("id", F.overlay(name, F.lit("-"), F.lit(9), F.lit(1)).alias("t"))
    found = S.best_match(typed, "t", listed, "n", "id")
    assert found.where(F.col("distance") == 1).count() >= 49_900 and found.count() == 50_000


def test_joins_of_nothing(spark):
    none = spark.createDataFrame([], "g long, k long, t string")
    some = spark.createDataFrame([(1, 1, "a b")], "g long, c long, o string")
    assert S.most_alike(none, some, ["g"], "t", "o", "k", "c", 0.5).count() == S.by_prefix(none, some, ["g"], "t", "o", "k", "c").count() == 0
    assert [r["match"] for r in S.best_match(some, "o", none, "t", "k").collect()] == [None]
