"""Top-k search, filter audit and whitening against brute force and on odd rows."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import filter_audit, queries, top_k, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>"


# op 11
def brute_top(rows, every, k):
    """rows: (id, vector). Every pair in whole numbers of any size."""
    ok = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (i, q) in enumerate(ok):
        if i is not None and i % every == 0:
            scores = [(min(max(sum(a * b for a, b in zip(q, v, strict=False)), -(2**63)), 2**63 - 1), j) for other, (j, v) in enumerate(ok) if other != at]
            scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
            out += [(i, rank, j, s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def vectors(n, width, seed, held=1.0):
    r = random.Random(seed)
    return [(k, [r.gauss(0, 0.1) if r.random() < held else 0.0 for _ in range(width)]) for k in range(n)]


ODD = {
    "dense": vectors(300, 24, 1),
    "sparse": vectors(300, 60, 2, 0.08),
    "ties and copies": [(k, v) for k in range(200) for v in [[0.5, 0.25, -0.5 * (k % 3)]]] + [(0, [0.5, 0.25, 0.0])] * 3 + [(50, [2.0, 0.0, 0.0])],
    "odd": [(None, [1.0, 1.0]), (None, [1.0, 1.0]), (0, None), (0, []), (50, [1.0, None]), (100, [float("nan"), 1.0]), (150, [float("inf"), 1.0]), (200, [1.0]), (-50, [0.3, 0.1, 9.0]), (1, [-1.0, 2.0, 0.5, 7.0])],
    "large": [(0, [1e9, 1.0]), (1, [1e12, -3.0]), (2, [-1e9, 0.1]), (50, [3e4, 3e4]), (3, [1e4, 1e5])],
    "larger than longs": [(0, [1e300, 1.0]), (1, [1e18, -3.0]), (2, [-1e300, 0.1]), (50, [0.1, 1e-3]), (3, [0.0, 5.0])],
    "few": [(0, [1.0]), (7, [2.0])],
    "one": [(0, [1.0])],
    "none": [],
}


@pytest.mark.parametrize("name", ODD)
def test_top_k_equals_all_pairs(spark, monkeypatch, name):
    """Blocks of a few rows, so that several meet."""
    monkeypatch.setattr(top_k, "CANDIDATES", 900)
    monkeypatch.setattr(top_k, "QUERIES", 60)
    df = spark.createDataFrame(ODD[name], VECTORS).select("*", *[F.lit("clash").alias(c) for c in "block q row v own score rank place".split()]).repartition(3)
    got = sorted((tuple(r) for r in top_k.top_k(df, F.col("vec_id") % 50 == 0).collect()), key=str)
    assert got == brute_top(ODD[name], 50, 5)


def test_postings_of_any_kind():
    r = np.random.default_rng(5)
    for held in (0.05, 0.9):
        m = np.where(r.random((50, 20)) < held, r.integers(-300, 300, (50, 20)), 0).astype(float)
        for kind in (1.0, 2.0**40, 2.0**70):
            whole = top_k.whole(m, kind)
            assert (top_k.in_longs(top_k.Postings(whole).scores(whole[3])) == (m @ m[3])).all()
            scores = top_k.in_longs(whole @ whole[3])
            want = sorted(range(50), key=lambda p: (-scores[p], p))
            assert all(list(top_k.best(scores, k)) == want[:k] for k in (1, 7, 50, 60))


# op 12
def brute_audit(docs, labels):
    """docs: (doc_id, text, lang). Filter by filter over the documents that are left."""
    good, toxic = ({i for i, *marks in labels if marks[k] == 1 and i is not None} for k in (0, 1))
    found = []
    for i, t, lang in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": any(j is not None and i is not None and j < i and (u or "") == t for j, u, _ in docs),
        }
        found.append((lang or "", {f for f in fails if fails[f]}, i in good, i in toxic))
    out = []
    for part in {p for p, *_ in found}:
        own, rows = [x for x in found if x[0] == part], []
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                redundant = sum(f in x[1] for x in own) - len(gone)
                rows.append([part, "".join(order), step, len(left), len(gone), redundant, sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone), f])
        total = {f: sum(r[4] for r in rows if r[-1] == f) for f in "ABCDE"}
        out += [(*r[:-1], total[r[-1]]) for r in rows]
    return sorted(out)


def audit_docs():
    r = random.Random(3)
    text = lambda n, m: " ".join(r.choice(["word", "Ü", "über", "x" * 9, "x" * 17, "A", "BIG"]) + str(r.randrange(m)) for _ in range(n))
    texts = [None, "", "", " \n\t", "A", "é", "漢字 " * 300, "a\0 a a\0 a", "loop " * 500, "cash $ " * 3] + [text(n, m) for n in (3, 150, 199, 200, 201, 700) for m in (2, 20, 4000)]
    texts += ["é" * 97 + "AAA", "é" * 96 + "AAAA", " ".join(f"{k % 100}" for k in range(200)), " ".join(f"{k % 99}" for k in range(200))]
    texts += texts[5:20] + [texts[12]] * 40 + ["y" * 5000 + " " + "z " * 3000 + "y" * 5000, "same same " + "same" * 2000]
    docs = [(k, t, None if k % 11 == 0 else ["en", "de", ""][k % 3]) for k, t in enumerate(texts)]
    return docs + [docs[12], docs[40], (None, texts[12], "en"), (None, None, None), (3, texts[13], "en")]


@pytest.mark.parametrize("base", [filter_audit.BASE, 1])
def test_audit_equals_filtering(spark, monkeypatch, base):
    """Once with a hash that is the same for all words of the same letters, and texts longer than a piece."""
    monkeypatch.setattr(filter_audit, "PIECE", 1500)
    docs, labels = audit_docs(), [(k, k % 2, int(k % 5 == 0)) for k in range(0, 70, 2)] + [(4, 1, 1), (4, 0, None), (6, None, None), (None, 1, 1)]
    clashes = [F.lit("clash").alias(c) for c in "part fails digest good toxic n least first mask".split()]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").select("*", *clashes).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filter_audit.interactions(filter_audit.masks(filter_audit.facts(d, base=base), marks))
    assert sorted(map(tuple, rows.collect())) == brute_audit(docs, labels)


def test_audit_of_nothing(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert filter_audit.filter_audit(nothing, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


# op 13
def brute_whitening(rows, most):
    """rows: (id, vector). In double precision over the whole table, deviations in whole numbers."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    exact = [[n * c - s for c, s in zip(row, sums, strict=True)] for row in x]
    off = np.array([[c / n for c in row] for row in exact])
    e, u = np.linalg.eigh(off.T @ off / n)
    e, u = e[::-1], u[:, ::-1]
    return [sum(c * c for c in row) for row in exact], (off @ u / np.sqrt(np.abs(e)))[:, :most], e / e.sum()


def held(df, n, most):
    rows = sorted(df.collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert len(rows) == n * most and {r["component"] for r in rows} == set(range(1, most + 1)) and {r["n"] for r in rows} == {n}
    return rows, np.array([r["whitened"] for r in rows]).reshape(n, most)


@pytest.mark.parametrize("table", ["sf", "narrow", "far off"])
def test_whitening(spark, table):
    r = np.random.default_rng(4)
    mixed = r.normal(size=(400, 6)) @ r.normal(size=(6, 6))
    rows = {
        "sf": lambda: [(x["vec_id"], list(x["embedding"])) for x in spark.read.parquet(f"{SF}/embeddings.parquet").collect()],
        "narrow": lambda: [(k, list(map(float, v))) for k, v in enumerate(mixed)],
        "far off": lambda: [(k, [float(a) * 1e9 for a in v]) for k, v in enumerate(mixed)],
    }[table]()
    width, most = len(rows[0][1]), min(32, len(rows[0][1]))
    got, w = held(whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(3)), len(rows), most)
    deviation, want, share = brute_whitening(rows, most)
    assert [x["deviation"] for x in got[::most]] == [d if d < 2**63 else None for d in deviation]
    signs = np.sign((w * want).sum(axis=0))
    assert np.abs(w * signs - want).max() < 1e-8 * width
    assert all(x["explained"] == pytest.approx(share[x["component"] - 1], rel=1e-9) for x in got)
    assert {x["identity_error"] for x in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9
    assert np.abs(np.cov(w.T, bias=True) - np.eye(most)).max() < 1e-9


def test_whitening_of_odd_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 1.0]), (2, [2.0, 2.0, 1.0]), (None, [4.0, 2.0, 9.0])]
    odd = [(5, None), (6, []), (7, [1.0, None, 2.0]), (8, [1.0, float("nan"), 2.0]), (9, [float("inf"), 1.0, 1.0]), (10, [1.0, 1.0]), (11, [1e30, 1.0, 1.0])]
    clashes = [F.lit("clash").alias(c) for c in "x at w n component deviation row".split()]
    got = whitening.whiten(spark.createDataFrame(rows + odd, VECTORS).select("*", *clashes)).collect()
    assert len(got) == 12 and {r["n"] for r in got} == {4} and sum(r["vec_id"] is None for r in got) == 3
    flat = [r for r in got if r["component"] == 3]  # the second entry never varies
    assert {r["whitened"] for r in flat} == {0.0} and {r["identity_error"] for r in got} == {1.0}
    assert sum(r["explained"] for r in got if r["vec_id"] == 1) == pytest.approx(1)
    one = whitening.whiten(spark.createDataFrame(rows[:1], VECTORS)).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(k, 0, 0.0, 0.0, 1.0) for k in (1, 2, 3)]
    for none in ([], odd[:5]):
        assert whitening.whiten(spark.createDataFrame(none, VECTORS)).count() == 0


def test_queries_read_the_tables(spark):
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert queries.op13_whitening(spark, SF).count() == 32 * n and queries.op11_top_k(spark, SF).count() == 5 * n // 50
