"""Record reader, gates, trees and sums of alternative matches against plain loops."""

import datetime
import random
import time
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from sieveline.operators import gates, trees
from sieveline.operators import joins as J
from sieveline.sources import read_records


@pytest.mark.parametrize("bytes_a_split", [60, 500, 10**9])
def test_records_across_splits(spark, tmp_path, bytes_a_split):
    """A file in many splits; records longer than a split, and lines before the first record."""
    r, want = random.Random(1), []
    text = ["no record yet", ""]
    for k in range(120):
        more = [r.choice(["", "x" * r.randrange(30), "a line"]) for _ in range(r.choice([0, 0, 1, 3, 40 if k % 30 == 0 else 2]))]
        text += [f"{k}\tname {k}\tfirst", *more]
        want.append((str(k), f"name {k}", "\n".join(["first", *more])))
    (tmp_path / "a.tsv").write_text("\n".join(text))
    (tmp_path / "b.tsv").write_text("7\tb\tonly")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_a_split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert bytes_a_split > 500 or spark.read.text(str(tmp_path / "a.tsv")).rdd.getNumPartitions() > 4
        got = sorted(map(tuple, read_records(spark, str(tmp_path), ["k", "name", "body"]).collect()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted([*want, ("7", "b", "only")])


def test_changes_make_one_text_of_the_other(monkeypatch):
    """However small the stretches compared by blocks are: the words add up, and no more words are equal than a longest common subsequence has."""

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    r = random.Random(2)
    for small in (0, 20, 10**6):
        monkeypatch.setattr(gates, "SMALL", small)
        for _ in range(300):
            a = [f"w{r.randrange(r.choice([3, 40]))}" for _ in range(r.randrange(40))]
            b = [w for w in a if r.random() < 0.8]
            for _ in range(r.randrange(4)):
                b.insert(r.randrange(len(b) + 1), "new")
            found = list(gates.changes(a, b))
            assert sum(n for what, n, _ in found if what != "insert") == len(a) and sum(m for what, _, m in found if what != "delete") == len(b)
            assert sum(n for what, n, _ in found if what == "equal") <= common(a, b)
            if small > 100:
                assert gates.ratio(a, b) >= SequenceMatcher(None, a, b, autojunk=False).ratio() - 0.1


def test_a_million_words_take_seconds():
    r = random.Random(3)
    a = [f"w{r.randrange(200_000)}" for _ in range(1_000_000)]
    b = [w if r.random() < 0.99 else "typo" for w in a if r.random() < 0.95]
    began = time.time()
    assert 0.95 < gates.ratio(a, b) < 0.98 and time.time() - began < 60
    assert gates.ratio(["a"] * 300_000 + ["b"], ["c"] + ["a"] * 300_000) >= 0


def test_trees_are_plain_walks(spark):
    r = random.Random(4)
    parent = {k: None if k % 40 == 0 else r.randrange(max(0, k - 5), k) for k in range(300)}
    parent |= {1000: 1001, 1001: 1002, 1002: 1000, 1003: 1000, 1004: 1004, 2000: 9999, 2001: 2000}
    parent |= {3000 + k: 2999 + k if k else None for k in range(130)}
    want = {}
    for k in parent:
        at, depth = k, 0
        while parent[at] in parent and depth < 1000:
            at, depth = parent[at], depth + 1
        kind = "cycle" if depth == 1000 else "child" if depth else "root" if parent[k] is None else "orphan"
        want[k] = (None, None, kind) if kind == "cycle" else (at, depth, kind)
    rows = spark.createDataFrame([*parent.items(), (None, 5)], "k long, p long")
    assert {x["k"]: (x["root"], x["depth"], x["kind"]) for x in trees.rooted(rows, "k", "p").collect()} == want
    assert trees.rooted(rows.limit(0), "k", "p").count() == 0


def test_either_is_all_pairs(spark):
    r, day = random.Random(5), datetime.date(2020, 1, 1)
    rows = [(k, r.choice([None, "a", "b", "c"]), r.choice("xy"), r.random() < 0.3, None if r.random() < 0.1 else day + datetime.timedelta(r.randrange(30))) for k in range(200)]
    want = {}
    for k, a, b, near, d in rows:
        met = [j for j, x, y, _, e in rows if j != k and ((a is not None and (a, b) == (x, y)) or (near and d and e and 0 <= (d - e).days <= 3))]
        if met:
            want[k] = len(met), sum(met)
    df = spark.createDataFrame(rows, "k long, a string, b string, near boolean, day date")
    assert {x["k"]: (x["n"], x["key_sum"]) for x in J.either(df, "k", ["a", "b"], F.col("near"), "day", 3).collect()} == want


def test_clusters_broadcast_nothing(spark, monkeypatch):
    """What is broadcast goes through the driver, and labels grow with the links."""
    from sieveline.operators import groups as G

    links = spark.createDataFrame([(k, k + 1) for k in range(0, 60, 2)] + [(1, 2), (5, 4)], "a long, b long")
    plans, own = [], type(links).checkpoint
    monkeypatch.setattr(type(links), "checkpoint", lambda self, *a, **b: (own(self, *a, **b), plans.append(self._jdf.queryExecution().executedPlan().toString()))[0])
    found = dict(map(tuple, G.clusters(links).collect()))
    assert found[3] == 0 and found[59] == 58 and len(found) == 60
    assert len(plans) > 1 and not any("Broadcast" in p for p in plans)
