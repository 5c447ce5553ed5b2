"""Bit signatures, stored tables and weeks with a state against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline import streaming
from sieveline.operators import groups as G
from sieveline.operators import signatures as S
from sieveline.operators.stored import StoredTable


@pytest.mark.parametrize(("k", "hot"), [(1, 1000), (2, 1), (3, 1000), (3, 1), (5, 3)])
def test_near_signatures_are_all_pairs(spark, k, hot):
    """Groups of signatures a few bits around centers, copies, gaps of size; with every chunk hot and with none."""
    r, rows = random.Random(k * 100 + hot), []
    for center in [r.getrandbits(64) for _ in range(6)] + [0, 2**64 - 1]:
        for _ in range(25):
            sig = center
            for _ in range(r.randrange(k + 3)):
                sig ^= 1 << r.randrange(64)
            rows.append((r.choice("xy"), sig, r.choice([100, 105, 119, 121, 150, 400])))
    rows += [rows[0]] * 30
    signed = lambda s: s - 2**64 if s >= 2**63 else s
    comp = list(range(len(rows)))
    for _ in range(len(rows)):
        before = list(comp)
        for a, (g, s, n) in enumerate(rows):
            for b, (h, t, m) in enumerate(rows[:a]):
                if g == h and (s ^ t).bit_count() <= k and 100 * max(n, m) <= 121 * min(n, m):
                    comp[a] = comp[b] = min(comp[a], comp[b])
        if comp == before:
            break
    size = {c: comp.count(c) for c in comp}
    want = {a: c for a, c in enumerate(comp) if size[c] > 1}
    df = spark.createDataFrame([(a, g, signed(s), n) for a, (g, s, n) in enumerate(rows)] + [(900, None, 0, 100), (901, "x", None, 100), (902, "x", 0, None)], "id long, g string, sig long, n long")
    links = S.near_links(df, "id", "g", "sig", "n", k, hot=hot)
    assert {x["node"]: x["comp"] for x in G.clusters(links).collect()} == want
    assert S.near_links(df.limit(0), "id", "g", "sig", "n", k).count() == 0


def test_signatures_are_signs_of_sums(spark):
    r = random.Random(1)
    vectors = [[r.randrange(-300, 300) for _ in range(n)] for n in (64, 64, 10, 1, 0)] + [None]
    got = {x["k"]: x["s"] for x in spark.createDataFrame(list(enumerate(vectors)), "k long, v array<bigint>").select("k", S.signature(F.col("v")).alias("s")).collect()}
    for k, v in enumerate(vectors):
        if v is None:
            assert got[k] is None
            continue
        bits = 0
        for j in range(1, 65):
            sign = lambda i: 1 - 2 * ((((i * 40503 + j * 30011) * 2654435761) & 0xFFFFFFFF).bit_count() % 2)  # noqa: B023, E731
            bits |= (sum(x * sign(i) for i, x in enumerate(v, 1)) > 0) << j - 1
        assert got[k] % 2**64 == bits
    assert abs(np.corrcoef(S.planes(64).T) - np.eye(64)).max() < 0.7


def test_merges_write_only_parts_that_change(spark, tmp_path):
    stored = StoredTable(spark, str(tmp_path), "k bigint, v string", "k", part_of=F.floor(F.col("k") / 10))
    rows = lambda d: spark.createDataFrame(list(d.items()), "k bigint, v string")
    now = lambda v=None: {x["k"]: x["v"] for x in stored.read(v).collect()}
    assert now() == {} and stored.version() == 0
    one = {k: f"a{k}" for k in range(50)}
    assert stored.merge(rows(one)) == 5
    reader, files = stored.read(), set(tmp_path.glob("data/*/part=*/*.parquet"))
    assert stored.merge(rows({3: "b", 60: None})) == 2
    two = one | {3: "b", 60: None}
    new = set(tmp_path.glob("data/*/part=*/*.parquet")) - files
    assert now() == two and {p.parent.name for p in new} == {"part=0", "part=6"}
    dead = spark.createDataFrame([(k,) for k in [*range(10, 20), 25, 777, 26]], "k bigint")
    assert stored.merge(rows({26: "stays"}), dead) == 3
    three = {k: v for k, v in two.items() if not 10 <= k < 20 and k != 25} | {26: "stays"}
    assert now() == three and now(1) == one and now(2) == two
    assert stored.merge(rows({})) == 0 and stored.version() == 3
    assert {x["k"]: x["v"] for x in reader.collect()} == one
    rows({70: "x"}).write.parquet(str(tmp_path / "data" / "v4-broken" / "part=7"))  # a merge that broke off
    assert StoredTable(spark, str(tmp_path), "k bigint, v string", "k").read().count() == len(three)
    stored.vacuum()
    assert now(1) == one
    stored.vacuum(grace=0)
    assert now() == three
    with pytest.raises(ValueError, match="no snapshot 1"):
        stored.read(1)
    kept = {p.parent.name for p in tmp_path.glob("data/*/part=*/*.parquet")} - {"part=7"}
    assert kept == {"part=0", "part=2", "part=3", "part=4", "part=6"} and len(list(tmp_path.glob("data/*/part=0/*.parquet"))) == 1


def test_weeks_with_a_state_are_plain_counts(spark, tmp_path):
    """Three runs over one checkpoint, one of them without news, and rows without a time."""
    r, rows = random.Random(3), []
    for k in range(300):
        rows.append((k, f"2024-01-{1 + r.randrange(28):02d} 0{r.randrange(10)}:00:00" if k % 50 else None))
    runs, counts, root = [rows[:200], [], rows[200:260], rows[260:] + [(k, "2024-03-05 00:00:00") for k in range(300, 303)]], {}, str(tmp_path)
    for n, part in enumerate(runs, 1):
        spark.createDataFrame(part, "k long, t string").select("k", F.to_timestamp("t").alias("t")).write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema("k long, t timestamp").parquet(f"{root}/events")
        streaming.run_now(streaming.reported_weeks(stream, "t", "k", str(n), salts=3), root, streaming.appended_batches(f"{root}/log"))
        then = dict(counts)
        for k, t in part:
            if t:
                week = np.datetime64(t[:10]) - ((np.datetime64(t[:10]) - np.datetime64("2024-01-01")).astype(int) % 7)
                counts[str(week)] = counts.get(str(week), 0) + 1
        want = {w: (c, then.get(w)) for w, c in counts.items() if c != then.get(w)}
        got = {str(x["week"]): (x["n_now"], x["n_then"]) for x in streaming.stale_reports(spark.read.parquet(f"{root}/log"), str(n)).collect()}
        assert got == want
