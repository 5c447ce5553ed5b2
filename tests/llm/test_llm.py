"""The ten operators and the pipeline against brute force and on odd rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sieveline.llm import components, decontamination, exact_dedup, license_scan, line_dedup, mixing, near_dedup, pii, queries, shingles, substring_dedup, token_counts, toxicity
from sieveline.llm.common import bit_filter, maybe_in
from tests.oracle import spark_rows, sql_rows

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(3000)}" for _ in range(n)]


def corpus():
    """Null, empty, blank, tiny and long texts; copies, near copies, a shared passage, repeated rows."""
    base, passage = words(120, 1), words(60, 2)
    texts = [None, "", " \n\t", "one", "One", "two words", "a b c d", "A B  C D", " ".join(base), "  ".join(base) + " "]
    for k in range(30):
        near = list(base)
        for i in random.Random(k).sample(range(120), k // 4):
            near[i] = f"x{k}"
        texts.append(" ".join(near))
    for k in range(30):
        texts.append(" ".join(words(40, 100 + k) + passage + words(30, 200 + k)))
    texts += [" ".join(words(30000, 5)), "loop " * 200, "same line\n" * 30, "x" * 100_000, "é ß 漢字 " * 50]
    rows = [(k, t, "en", None if k % 7 == 0 else f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]
    return rows + [rows[8], rows[20]] + [(9000, "old text", None, "s1", 8), (9000, "old text", None, "s1", 8)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHES = "row h key rep size words line copy dropped n sk kept taken target epoch n_words leaf hs start fold mean d c a b".split()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5, "doc_id")


def odd(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


def labels_of(spark, docs):
    return docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic")).distinct()


OPERATORS = {
    "line": lambda s, d: line_dedup.line_dedup(d),
    "license": lambda s, d: license_scan.license_scan(d),
    "leaks": lambda s, d: decontamination.leaks(d, s.createDataFrame([(1, "one two three four five six"), (2, None), (3, "short")], "item_id long, text string")),
    "toxicity": lambda s, d: toxicity.score_toxicity(d, labels_of(s, d)),
    "mix": lambda s, d: mixing.mix(d),
    "near": lambda s, d: near_dedup.near_dedup(d),
    "substring": lambda s, d: substring_dedup.substring_dedup(d),
    "exact": lambda s, d: exact_dedup.exact_dedup(d),
    "pii": lambda s, d: pii.find_pii(d),
    "tokens": lambda s, d: d.select("doc_id", token_counts.rank_tokens(s, "byte_bpe_50k").alias("n")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, docs, name):
    whole = OPERATORS[name](spark, odd(docs))
    if name != "leaks":
        assert whole.count() == docs.count()
    nobody = spark.createDataFrame([], SCHEMA)
    assert OPERATORS[name](spark, odd(nobody)).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None), (None, "some text here", None, None, None)], SCHEMA)
    assert name == "leaks" or OPERATORS[name](spark, nulls).count() == 2


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_and_order_change_nothing(spark, docs, name):
    """The same values with extra columns of the operators' own names, and with the rows dealt otherwise."""
    rows = lambda d: sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in OPERATORS[name](spark, d).drop(*CLASHES, "size", "taken", "target").collect()), key=str)
    want = rows(docs)
    assert rows(odd(docs).repartition(2)) == want and (want or name == "leaks")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, SF)) == sql_rows(queries.SQL[name], SF)


# op 9
def test_exact_dedup_with_clashing_digests(spark, docs):
    """A digest of one hex digit clashes all the time; the texts still decide."""
    weak = lambda body: F.unhex(F.concat(F.lit("0"), F.substring(F.md5(body), 1, 1)))
    strong, forced = (spark_rows(exact_dedup.exact_dedup(docs, **kw)) for kw in ({}, {"digest": weak}))
    assert strong == forced
    groups = collections.defaultdict(list)
    for i, t, *_ in corpus():
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {i: (min(g), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}


def test_index_takes_batches_and_answers_lookups(spark, tmp_path):
    """Runs are compacted by levels; repeated batches and compaction change no answer; what no run holds is not found."""
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), memtable=50, fanout=3, filter_bits=18)
    r, want = random.Random(2), {}
    for k in range(10):
        batch = [(r.randrange(400), r.randrange(10**6)) for _ in range(120)]
        rows = spark.createDataFrame(batch, "d long, id long").select(F.unhex(F.md5(F.col("d").cast("string"))).alias("digest"), "id")
        for _ in range(2):  # the second time nothing changes
            index.append(f"b{k}", rows)
        for d, i in batch:
            low, n = want.get(d, (i, 0))
            want[d] = min(low, i), n + 1
    assert sorted(level for _, level, _ in index.runs()) == [0, 2] and index.batches() == {f"b{k}" for k in range(10)}
    asked = spark.range(800).select("id", F.unhex(F.md5(F.col("id").cast("string"))).alias("digest"))
    got = {x["d"]: (x["id"], x["n"]) for x in index.lookup(asked).join(asked.withColumnRenamed("id", "d"), "digest").collect()}
    assert got == want
    again = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), filter_bits=18)  # opened anew
    assert again.runs() == index.runs()


def test_batches_are_looked_up_in_the_runs_before(spark, tmp_path):
    """The hits of a batch are its digests that it holds twice or that an earlier run holds; lookups taken before a compaction go on; filters keep what runs read few."""
    index = exact_dedup.DigestIndex(spark, str(tmp_path / "index"), memtable=50, fanout=3, filter_bits=18)
    digests = lambda ids: spark.createDataFrame([(i, i) for i in ids], "d long, id long").select(F.unhex(F.md5(F.col("d").cast("string"))).alias("digest"), "id")
    name = {hashlib.md5(str(i).encode()).hexdigest(): i for i in range(400)}
    hits = lambda k: sorted(name[bytes(x["digest"]).hex()] for x in spark.read.parquet(str(tmp_path / f"hits-{k}")).collect())
    index.append("0", digests([1, 2, 3, 3]), str(tmp_path / "hits-0"))
    index.append("1", digests([2, 4]), str(tmp_path / "hits-1"))
    earlier = index.lookup(digests([1, 4, 9]))
    index.append("2", digests([*range(5, 200), 4]), str(tmp_path / "hits-2"))  # three runs become one
    index.append("3", digests([1, 250, 199]), str(tmp_path / "hits-3"))
    assert [hits(k) for k in range(4)] == [[3], [2], [4], [1, 199]]
    assert earlier.count() == 2 and sorted(level for _, level, _ in index.runs()) == [0, 1]
    run = spark.read.parquet(f"{index.root}/runs/{index.runs()[-1][0]}")
    likely = maybe_in(digests(range(150, 350)), "digest", spark.read.parquet(f"{index.root}/filters/{index.runs()[-1][0]}"), 18)
    assert run.count() == 199 and 50 <= likely.count() <= 60
    index.vacuum()
    assert earlier.count() == 2
    index.vacuum(grace=0)
    assert index.lookup(digests([1, 4, 9, 250, 300])).count() == 4 and len(list((tmp_path / "index" / "runs").iterdir())) == 2


def test_new_texts_against_an_index(spark, docs, tmp_path):
    weak = lambda body: F.unhex(F.concat(F.lit("0"), F.substring(F.md5(body), 1, 1)))
    new = spark.createDataFrame([(1, "A B C  D"), (2, " ".join(words(120, 1)) + " "), (3, "quite new"), (4, None), (5, "two\twords"), (5, "two words ")], "doc_id long, text string")
    low = {}
    for i, t, *_ in corpus():
        t = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        low[t] = min(i, low.get(t, i))
    want = sorted(((r["doc_id"], low.get(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""))) for r in new.collect()), key=str)
    for name, digest in (("strong", exact_dedup.sha256), ("weak", weak)):
        index = exact_dedup.DigestIndex(spark, str(tmp_path / name))
        index.append("all", docs.select(digest(exact_dedup.normalised()).alias("digest"), F.col("doc_id").alias("id")))
        assert sorted(map(tuple, exact_dedup.new_texts(index, docs, new, digest=digest).collect()), key=str) == want


def test_filter_holds_all_its_keys(spark):
    keys = spark.range(0, 4000, 2).withColumnRenamed("id", "k")
    found = {r["k"] for r in maybe_in(spark.range(4000).withColumnRenamed("id", "k"), "k", bit_filter(keys, "k", 18), 18).collect()}
    assert {r for r in range(0, 4000, 2)} <= found and len(found) < 2200


# op 7
def test_rolling_hash_tells_windows_apart():
    raw = shingles.raw_text("a b\n\tc A B C  é", True)
    h, (starts, ends) = shingles.word_hashes(raw.split()), shingles.places(raw)
    assert [(int(a), int(b)) for a, b in zip(starts, ends)] == [(0, 1), (2, 3), (5, 6), (7, 8), (9, 10), (11, 12), (14, 16)]
    assert len(set(h.tolist())) == 4 and len(shingles.word_hashes(b" \n".split())) == len(shingles.word_hashes(b"".split())) == 0
    for width in (1, 2, 3, 5, 7):
        r = shingles.rolling(h, width)
        assert len(r) == len(h) - width + 1
    assert shingles.rolling(h, 3)[0] == shingles.rolling(h, 3)[3] != shingles.rolling(h, 3)[1]
    assert len(shingles.rolling(h, 8)) == 0


def brute_components(rows):
    sets, parent = {}, {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}) if w else set()
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("block", [4, 512])
def test_near_dedup_is_brute_force(spark, docs, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_dedup(docs).collect()}
    assert got == brute_components([(i, t) for i, t, *_ in corpus()])


def test_near_dedup_of_one_large_group(spark):
    """Copies that drift from one base, so that many are linked through others only."""
    base = words(90, 3)
    rows = []
    for k in range(150):
        r, w = random.Random(k), list(base)
        for i in r.sample(range(90), r.randrange(6)):
            w[i] = f"y{r.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got.collect()} == brute_components(rows)


def drifting(n):
    """Texts some of which are similar enough to each other only, others not quite."""
    rows = []
    for k in range(n):
        r, w = random.Random(k), words(60, 10 + k // 12) + words(40, 500)
        for i in r.sample(range(100), r.randrange(10)):
            w[i] = f"z{r.randrange(40)}"
        rows.append((k, " ".join(w)))
    return rows


@pytest.mark.parametrize("paired", [0, 3, 10**6])
@pytest.mark.parametrize("block", [4, 512])
def test_near_dedup_by_pairs_and_by_blocks(spark, paired, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "PAIRED", paired)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = drifting(120)
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got.collect()} == brute_components(rows)


def test_rare_pairs_are_all_that_are_similar(spark):
    r = random.Random(1)
    sets = {}
    for k in range(150):
        base = random.Random(k // 10).sample(range(400), 3 + k % 50)
        sets[k] = sorted({r.randrange(400) if r.random() < 0.1 else x for x in base})
    rare = near_dedup.rare_keys(spark.createDataFrame([(k, k, v) for k, v in sets.items()], "rep long, comp long, shingles array<bigint>"))
    found = {(x["a"], x["b"]) for x in near_dedup.rare_pairs(rare).collect()}
    alike = {(a, b) for a in sets for b in sets if a < b and 4 * len({*sets[a]} & {*sets[b]}) >= 3 * len({*sets[a]} | {*sets[b]})}
    assert 20 < len(alike) and alike <= found and len(found) < len(sets) ** 2 / 20


def test_near_dedup_broadcasts_no_table_that_grows(spark, docs, monkeypatch):
    plans = []

    def seen(df, *a, f=near_dedup.stash):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return f(df, *a)

    monkeypatch.setattr(near_dedup, "stash", seen)
    monkeypatch.setattr(components, "stash", seen)
    monkeypatch.setattr(components, "FEW", 0)
    plans.append(near_dedup.near_dedup(docs)._jdf.queryExecution().executedPlan().toString())
    joins = [x for p in plans for x in p.split("\n") if "Join" in x]
    assert len(joins) > 20 and not [x for x in joins if "Broadcast" in x and "[bucket#" not in x]


def test_passages_in_a_chain_of_texts_make_no_blocks(spark, monkeypatch):
    """Each text shares three of four passages with the one before and with the one after, so that all hang together and none are similar."""

    def no_blocks(group):
        raise AssertionError("compared by blocks")

    monkeypatch.setattr(near_dedup, "block_links", no_blocks)
    rows = [(k, " ".join(words(25, k) + words(25, k + 1) + words(25, k + 2) + words(25, k + 3))) for k in range(200)]
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r["kept"] for r in got) and len(got) == 200


def test_index_finds_all_within_the_distance():
    """Any 15 of 24 symbols may differ."""
    r = np.random.RandomState(0)
    a = r.randint(0, 2**32, (200, 24), dtype=np.uint64).astype(np.uint32)
    b = a.copy()
    for k in range(200):
        b[k, r.choice(24, 15, replace=False)] ^= np.uint32(1)
    with np.errstate(over="ignore"):
        assert (near_dedup.index_keys(a) == near_dedup.index_keys(b)).any(axis=1).all()


def test_components_of_a_path(spark, tmp_path):
    links = spark.createDataFrame([(k + 1, k) for k in range(60)] + [(200, 100), (None, 5)], "a long, b long")
    got = {r["node"]: r["comp"] for r in components.connected(links, str(tmp_path), "p").collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 200: 100}


# op 8
def test_suffix_automaton():
    r = random.Random(4)
    for _ in range(200):
        texts = [[r.choice("abc") for _ in range(r.randint(1, 9))] for _ in range(r.randint(1, 5))]
        x = [r.choice("abcd") for _ in range(15)]
        subs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        want = [max([0] + [n for n in range(1, k + 2) if tuple(x[k + 1 - n : k + 1]) in subs]) for k in range(len(x))]
        weights = [r.randint(1, 3) for _ in texts]
        automaton = substring_dedup.SuffixAutomaton(texts, weights).summed()
        got, counts = automaton.stream(x, 2)
        assert list(got) == want
        pair = lambda k: sum(n * sum(t[i : i + 2] == x[k - 1 : k + 1] for i in range(len(t) - 1)) for t, n in zip(texts, weights))
        assert [counts[k] for k in range(len(x))] == [pair(k) if k and want[k] >= 2 else 0 for k in range(len(x))]


@pytest.mark.parametrize("stretches,hot,words", [(2048, 3, 100_000), (2048, 1024, 500), (0, 3, 100_000)])
def test_substring_dedup_is_brute_force(spark, docs, stretches, hot, words, monkeypatch):
    """With what is shared decided by the broadcast shards, by the dealt ones, and by digests."""
    monkeypatch.setattr(substring_dedup, "STRETCHES", stretches)
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", words)
    rows = [(i, WORD.findall(t or "")) for i, t, *_ in corpus()]
    seen = collections.Counter(tuple(w[k : k + 35]) for _, w in rows for k in range(len(w) - 34))
    want = []
    for i, w in rows:
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((i, len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    assert sorted(tuple(r) for r in substring_dedup.substring_dedup(docs).collect()) == sorted(want)


def test_shards_are_bounded_when_the_filter_is_full(spark, monkeypatch):
    """A filter so small that most unique stretches pass it: shards stay below twice their size, and the result is the same."""
    docs = spark.createDataFrame([(k, " ".join(words(5000, k) + words(800, 10**6 + k // 2))) for k in range(400)], "doc_id long, text string")
    want = sorted(map(tuple, substring_dedup.substring_dedup(docs).collect()))
    monkeypatch.setattr(substring_dedup, "FILTER_BITS", 15)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 5000)
    inner, written = substring_dedup.repeated_in, str(spark.conf.get("spark.checkpoint.dir")) + "/shard-sizes"

    def watched(group):
        import os
        import uuid

        os.makedirs(written, exist_ok=True)
        with open(f"{written}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(sum(len(bytes(p).split()) for p in group["piece"])))
        return inner(group)

    monkeypatch.setattr(substring_dedup, "repeated_in", watched)
    assert sorted(map(tuple, substring_dedup.substring_dedup(docs).collect())) == want
    import os

    sizes = [int(open(f"{written}/{f}").read()) for f in os.listdir(written)]
    assert len(sizes) > 200 and max(sizes) < 10_000 and {n for _, _, n, _ in want} == {800}


def thue_morse(n, a="a", b="b"):
    """n letters; with a and b changed over, hashes that are polynomials modulo a power of two can't tell them apart."""
    return "".join((a, b)[bin(k).count("1") % 2] for k in range(n))


def test_words_that_polynomials_confuse(spark):
    """Texts that differ in one long word, and texts whose words are laid out so, share nothing."""
    one, two = thue_morse(4096), thue_morse(4096, "b", "a")
    base = [f"w{k}" for k in range(34)]
    rows = [(1, " ".join([one, *base])), (2, " ".join([two, *base])), (3, " ".join([one] * 3)), (4, " ".join([two] * 3)), (5, thue_morse(64, "p ", "q ")), (6, thue_morse(64, "q ", "p "))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["n_removed"] for r in substring_dedup.substring_dedup(docs).where("doc_id < 5").collect()} == {0}
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(docs).collect()}
    assert got == {i: c for i, (_, c, _) in brute_components(rows).items()} and got[4] == 4


# op 10
def brute_spans(x):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, p, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 16, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
        for m in re.finditer(p, x):
            d = re.sub("[^0-9]", "", m[0])
            if low <= len(d) <= high and (kind == "phone" or pii.luhn(d)):
                out.append((kind, *m.span()))
    return out


def test_base_spans_are_the_patterns():
    r = random.Random(9)
    for _ in range(3000):
        x = "".join(r.choice("ab.@-+ 0123456789()1%") for _ in range(r.randint(0, 40)))
        assert pii.base_spans(x) == brute_spans(x), x
    card = "call 4111 1111 1111 1111 or a@b.co, 10.0.0.256, 1.2.3.4"
    assert pii.base_spans(card) == brute_spans(card) != []
    assert len(pii.base_spans("a" * 200_000 + "@" + "1" * 200_000)) == 0


def figures(field, lines):
    """Precision and recall of the field's spans on labelled lines."""
    right = found = wanted = 0
    for line in lines:
        text, spans = pii.labelled(line)
        got = pii.field_spans([text], field)[0]
        right, found, wanted = right + len(set(got) & set(spans)), found + len(got), wanted + len(spans)
    return right / found, right / wanted


def test_field_on_lines_it_has_not_seen():
    field = pii.train()
    assert min(figures(field, pii.EXAMPLES)) >= 0.97
    held_out = pii.labelled_table(pii.HELD_OUT_FRAMES, 12, 99)
    assert not set(held_out) & set(pii.EXAMPLES)
    assert min(figures(field, held_out)) >= 0.95
    more = [pii.labelled(x)[1] for x in held_out]
    assert sum(map(len, more)) > sum(len(set(pii.base_spans(pii.labelled(x)[0])) & set(s)) for x, s in zip(held_out, more)) + 60  # true spans that the patterns miss
    for text in ("order 123-456-7890 is late", "from 2021-03-04 to 2022-05-06", "at 2019-12-01 10:30"):
        assert pii.field_spans([text], field) == [[]], text
    for text, span in (("tel 020 7946 0991 in London", ("phone", 4, 17)), ("host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 is up", ("ip", 5, 44)), ("card 4111.1111.1111.1111 declined", ("card", 5, 24)), ("call   \n (303) 555-0111", ("phone", 9, 23))):
        assert pii.field_spans([text], field) == [[span]], text


def test_field_decodes_by_viterbi():
    field = pii.train()
    assert pii.field_spans(["phone 415-555-0199.", ""], field) == [[("phone", 6, 18)], []]
    r, n = np.random.RandomState(1), len(pii.LABELS)
    step = field.pair + pii._allowed()
    for size in (1, 2, 3, 4):
        table = r.randn(size, n)
        best = max(np.ndindex(*[n] * size), key=lambda p: sum(table[t, x] for t, x in enumerate(p)) + sum(step[a, b] for a, b in zip(p, p[1:])))
        assert tuple(field.decode([table])[0]) == best


def test_long_words_of_pii():
    zeros = "1.2.3." + "0" * 5000
    assert pii.base_spans(zeros) == [("ip", 0, len(zeros))] and pii.base_spans(zeros + "256") == []
    assert len(pii.shape("a" * 50 + "1")) == 51
    tail = pii.features(["(" * 38 + "12345678"], ("", "call"))[0]
    assert "digits=8" in tail and "pure=False" in tail
    assert "pure=True" in pii.features(["1" * 50], ("", "card"))[0]


def test_pii_rows(spark):
    got = pii.find_pii(spark.createDataFrame([(1, "mail a@b.co now\nring (303) 555-0111"), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert got[0]["spans"] == "email:5:11,phone:21:35" and got[0]["base_sha256"] == hashlib.sha256(b"email:5:11").hexdigest()
    assert (got[1]["spans"], got[1]["n_email"]) == ("", 0)


# op 5
def toxic_table(spark, n=900):
    r, plain, bad = random.Random(3), words(400, 8), ["stupido", "stupida", "idiotro", "idiotra"]
    letters = lambda w: "".join(chr(97 + int(c)) if c.isdigit() else c for c in w)
    rows, labels = [], []
    for k in range(n):
        w = [letters(r.choice(plain)) for _ in range(r.randint(20, 80))]
        if toxic := k % 5 == 1 or k % 11 == 0:
            for _ in range(3):
                w[r.randrange(len(w))] = r.choice(bad)
        rows.append((k, " ".join(w), "en", f"s{k % 4}", 0))
        labels.append((k, 1, int(toxic)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_table(spark)
    got = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 100 and (got["predicted"] == got["toxic"]).mean() >= 0.97
    assert got["score"].between(0, 1).all()


def test_spellings_do_not_share_counts(spark, tmp_path):
    """80,000 words of six letters: by 2**21 places some 15,000 of their grams would share one."""
    r = random.Random(6)
    bad, good = (["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(40_000)] for _ in range(2))
    docs = spark.createDataFrame([(" ".join(bad), 1), (" ".join(good), 0), ("", None)], "text string, toxic int")
    num, _ = toxicity.train(toxicity.word_counts(docs), str(tmp_path))
    model = toxicity.Spelling(toxicity._table(num, toxicity.NUM), None)
    want = np.array([[bad_.get(w, 0), good_.get(w, 0)] for bad_, good_ in [(collections.Counter(bad), collections.Counter(good))] for w in bad + good])
    codes = np.frombuffer("".join(bad + good).encode("utf-32-le"), np.uint32)
    assert (model.num[toxicity.gram_hash(codes, 6, 0)[5::6]][:, :2] == want).all()


def brute_ratio(texts, word):
    """log P(word | toxic) - log P(word | ordinary) from counts of all texts, by loops and dictionaries. texts: (text, toxic or None)."""
    order, low, discount, prior = 6, 3, 0.75, 60.0
    own, everywhere = [collections.Counter(), collections.Counter()], collections.Counter()
    for text, toxic in texts:
        for w in re.findall("[a-z]+", text):
            t = f"^{w}$"
            everywhere.update([t[:2], *(t[i : i + low] for i in range(len(t) - low + 1))])
            if toxic is not None:
                own[1 - toxic].update([*(t[:k] for k in range(2, min(order, len(t) + 1))), *(t[i : i + order] for i in range(len(t) - order + 1))])
    shared = collections.Counter()

    def add(counts, top, bottom):
        level = {g: n for g, n in counts.items() if len(g) == top}
        shared.update(level)
        for n in range(top - 1, bottom, -1):
            below = collections.Counter(g[1:] for g in level)
            below.update({g: c for g, c in counts.items() if len(g) == n and g[0] == "^"})
            shared.update(below)
            level = below

    add(own[0] + own[1], order, low)
    add(everywhere, low, 0)

    def after(counts, context):
        found = [c for g, c in counts.items() if len(g) == len(context) + 1 and g.startswith(context)]
        return sum(found), len(found)

    def together(gram):
        if len(gram) == 1:
            return (shared[gram] + 1.0) / (after(shared, "")[0] + 1000.0)
        total, kinds = after(shared, gram[:-1])
        if not total:
            return together(gram[1:])
        return max(shared[gram] - discount, 0) / total + min(discount * kinds / total, 1.0) * together(gram[1:])

    t, out = f"^{word}$", 0.0
    for i in range(1, len(t)):
        gram = t[max(0, i + 1 - order) : i + 1]
        logs = []
        for counts in own:
            total, kinds = after(counts, gram[:-1])
            logs.append(np.log((max(counts[gram] - discount, 0) + (discount * kinds + prior) * together(gram)) / (total + prior)))
        out += logs[0] - logs[1]
    return out


def test_ratios_are_kneser_ney(spark, tmp_path):
    """Both ways of scoring words, the broadcast tables and the joins, against a direct computation."""
    r = random.Random(12)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 9)))
    texts = [(" ".join(word() for _ in range(30)), toxic) for toxic in (1, 0, None) for _ in range(8)]
    asked = sorted({word() for _ in range(25)} | {"zzz", "abcx", *texts[0][0].split()[:5], *texts[-1][0].split()[:5]})
    counts = toxicity.word_counts(spark.createDataFrame(texts, "text string, toxic int"))
    num, ctx = toxicity.train(counts, str(tmp_path / "model"))
    want = [brute_ratio(texts, w) for w in asked]
    model = toxicity.Spelling(toxicity._table(num, toxicity.NUM), toxicity._table(ctx, toxicity.CTX))
    assert np.allclose(model.ratios([w.encode() for w in asked]), want, rtol=1e-4, atol=1e-4)
    got = {x["word"]: x["ratio"] for x in toxicity.word_ratios(spark.createDataFrame([(w,) for w in asked], "word string"), num, ctx, str(tmp_path / "join")).collect()}
    assert np.allclose([got[w] for w in asked], want, rtol=1e-4, atol=1e-4)


def test_toxicity_by_joins_is_the_same(spark, docs, monkeypatch):
    table, labels = toxic_table(spark, 300)
    table = table.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 10_000))
    scores = lambda: sorted((r["doc_id"], round(r["score"], 4)) for r in toxicity.score_toxicity(table, labels).collect())
    want = scores()
    monkeypatch.setattr(toxicity, "BROADCAST_GRAMS", 0)
    monkeypatch.setattr(toxicity, "GROUP", 100)
    assert [k for k, _ in scores()] == [k for k, _ in want]
    assert np.allclose([v for _, v in scores()], [v for _, v in want], atol=1e-3)


def test_table_finds_what_it_holds():
    h = np.random.RandomState(0).randint(1, 2**62, 5000, dtype=np.uint64)
    h[:3000] = h[:3000] // np.uint64(1 << 20) * np.uint64(1 << 20) + np.uint64(7)  # many want one place
    h = np.unique(h)
    t = toxicity.Table(h[::2], np.arange(len(h[::2]))[:, None] + 1)
    assert (t[h[::2]][:, 0] == np.arange(len(h[::2])) + 1).all() and not t[h[1::2]].any()
    assert not toxicity.Table(h[:0], np.zeros((0, 2)))[h].any()


def test_toxicity_without_labels(spark):
    docs, labels = toxic_table(spark, 40)
    assert {r["predicted"] for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0}


# op 6
def test_mix_meets_its_targets(spark, docs):
    got = mixing.mix(docs).toPandas()
    assert (got["taken"] <= 2 * got["size"]).all()
    by = mixing.mix(docs, keep=["source"]).select("kept.source", "size", "taken", "target").toPandas().groupby("source", dropna=False).agg({"size": "sum", "taken": "sum", "target": "first"})
    assert ((by["taken"] - by["target"]).abs() <= 1).all()
    assert abs(by["target"].sum() - 1.5 * by["size"].sum()) < 1e-6 * by["size"].sum()
    again = mixing.mix(docs.repartition(2)).toPandas()
    assert sorted(got["taken"]) == sorted(again["taken"])


# op 3
def test_rollup_is_idempotent(spark, tmp_path):
    """Repeats before and after a fold, another payload under an old id, a try that broke off, null keys, repeated rows, an empty batch."""
    docs = spark.createDataFrame([("s", "en", 5, "x"), ("s", "en", 7, "x"), (None, "fr", 2, "x"), (None, "fr", 2, "x")], "source string, lang string, tokens long, version string")
    r = token_counts.TokenRollup(spark, str(tmp_path / "r"))
    assert r.totals().count() == 0
    assert r.commit("a", token_counts.signed(docs, "v1", 1)) and not r.commit("a", token_counts.signed(docs, "v1", 1))
    assert not r.commit("a", token_counts.signed(docs, "other", 1))
    docs.limit(1).selectExpr("source", "lang", "'v9' version", "1L n_docs", "1L n_tokens").write.parquet(str(tmp_path / "r" / "delta-broken"))
    r.commit("b", token_counts.signed(docs.where("tokens = 7"), "v1", -1))
    two = docs.where("tokens = 5").withColumn("new", F.lit(9).cast("long"))
    r.commit("c", token_counts.revised(two, ("v1", "tokens"), ("v2", "new")))
    r.commit("d", token_counts.signed(docs.limit(0), "v1", 1))
    want = [(None, "fr", "v1", 2, 4), ("s", "en", "v2", 1, 9)]
    for _ in range(2):
        assert sorted(map(tuple, r.totals().collect()), key=str) == sorted(want, key=str)
        r.fold()
        for batch in "abcd":
            assert not r.commit(batch, token_counts.signed(docs, "v1", 1))
        r = token_counts.TokenRollup(spark, str(tmp_path / "r"))


def test_totals_survive_a_fold(spark, tmp_path):
    """Totals taken before a fold can be read after it; vacuum deletes only what went long enough ago and changes no answer."""
    docs = spark.createDataFrame([("s", "en", 5)], "source string, lang string, tokens long")
    r = token_counts.TokenRollup(spark, str(tmp_path / "r"))
    for k in range(3):
        r.commit(f"b{k}", token_counts.signed(docs, "v", 1))
    before = r.totals()
    r.fold()
    r.commit("late", token_counts.signed(docs, "v", 1))
    assert before.collect()[0]["n_tokens"] == 15 and r.totals().collect()[0]["n_tokens"] == 20
    tables = lambda: sorted(p.name for p in (tmp_path / "r").iterdir() if p.name != "manifest")
    assert len(tables()) == 5
    r.vacuum()
    assert len(tables()) == 5
    r.vacuum(grace=0)
    assert len(tables()) == 2 and len(list((tmp_path / "r" / "manifest").glob("part-*"))) == 1
    assert r.totals().collect()[0]["n_tokens"] == 20
    assert not any(r.commit(b, token_counts.signed(docs, "v", 1)) for b in ("b0", "b1", "b2", "late"))
    r.fold()
    assert r.totals().collect()[0]["n_tokens"] == 20


def encoding(version):
    import base64

    import tiktoken

    with open(f"{token_counts.TOKENIZERS}/{version}.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(version, pat_str=token_counts.SPLIT, mergeable_ranks=ranks, special_tokens={})


def test_token_totals_are_brute_force(spark):
    """The query against counts of each text by itself."""
    old, new = encoding("byte_bpe_50k"), encoding("byte_bpe_multi_50k")
    labels = collections.defaultdict(lambda: (-1, -1))
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        labels[r["doc_id"]] = (r["toxic"], r["quality"])
    want = collections.Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        toxic, quality = labels[r["doc_id"]]
        t = new if (toxic, quality) == (0, 0) else old
        if toxic != 1:
            want[r["source"], r["lang"], t.name] += 1
            want[r["source"], r["lang"], t.name, "tokens"] += len(t.encode_ordinary(r["text"] or ""))
    got = {(r["source"], r["lang"], r["version"]): (r["n_docs"], r["n_tokens"]) for r in queries.op3_token_counts(spark, SF).collect()}
    assert got == {k: (n, want[(*k, "tokens")]) for k, n in want.items() if len(k) == 3} and len({k[2] for k in got}) == 2


def test_token_counts_of_odd_texts(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{token_counts.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    e = encoding("byte_bpe_50k")
    odd_texts = odd(docs).unionByName(odd(docs.limit(1).withColumn("text", F.lit("<|endoftext|> a"))))
    got = odd_texts.select("text", token_counts.rank_tokens(spark, "byte_bpe_50k").alias("n"), token_counts.bpe_tokens(f"{token_counts.TOKENIZERS}/byte_bpe_50k.json").alias("m")).collect()
    for r in got:
        assert r["n"] == r["m"] == len(e.encode_ordinary(r["text"] or ""))
    assert odd(docs.limit(0)).select(token_counts.rank_tokens(spark, "byte_bpe_50k")).count() == 0


# op 4
def test_reparameterised_questions_are_caught(spark):
    item = "A train leaves with 30 apples and 12 pears, and Maria Silva buys 30 apples for 5 dollars in the market of the old town."
    docs = [
        (1, "Before. " + item + " After."),
        (2, "Before. " + item.replace("30", "45").replace("12", "7").replace("Maria Silva", "John") + " After."),
        (3, "Before. " + item.replace("30 apples and", "45 apples and") + " After."),  # 30 would be 45 here and 30 there
        (4, "Nothing of the kind is written in this text, but it has 30 apples."),
        (5, None),
    ]
    got = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"], r["verbatim"]) for r in got.collect()} == {(1, 7, True), (2, 7, False)}


def test_leaks_in_another_case(spark):
    item = "A train leaves the Old Station with 30 apples and 12 pears, and Maria Silva buys 30 apples for 5 dollars in Köln über the market. The Rest follows, and a Rich farmer sells All of it."
    changed = item.replace("Maria Silva", "John").replace("A train", "a train").replace("The Rest", "the Rest")
    texts = [item, item.lower(), item.upper(), item.title(), item.upper().replace("30", "45"), changed, item.upper().replace("30 APPLES AND", "45 APPLES AND"), "NOTHING OF THE KIND IS WRITTEN IN THIS TEXT."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = decontamination.leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert {(r["doc_id"], r["verbatim"]) for r in got} == {(0, True), (1, True), (2, True), (3, True), (4, False), (5, False)} and len(got) == 6


STORY = "Maria buys 12 apples for 3 dollars. Maria gives 5 of them to a friend who lives near the river. How many apples does Maria have when she comes home in the evening? Maria counts them again."


@pytest.mark.parametrize("name", ["Peter", "Anna Lena", "maria", "Ó Brien"])
@pytest.mark.parametrize("case", [str, str.upper, str.lower])
@pytest.mark.parametrize("numbers", [{}, {"12": "40", "5": "17"}])
def test_changed_names_at_sentence_starts(spark, name, case, numbers):
    text = STORY.replace("Maria", name)
    for a, b in numbers.items():
        text = text.replace(a, b)
    other = STORY.replace("Maria buys", "Peter buys").replace("Maria gives", "Anna gives").replace("Maria have", "Rui have").replace("Maria counts", "Ida counts")
    docs = spark.createDataFrame([(1, "Here it is. " + case(text) + " The end."), (2, other), (3, STORY.replace("5 of", "12 of"))], "doc_id long, text string")
    got = {r["doc_id"]: (r["coverage"], r["verbatim"]) for r in decontamination.leaks(docs, spark.createDataFrame([(7, STORY), (8, "Anna and Rui live here")], "item_id long, text string")).collect()}
    assert got[1][0] >= 0.75 and got[1][1] == (name == "maria" and not numbers) and 2 not in got and 3 in got


def test_words_of_a_large_benchmark_are_joined(spark, docs, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, decontamination.leaks(docs, items).collect()))
    monkeypatch.setattr(decontamination, "VOCABULARY", 3)
    assert sorted(map(tuple, decontamination.leaks(docs, items).collect())) == want != []


def test_short_items_leak_whole(spark):
    """Items without windows are found by all their words in a row, in any case; null and empty ones never."""
    items = spark.createDataFrame([(1, "Name the capital"), (2, "12 + 30 = 42"), (3, None), (4, " ?! "), (5, "What is")], "item_id long, text string")
    rows = [(1, "Please NAME the Capital, now."), (2, "name a capital"), (3, "so 12 plus 30, no: 12+30=42 it is"), (4, None), (5, ""), (6, "Name the capital. What is it? What is what?"), (6, "what is")]
    got = decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["first_token"], r["verbatim"], r["coverage"]) for r in got) == [(1, 1, 1, True, 1.0), (3, 2, 5, True, 1.0), (6, 1, 0, True, 1.0), (6, 5, 0, True, 1.0), (6, 5, 3, True, 1.0)]


def test_leaks_by_shuffle_are_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, decontamination.leaks(docs, items).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, decontamination.leaks(docs, items).collect())) == want != []


# op 1
def test_line_dedup_spares_copies(spark):
    unique = lambda k: "\n".join(" ".join(f"q{chr(97 + x % 26)}{w}" for x, w in enumerate(words(20, 50 + k))) for _ in range(1))
    plain = lambda t: re.sub("[0-9]", lambda m: chr(97 + int(m[0])), t)
    rows = [(k, plain(unique(k)) + f"\nPage {k} of 99 pages\n" + plain(unique(k + 500))) for k in range(10)]
    story = "\n".join(plain(unique(900 + k)) for k in range(4))
    rows += [(100 + k, story) for k in range(8)]
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k]["n_dropped"] == 1 and "Page" not in got[k]["text"] for k in range(10))
    assert all(got[100 + k]["text"] == story for k in range(8))


def plain_words(n, seed):
    """Words of letters, so that none is masked."""
    return " ".join(re.sub("[0-9]", lambda m: chr(97 + int(m[0])), w) for w in words(n, seed))


def dropped_in(spark, rows):
    return {r["doc_id"]: r["n_dropped"] for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_line_templates_that_share_a_leaf(spark):
    """Two families with the same length and leading tokens, a variable word in each, and ordinary lines beside them."""
    one = lambda k: f"the job of the night failed at step {plain_words(1, k)} and was sent back to the queue again"
    two = lambda k: f"the job of the night went well for user {plain_words(1, k)} who may read the report right now"
    rows = [(k, plain_words(40, 5000 + k) + "\n" + (one if k % 2 else two)(k) + "\n" + plain_words(40, 9000 + k)) for k in range(60)]
    rows += [(100 + k, plain_words(60, 700 + k) + "\nthe job of " + plain_words(14, 800 + k)) for k in range(20)]
    got = dropped_in(spark, rows)
    assert {got[k] for k in range(60)} == {1} and {got[100 + k] for k in range(20)} == {0}


def test_lines_of_short_pages_and_of_copied_texts(spark):
    """A footer on short pages, and on texts that have five copies each, goes; lines of copies and near copies stay."""
    footer = plain_words(20, 1)
    pages = [(k, plain_words(40, 100 + k) + "\n" + footer) for k in range(200)]
    assert set(dropped_in(spark, pages).values()) == {1}
    copied = [(k, "\n".join(plain_words(30, 1000 * i + k // 5) for i in range(3)) + "\n" + footer) for k in range(100)]
    assert set(dropped_in(spark, copied).values()) == {1}
    story = [plain_words(12, 50 + k) for k in range(30)]
    near = []
    for k in range(80):
        lines = [s.split() for s in story]
        for i in random.Random(k).sample(range(30), 4):
            lines[i][random.Random(k * i).randrange(12)] = f"z{plain_words(1, k)}"
        near.append((k, "\n".join(map(" ".join, lines))))
    assert set(dropped_in(spark, near).values()) == {0}


def near_copies(n, seed):
    """Texts of thirty lines of which each changes a word in four."""
    story = [plain_words(12, seed + k) for k in range(30)]
    for k in range(n):
        lines = [s.split() for s in story]
        for i in random.Random(seed + k).sample(range(30), 4):
            lines[i][random.Random(seed + k * i).randrange(12)] = f"z{plain_words(1, seed + k)}"
        yield "\n".join(map(" ".join, lines))


@pytest.mark.parametrize("copies", ["exact", "near", "two groups"])
def test_copies_of_one_text_spare_no_line_of_others(spark, copies):
    """A footer of forty texts that differ goes, however many copies of a further text have it too; the lines of these copies stay."""
    footer = plain_words(15, 3)
    rows = [(k, plain_words(60, 100 + k) + "\n" + plain_words(60, 300 + k) + "\n" + footer) for k in range(40)]
    more = {"exact": [plain_words(60, 7) + "\n" + plain_words(60, 8)] * 200, "near": list(near_copies(200, 9000)), "two groups": [*near_copies(150, 9000), *near_copies(150, 7000)]}[copies]
    got = dropped_in(spark, rows + [(1000 + k, t + "\n" + footer) for k, t in enumerate(more)])
    assert set(got.values()) == {1}
    alone = dropped_in(spark, [(1000 + k, t) for k, t in enumerate(more)])
    assert set(alone.values()) == {0}


def test_many_templates_in_one_leaf(spark):
    """Sixty-four templates, told apart by six positions, with a field each; eight documents for each."""
    rows = []
    for k in range(512):
        t = k // 8
        body = " ".join(f"{'ab'[t >> b & 1]}{chr(97 + b)} and" for b in range(6))
        rows.append((k, plain_words(50, 4000 + k) + f"\nthe same beginning {body} user {plain_words(1, 100 + k)} may go on with this work today\n" + plain_words(50, 9000 + k)))
    assert set(dropped_in(spark, rows).values()) == {1}


def test_one_line_of_any_length(spark):
    long = plain_words(200_000, 5)
    rows = [(k, f"{plain_words(30, 100 + k)}\n{long}") for k in range(6)]
    assert set(dropped_in(spark, rows[:1]).values()) == {0} and len(dropped_in(spark, rows)) == 6


def brute_lines(rows):
    """The tree by loops over all lines: (n_lines, n_dropped, text) of each row."""
    split, info = [], {}
    for _, t in rows:
        own = []
        for no, line in enumerate((t or "").split("\n")):
            tokens = tuple("<*>" if re.search("[0-9]", w) else w for w in WORD.findall(line.translate(LOWER)))
            if tokens:
                own.append((no, tokens))
        h = shingles.word_hashes([w.encode() for _, tokens in own for w in tokens])
        split.append((own, line_dedup.classes(h).tolist()))

    def recurs(found):  # found: indexes of rows
        n, rows = len(found), [collections.Counter(split[i][1][b] for i in found) for b in range(6)]
        if n < 5 or min(map(len, rows)) < 5:
            return False
        kinds = {tuple(split[i][1]) for i in found}
        sizes = [collections.Counter(c[b] for c in kinds) for b in range(6)]
        w = sum(1 / max(sizes[b][c[b]] for b in range(6)) for c in kinds)
        return n * n * 6 >= 5 * sum(c * c for r in rows for c in r.values()) or w + 1e-9 >= 5 + (len(kinds) - w) * 0.001

    at = collections.defaultdict(set)
    for i, (own, _) in enumerate(split):
        for _, tokens in own:
            at[tokens].add(i)
    gone = {t for t, found in at.items() if recurs(found)}
    leaves = collections.defaultdict(list)
    for t in at:
        leaves[len(t), t[:3]].append(t)
    todo = [(0, ts) for ts in leaves.values() if len(ts) > 1 and len({split[i][1][0] for t in ts for i in at[t]}) >= 5]
    hashed = lambda w: int(shingles.word_hashes([w.encode()]).view(np.int64)[0])
    while todo:
        depth, ts = todo.pop()
        n, template, parting = len(ts[0]), [], []
        if len(ts) < 5:
            continue
        for p in range(n):
            count = collections.Counter(t[p] for t in ts)
            top = max(count, key=lambda w: (count[w], -hashed(w)))
            template.append(top if count[top] >= 0.8 * len(ts) else None)
            shared = sum(c for c in count.values() if c >= 5)
            if template[-1] is None and shared:
                parting.append((shared, -len(count), -p, count))
        if sum(x is not None for x in template) >= 0.75 * n:
            fits = [t for t in ts if all(c is None or c == w for w, c in zip(t, template))]
            if recurs(set().union(*(at[t] for t in fits))):
                gone |= set(fits)
        elif parting:
            _, _, p, count = max(parting, key=lambda x: x[:3])
            parts = collections.defaultdict(list)
            for t in ts:
                parts[t[-p] if count[t[-p]] >= 5 else None].append(t)
            todo += [(depth + 1, x) for x in parts.values()]
    out = []
    for (i, t), (own, _) in zip(rows, split):
        drop = {no for no, tokens in own if tokens in gone}
        lines = (t or "").split("\n")
        out.append((i, len(lines), len(drop), hashlib.sha256("\n".join(x for no, x in enumerate(lines) if no not in drop).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup_is_brute_force(spark, docs, monkeypatch):
    """On odd rows, on the fixture, and with leaves joined instead of broadcast."""
    found = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for df in (docs.select("doc_id", "text"), found):
        want = brute_lines([tuple(r) for r in df.collect()])
        assert sorted(map(tuple, line_dedup.digest(line_dedup.line_dedup(df)).collect()), key=str) == want
    monkeypatch.setattr(line_dedup, "BROADCAST_LEAVES", -1)
    assert sorted(map(tuple, line_dedup.digest(line_dedup.line_dedup(found)).collect()), key=str) == want


# op 2
def test_license_blocks(spark):
    mit = next(t for t in license_scan.TEMPLATES if t.label == "mit" and not t.base).text
    rows = [(1, "x " * 50 + mit.upper() + " y" * 90), (2, "Released under the MIT License."), (3, "mit the under license"), (4, None), (5, "cc by nc cc by nc")]
    got = {r["doc_id"]: r for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["labels"], got[1]["base_labels"], got[1]["n_base"]) == ("mit", "", 0)
    assert (got[2]["base_labels"], got[2]["first_word"], got[2]["last_word"]) == ("mit", 1, 1)
    assert (got[3]["labels"], got[3]["score"], got[4]["n_words"]) == ("", 0.0, 0)
    assert (got[5]["n_base"], got[5]["first_word"], got[5]["last_word"]) == (2, 0, 3)


def test_license_texts_at_every_offset(spark):
    """Short and whole texts of licenses are found wherever they begin, and by few words less than the threshold they are not."""
    r, rows = random.Random(1), []
    for t in license_scan.TEMPLATES:
        for at in [*range(0, 70, 3), 130, 255, 256, 300]:
            rows.append((len(rows), t.label, "zz " * at + t.text.upper() + " yy" * r.randrange(400)))
    docs = spark.createDataFrame(rows, "doc_id long, label string, text string")
    found = license_scan.license_scan(docs).join(docs.select("doc_id", "label"), "doc_id").collect()
    assert all(x["label"] in x["labels"].split(",") for x in found) and len(found) == len(rows)
    isc = next(t for t in license_scan.TEMPLATES if t.label == "isc")
    part = [w for w in isc.words if w not in sorted(set(isc.words))[: len(set(isc.words)) - isc.need + 1]]
    got = license_scan.license_scan(spark.createDataFrame([(1, " ".join(part)), (2, isc.text)], "doc_id long, text string"))
    assert [x["labels"] for x in got.orderBy("doc_id").collect()] == ["", "isc"]


# pipeline
def test_pipeline_stages(spark, tmp_path):
    docs, labels = toxic_table(spark, 600)
    vocabulary = sorted({w for r in docs.join(labels.where("toxic = 0"), "doc_id").select("text").collect() for w in r["text"].split()})
    some = lambda n, seed: " ".join(random.Random(seed).choices(vocabulary, k=n))
    item = some(30, 77)
    more = [(5000, some(80, 60), "en", "s1", 0), (5001, some(80, 60) + " " + vocabulary[0], "en", "s2", 0), (5002, some(50, 61) + " " + item, "en", "s3", 0), (5003, None, None, None, None), (5004, "", "fr", "s1", 0)]
    docs = odd(docs.unionByName(spark.createDataFrame(more, SCHEMA))).withColumns({"n_lines": F.lit(77), "n_dropped": F.lit(88)})
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, left[-1], str(tmp_path)).write.parquet(str(tmp_path / name))
        left.append(spark.read.parquet(str(tmp_path / name)))
        if name != "mixing":
            assert left[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in df.select("doc_id").collect()} for df in left]
    toxic = {r["doc_id"] for r in labels.where("toxic = 1").collect()}
    assert len(ids[1] & toxic) <= 0.05 * len(toxic) and len((ids[0] - toxic) - ids[1]) <= 6
    assert ids[2] == ids[1]
    assert all(df.where("n_lines = 77 and n_dropped = 88").count() == df.count() for df in left[1:])
    kept = {i for i, (_, c, own) in brute_components([(r["doc_id"], r["text"]) for r in left[2].collect()]).items() if own}
    assert ids[3] == kept and 5001 not in kept
    assert ids[3] - ids[4] == {5002}
    mix = left[5].groupBy("source").agg(F.sum("n_words").alias("w"), F.first("target").alias("t")).collect()
    assert all(abs(r["w"] - r["t"]) <= 1 for r in mix)
    assert all(len(WORD.findall(r["text"])) == r["n_words"] for r in left[5].limit(200).collect())


@pytest.mark.parametrize("stage", [0, 2, 3])
def test_pipeline_broadcasts_no_ids_to_drop(spark, stage):
    left = corpus_pipeline.STAGES[stage][1](spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)
    left.collect()
    joins = [x for x in left._jdf.queryExecution().executedPlan().toString().split("\n") if "LeftAnti" in x]
    assert joins and not [x for x in joins if "Broadcast" in x]


@pytest.mark.parametrize("few", [0, 200_000])
def test_leaks_wait_for_no_broadcast(spark, few, monkeypatch):
    """What is broadcast is a table when the texts begin to be read; what comes out of a shuffle meanwhile would wait behind them."""
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", few)
    found = decontamination.leaks(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert found.collect()
    lines = found._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" +-:")) for x in lines]
    for i in [i for i, x in enumerate(lines) if "BroadcastExchange" in x]:
        below = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        assert not [x for x in lines[i + 1 : below] if "ShuffleQueryStage" in x]


def test_pipeline_of_nothing(spark, tmp_path):
    nobody = spark.createDataFrame([], SCHEMA)
    nobody.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
