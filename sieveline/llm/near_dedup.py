"""MinHash near-dedup by a multi-index Hamming join.

A document's set is its distinct five-word shingles. Its signature has 24 symbols of 32 bits,
each the smallest value of one hash function over the set. The signature is split into eight
chunks of three symbols. Two signatures that differ in at most 15 symbols agree in some chunk
but for one symbol (pigeonhole: nine errors cannot spread over eight chunks two by two), so
the index has, for each chunk, one key for each symbol that may be wrong: 24 keys, and every
pair within 15 differing symbols meets under one of them. At a similarity of 0.75 symbols
differ with probability 1/4, and fewer than one pair in a million has no common key.

Pairs under a key are not listed. First, equal texts are one class. Then:

1. every member of a key is compared with the key's smallest member only (a star), on the
   full sets; links give first components;
2. keys with members besides that one in several components are open. Members of open keys
   are indexed again by the rare part of their sets: with shingles ordered by the number of open
   sets that have them, two sets of the wanted similarity share one of their |x| - ceil(0.75 |x|) + 1
   rarest shingles, so passages that many documents share open nothing;
3. under a rare shingle of up to PAIRED sets, pairs of different components are candidates where
   the sets' sizes, and what stands behind the shingle in both, leave room for the wanted
   similarity; they are confirmed on full sets. Sets that rarer shingles than these don't tell
   apart are dealt into clusters, clusters into blocks, and pairs of blocks into tasks, each of
   which compares documents of different components with full sets and returns only links
   that join two of them.

Texts are one class by a 128-bit digest of their words; links are confirmed on digests of the
shingles' own bytes (cryptographic, 64 bits each), not on the hashes that the index is made of.

Memory of a task is bounded by two blocks, and the driver's by one bit filter and few labels: tables that grow
with the documents are joined by shuffles. Ids are integers (others are cast to long); other columns are not looked
at; a text of any length is one row in a task, and its set one row afterwards. Null and empty texts have no set and are linked
with nothing; texts of fewer than five words are one shingle; rows that share an id and a text
are in one class; rows without an id are linked with nothing. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import bit_filter, dealt, maybe_in, new_root, stash
from sieveline.llm.components import connected
from sieveline.llm.shingles import raw_text, shingle_digests, shingle_set, word_hashes

CHUNKS, CHUNK = 8, 3
SYMBOLS = CHUNKS * CHUNK
SHARE = (75, 100)
BLOCK = 512
#: Up to so many sets that share a rare shingle are compared by a join of their sizes and places, more by blocks.
PAIRED = 64
FILTER_BITS = 26


def _functions() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.RandomState(7)
    return r.randint(0, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.randint(0, 2**63, SYMBOLS, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """24 symbols of 32 bits of a set that isn't empty."""
    times, plus = _functions()
    out = np.full(SYMBOLS, np.uint64(2**64 - 1))
    for k in range(0, len(shingles), 4096):
        np.minimum(out, (shingles[k : k + 4096, None] * times + plus).min(axis=0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def signed(docs: DataFrame) -> DataFrame:
    """docs: (doc_id, text). Adds n_shingles, text_key (null without words) and sig in place of the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text in b["text"]:
                words = raw_text(text, True).split()
                s = shingle_set(word_hashes(words))
                rows.append((len(s), blake2b(b" ".join(words), digest_size=16).digest(), signature(s).tobytes()) if len(s) else (0, None, None))
            yield pd.DataFrame({"doc_id": b["doc_id"]} | dict(zip(("n_shingles", "text_key", "sig"), zip(*rows), strict=True)))

    return docs.mapInPandas(run, "doc_id bigint, n_shingles bigint, text_key binary, sig binary")


def index_keys(sigs: np.ndarray) -> np.ndarray:
    """sigs: (n, 24). (n, 24) keys: of each chunk, the two symbols left when one may be wrong."""
    s = sigs.astype(np.uint64)
    out = np.empty(s.shape, np.uint64)
    for c in range(CHUNKS):
        for wrong in range(CHUNK):
            k = c * CHUNK + wrong
            u, v = (s[:, c * CHUNK + q] for q in range(CHUNK) if q != wrong)
            out[:, k] = ((u << np.uint64(32)) | v) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k * 0xD1B54A32D192ED03 % 2**64)
    return out


def keyed(reps: DataFrame) -> DataFrame:
    """reps: (rep, n, sig). (key, rep, n), 24 rows each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                keys = index_keys(np.frombuffer(b"".join(b["sig"]), np.uint32).reshape(len(b), SYMBOLS))
                yield pd.DataFrame({"key": keys.ravel().view(np.int64), "rep": np.repeat(b["rep"].to_numpy(), SYMBOLS), "n": np.repeat(b["n"].to_numpy(), SYMBOLS)})

    return reps.select("rep", "n", "sig").mapInPandas(run, "key bigint, rep bigint, n bigint")


def full_sets(docs: DataFrame) -> DataFrame:
    """docs: (rep, text). (rep, shingles), the whole set as sorted digests of the shingles' bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"rep": b["rep"], "shingles": [shingle_digests(raw_text(t, True).split()) for t in b["text"]]})

    return docs.mapInPandas(run, "rep bigint, shingles array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough, by their full sets."""
    sets_of = lambda c: sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"{c}_set"))
    both = F.size(F.array_intersect("a_set", "b_set"))
    linked = both * SHARE[1] >= (F.size("a_set") + F.size("b_set") - both) * SHARE[0]
    return dealt(dealt(pairs).join(sets_of("a"), "a")).join(sets_of("b"), "b").where(linked).select("a", "b")


def rare_keys(sets: DataFrame) -> DataFrame:
    """sets: (rep, comp, shingles). (key, rep, comp, n, at): the shingles of each set's rare part that other sets have too, and their places in its order."""
    each = sets.select("rep", F.explode("shingles").alias("key"))
    shared = each.withColumn("sets", F.count("*").over(Window.partitionBy("key"))).where("sets > 1")
    ordered = shared.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("sets", "key"))).alias("ordered"))
    rows = sets.select("rep", "comp", F.size("shingles").alias("n")).join(dealt(ordered), "rep")
    alone = F.col("n") - F.size("ordered")  # come first in the order
    part = F.floor(F.col("n") * (SHARE[1] - SHARE[0]) / SHARE[1]).cast("int") + 1
    rare = F.slice("ordered", 1, F.greatest(part - alone, F.lit(0)))
    placed = rows.select("rep", "comp", F.col("n").cast("long").alias("n"), alone.cast("long").alias("alone"), F.posexplode(rare).alias("place", "x"))
    return placed.select(F.col("x.key").alias("key"), "rep", "comp", "n", (F.col("alone") + F.col("place")).alias("at"))


def rare_pairs(rare: DataFrame) -> DataFrame:
    """rare: rows of rare_keys(). (a, b): pairs of different components that share a key and may be similar enough: the first that they share in the order tells."""
    side = lambda c: rare.select("key", *[F.col(x).alias(f"{c}_{x}") for x in ("rep", "comp", "n", "at")])
    behind = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    fits = (F.least("a_n", "b_n") * SHARE[1] >= F.greatest("a_n", "b_n") * SHARE[0]) & (behind * sum(SHARE) >= (F.col("a_n") + F.col("b_n")) * SHARE[0])
    met = side("a").join(dealt(side("b")), "key").where((F.col("a_comp") < F.col("b_comp")) & fits)
    return met.select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).distinct()


def block_links(group: pd.DataFrame) -> pd.DataFrame:
    """Links between documents of different components in one task's blocks; a link that joins nothing new is left out."""
    sets = [np.asarray(s, np.int64) for s in group["shingles"]]
    size, reps, comps = np.array([len(s) for s in sets]), group["rep"].to_numpy(), group["comp"].to_numpy()
    _, comp = np.unique(comps, return_inverse=True)
    docs = np.repeat(np.arange(len(sets)), size)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, docs = flat[order], docs[order]
    largest = np.bincount(comp).argmax()
    links = []
    for x in np.flatnonzero(comp != largest):
        lo, hi = np.searchsorted(flat, sets[x], "left"), np.searchsorted(flat, sets[x], "right")
        held = np.repeat(lo - np.concatenate(([0], np.cumsum(hi - lo)[:-1])), hi - lo) + np.arange((hi - lo).sum())
        both = np.bincount(docs[held], minlength=len(sets))
        for y in np.flatnonzero(both * SHARE[1] >= (size + size[x] - both) * SHARE[0]):
            if comp[x] != comp[y]:
                links.append((reps[x], reps[y]))
                comp[comp == comp[x]] = comp[y]
    return pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    spark = docs.sparkSession
    root = new_root(spark, "near-dedup")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stash(signed(source), root, "rows")

    one = F.min(F.struct(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sig"))
    reps = stash(rows.where("doc_id is not null and n_shingles > 0").groupBy("text_key").agg(one.alias("x")).select("text_key", "x.*"), root, "reps")

    keys = keyed(reps)
    crowded = keys.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("first"), F.count("*").alias("members")).where("members > 1")
    crowded = stash(keys.join(dealt(crowded), "key").select("key", "rep", "n", F.col("first.rep").alias("center"), F.col("first.n").alias("center_n")), root, "crowded")
    members = crowded.select("rep").distinct()
    near_text = maybe_in(source.withColumnRenamed("doc_id", "rep"), "rep", bit_filter(members, "rep", FILTER_BITS), FILTER_BITS)
    sets = stash(full_sets(near_text.join(dealt(members), "rep").dropDuplicates(["rep"]).select("rep", "text")), root, "sets")

    alike = F.least("n", "center_n") * SHARE[1] >= F.greatest("n", "center_n") * SHARE[0]
    star = crowded.where((F.col("rep") != F.col("center")) & alike).select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    links = stash(confirmed(star, sets), root, "star-links")
    first = connected(links, root, "first")

    compared = crowded.join(dealt(first.withColumnRenamed("node", "rep")), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    open_keys = compared.where("rep <> center").groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    open_reps = stash(compared.join(dealt(open_keys), "key").select("rep", "comp").distinct(), root, "open-reps")
    open_sets = stash(sets.join(dealt(open_reps), "rep").select("rep", "comp", "shingles"), root, "open-sets")

    rare = stash(rare_keys(open_sets), root, "rare")
    still = rare.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("rep").alias("center"), F.count("*").alias("members")).where("lo <> hi")
    still = stash(rare.join(dealt(still.select("key", "center", "members")), "key"), root, "still")
    pairs = stash(rare_pairs(still.where(F.col("members") <= PAIRED)), root, "pairs")
    rare_links = stash(confirmed(pairs, open_sets.select("rep", "shingles")), root, "rare-links")
    met = still.where(F.col("members") > PAIRED).select("rep", "center").distinct().withColumn("lowest", F.min("center").over(Window.partitionBy("rep")))
    hooks = met.select(F.col("lowest").alias("a"), F.col("rep").alias("b")).unionByName(met.select(F.col("lowest").alias("a"), F.col("center").alias("b")))
    clusters = connected(hooks.distinct(), root, "clusters")
    sized = clusters.join(dealt(clusters.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))), "comp")
    parts = sized.select(F.col("comp").alias("cluster"), F.col("node").alias("rep"), "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("own"))
    tasks = parts.select("cluster", "rep", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")).select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep"
    )
    more = dealt(tasks).join(open_sets, "rep").groupBy("cluster", "i", "j").applyInPandas(block_links, "a bigint, b bigint")
    final = connected(links.unionByName(rare_links).unionByName(stash(more, root, "block-links")), root, "final")

    classes = reps.join(dealt(final.withColumnRenamed("node", "rep")), "rep", "left").select("text_key", F.coalesce("comp", "rep").alias("component_id"))
    found = rows.join(dealt(classes), "text_key", "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
