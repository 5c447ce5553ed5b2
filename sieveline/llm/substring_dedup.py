"""Substring dedup: words in any window of 35 that starts elsewhere too are removed.

Every window has an anchor, the smallest hash among its runs of eight words, so equal windows
have equal anchors. A run of windows with one anchor is a stretch of at most 62 words; a text
is cut into stretches, one for each fourteen words or so. Suffix automata of stretches decide
which windows are repeated, by the words themselves:

* stretches whose anchor occurs twice are dealt by anchor into shards of about SHARD_WORDS words,
  each a task's reference: an automaton of an anchor's different stretches, weighted by how
  often each occurs, through which they stream themselves, tells how often each window occurs.
  Sending every shard to every document instead costs shards x documents;
* an anchor with more than HOT occurrences may have more different stretches than a task should
  hold. The commonest stretches of such anchors that occur at least twice make up reference
  shards of fixed size, which are broadcast; the different stretches of hot anchors stream
  through them, and where the matching statistic reaches 35 words the window is repeated. The
  windows left over, at the edges of common passages, are counted by 128-bit digests of their bytes.

Anchors are counted first; filters of fixed size over those that occur twice and those that are
hot tell the ways apart. A false positive sends a window another way and changes no decision:
each way is exact, and equal windows always go the same way.

Windows are judged on the input, and texts are read again for the result rather than kept beside
their windows. A text of any length is a row of its own in a task; its stretches are short. Ids
are integers (others are cast to long). Null and empty texts have no words; equal rows repeat each
other's windows; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import bit_filter, forget, maybe_in, new_root, stash
from sieveline.llm.shingles import raw_text, rolling, word_hashes

WINDOW, GRAM = 35, 8
FILTER_BITS = 26
#: Words of a dealt shard, about; occurrences above which an anchor is hot.
SHARD_WORDS, HOT = 50_000, 1024
#: Bounds of the broadcast shards: stretches (of at most 62 words each), and how many of them a shard has.
STRETCHES, SHARD = 2048, 512
#: Texts that are cut at a time.
CUT = 500
#: The place of a gram travels in the low bits of its hash; the others are the anchor.
_BITS = 20
_PLACE = np.uint64((1 << _BITS) - 1)


def anchors(grams: np.ndarray) -> np.ndarray:
    """Of each window, the place of its anchor: the gram whose hash has the smallest 44 leading bits. grams: rolling(h, GRAM)."""
    width = WINDOW - GRAM + 1
    n = len(grams) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    low = (grams & ~_PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACE)
    span = 1
    while 2 * span <= width:  # minima over spans that double, then two that overlap
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[width - span : width - span + n])
    at = np.arange(n)
    return at + (((low & _PLACE).astype(np.int64) - at) & int(_PLACE))


def stretches_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The stretches of a text: the anchor, the first and the last window of each."""
    grams = rolling(word_hashes(words), GRAM)
    at = anchors(grams)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return (grams[at[first]] >> np.uint64(_BITS)).view(np.int64), first, np.append(first[1:], len(at)) - 1


class SuffixAutomaton:
    """Of stretches of words, each added with a weight."""

    def __init__(self, stretches=(), weights=None):
        self.next: list[dict] = [{}]
        self.link, self.len, self.count = [-1], [0], [0]
        for k, words in enumerate(stretches):
            last, weight = 0, weights[k] if weights is not None else 1
            for w in words:
                last = self._add(last, w)
                self.count[last] += weight

    def _state(self, edges: dict, length: int, link: int) -> int:
        self.next.append(edges)
        self.len.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, p: int, w) -> int:
        """The state of p's longest word with w after it, which the state there is parted for if it has longer ones."""
        nxt, link, length = self.next, self.link, self.len
        q = nxt[p][w]
        if length[q] == length[p] + 1:
            return q
        own = self._state(dict(nxt[q]), length[p] + 1, link[q])
        link[q] = own
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = own
            p = link[p]
        return own

    def _add(self, last: int, w) -> int:
        nxt, link = self.next, self.link
        if w in nxt[last]:
            return self._split(last, w)
        new, p = self._state({}, self.len[last] + 1, 0), last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            link[new] = self._split(p, w)
        return new

    def summed(self) -> SuffixAutomaton:
        """count becomes the weighted number of places where a state's words end."""
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            self.count[self.link[v]] += self.count[v]
        return self

    def stream(self, words, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """At each word, the matching statistic (how many words that end there occur in some stretch), and the count of the size words that end there (0 unless matched)."""
        out, counts, state, matched = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0, 0
        nxt, link, length = self.next, self.link, self.len
        for k, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            out[k] = matched
            if matched >= size:
                q = state
                while length[link[q]] >= size:
                    q = link[q]
                counts[k] = self.count[q]
        return out, counts


def covered(n: int, starts: np.ndarray) -> np.ndarray:
    """Which of n words lie in a window that begins at one of starts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


def _kept(words: list[bytes], starts: np.ndarray) -> tuple[int, str]:
    """How many of the words go, and the hash of the others."""
    gone = np.zeros(len(words), bool)
    if len(starts):
        gone = covered(len(words), starts)
        words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return int(gone.sum()), hashlib.sha256(b" ".join(words)).hexdigest()


def anchor_counts(docs: DataFrame) -> DataFrame:
    """docs: (text). (h, n): the anchors and how many stretches each has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [stretches_of(raw_text(text, False).split())[0] for text in b["text"]]
            if found:
                yield pd.DataFrame({"h": np.concatenate(found)})

    return docs.mapInPandas(run, "h bigint").groupBy("h").agg(F.count("*").alias("n"))


def anchor_filter(chosen: DataFrame) -> np.ndarray:
    """A bit for each place that one of the anchors in chosen falls in: 2**FILTER_BITS bits, whatever their number."""
    slot = F.col("h").bitwiseAND((1 << FILTER_BITS) - 1)
    rows = (
        chosen.select(F.bitmap_bucket_number(slot + 1).alias("bucket"), F.bitmap_bit_position(slot + 1).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .toPandas()
    )
    out = np.zeros(((1 << FILTER_BITS) // 32768, 4096), np.uint8)
    for bucket, bits in zip(rows["bucket"], rows["bits"], strict=True):
        out[int(bucket) - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def in_filter(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h & ((1 << FILTER_BITS) - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


_CUT = "row bigint, doc_id bigint, copy bigint, n_words bigint, n_removed bigint, kept_sha256 string, first array<int>, anchor array<bigint>, hot array<boolean>, piece array<binary>"


def cut(docs: DataFrame, bits: np.ndarray, hot_bits: np.ndarray) -> DataFrame:
    """docs: (doc_id, copy, text). Rows without open stretches have their result; the others have these, each with its first window, anchor and words."""
    shared = docs.sparkSession.sparkContext.broadcast((bits, hot_bits))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        bits, hot_bits = shared.value
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for k in range(0, len(whole), CUT):
                b, out = whole.iloc[k : k + CUT], []
                for doc_id, copy, text in zip(b["doc_id"], b["copy"], b["text"], strict=True):
                    words = raw_text(text, False).split()
                    keys, first, last = stretches_of(words)
                    open_ = np.flatnonzero(in_filter(bits, keys))
                    row += 1
                    if len(open_):
                        keys, first = keys[open_], first[open_]
                        pieces = [b" ".join(words[a:z]) for a, z in zip(first.tolist(), (last[open_] + WINDOW).tolist())]
                        out.append((row, doc_id, copy, len(words), None, None, first.astype(np.int32), keys, in_filter(hot_bits, keys), pieces))
                    else:
                        out.append((row, doc_id, copy, len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), *[None] * 4))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in _CUT.split(", ")], dtype=object)

    return docs.mapInPandas(run, _CUT)


def repeated_in(group: pd.DataFrame) -> pd.DataFrame:
    """group: (anchor, piece, digest, n), a dealt shard. (digest, mask): which windows of each piece are repeated, a bit for each; pieces without any are left out."""
    out = []
    for _, own in group.groupby("anchor", sort=False):
        pieces, weights = [bytes(p).split() for p in own["piece"]], own["n"].to_numpy()
        if len(pieces) == 1:  # all occurrences are alike
            counts = [np.full(len(pieces[0]), weights[0])]
        else:
            automaton = SuffixAutomaton(pieces, weights.tolist()).summed()
            counts = [automaton.stream(p)[1] for p in pieces]
        for digest, count in zip(own["digest"], counts, strict=True):
            mask = int((2 ** np.flatnonzero(count[WINDOW - 1 :] > 1)).sum())
            if mask:
                out.append((digest, mask))
    return pd.DataFrame(out, columns=["digest", "mask"], dtype=object)


def in_reference(hot: DataFrame) -> DataFrame:
    """hot: (piece, digest, n), the different stretches of hot anchors. (digest, n, mask, rest): which of their windows the broadcast shards hold, a bit for each, and the others as (bit, digest of the window)."""
    common = hot.where("n > 1").orderBy(F.desc("n"), "digest").limit(STRETCHES).select("piece").toPandas()["piece"]
    stretches = [bytes(p).split() for p in common]
    shared = hot.sparkSession.sparkContext.broadcast([stretches[k : k + SHARD] for k in range(0, len(stretches), SHARD)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automata = None
        for b in batches:
            automata = [SuffixAutomaton(s) for s in shared.value] if automata is None else automata
            out = []
            for piece, digest, n in zip(b["piece"], b["digest"], b["n"], strict=True):
                words = bytes(piece).split()
                held = np.zeros(len(words) - WINDOW + 1, bool)
                for a in automata:
                    held |= a.stream(words)[0][WINDOW - 1 :] >= WINDOW
                rest = np.flatnonzero(~held).tolist()
                digests = [hashlib.blake2b(b" ".join(words[k : k + WINDOW]), digest_size=16).digest() for k in rest]
                out.append((digest, n, int((2 ** np.flatnonzero(held)).sum()), rest, digests))
            yield pd.DataFrame(out, columns=["digest", "n", "mask", "bit", "window"], dtype=object)

    return hot.select("piece", "digest", "n").mapInPandas(run, "digest binary, n bigint, mask bigint, bit array<int>, window array<binary>")


def substring_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of docs."""
    root = new_root(docs.sparkSession, "substring-dedup")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counts = stash(anchor_counts(source.select("text")), root, "anchors")
    bits, hot_bits = anchor_filter(counts.where("n > 1")), anchor_filter(counts.where(F.col("n") > HOT))
    forget(docs.sparkSession, f"{root}/anchors")
    source = source.withColumn("copy", F.xxhash64("doc_id", "text"))
    rows = stash(cut(source, bits, hot_bits), root, "cut", "zstd")

    open_rows = rows.where("first is not null")
    # Shards follow what is dealt, not what repeats: a filter that fills up lets unique stretches through as well.
    stretches = open_rows.agg(F.sum(F.size(F.filter("hot", lambda h: ~h)))).first()[0] or 0
    shards = 1 + stretches * (WINDOW + 14) // SHARD_WORDS
    pieces = open_rows.select("row", F.explode(F.arrays_zip("first", "anchor", "hot", "piece")).alias("p")).select("row", "p.*")
    digest = F.unhex(F.substring(F.sha2("piece", 256), 1, 32)).alias("digest")
    different = pieces.groupBy("anchor", "hot", "piece").agg(F.count("*").alias("n"))
    dealt = different.where("not hot").select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "piece", digest, "n")
    masks = dealt.groupBy("shard").applyInPandas(lambda g: repeated_in(g), "digest binary, mask bigint")
    hot = stash(in_reference(stash(different.where("hot").select("piece", digest, "n"), root, "hot")), root, "streamed")
    left = hot.select("digest", "n", F.explode(F.arrays_zip("bit", "window")).alias("w")).select("digest", "n", "w.*")
    twice = left.groupBy("window").agg(F.sum("n").alias("n")).where("n > 1").select("window")
    left = left.join(twice, "window").select("digest", F.expr("shiftleft(1L, bit)").alias("mask"))
    hot_masks = hot.select("digest", "mask").unionByName(left).groupBy("digest").agg(F.bit_or("mask").alias("mask")).where("mask <> 0")
    found = pieces.select("row", "first", digest).join(masks.unionByName(hot_masks), "digest").groupBy("row").agg(F.collect_list(F.struct("first", "mask")).alias("f"))
    found = found.select("row", F.col("f.first").alias("firsts"), F.col("f.mask").alias("masks"))

    one = open_rows.groupBy("doc_id", "copy").agg(F.min("row").alias("row")).toDF("_id", "_copy", "row")  # equal rows have equal results
    opened = one.join(found, "row", "left").drop("row")
    texts = maybe_in(source, "copy", bit_filter(one, "_copy", FILTER_BITS), FILTER_BITS)  # of other rows the text isn't shuffled
    of_text = opened["_id"].eqNullSafe(texts["doc_id"]) & (opened["_copy"] == texts["copy"])

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, text, firsts, masks in zip(b["doc_id"], b["text"], b["firsts"], b["masks"], strict=True):
                starts = []
                for first, mask in zip(*(map(int, x) for x in (firsts, masks)), strict=True) if firsts is not None else ():
                    starts += [first + k for k in range(mask.bit_length()) if mask >> k & 1]
                words = raw_text(text, False).split()
                out.append((doc, len(words), *_kept(words, np.array(starts, np.int64))))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"], dtype=object)

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    finished = texts.join(opened, of_text).select("doc_id", "text", "firsts", "masks").mapInPandas(finish, schema)
    return rows.where("first is null").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(finished)
