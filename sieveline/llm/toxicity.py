"""Toxicity by class-conditional Kneser-Ney models of words' spellings.

Two models, toxic and ordinary, give the probability of each character of a word after up to
five before it. Where a model has seen a context, its own discounted counts speak, and what
the discount and a prior take away goes to a Kneser-Ney model that both share: orders 6 to 4
over all counted rows of either class, orders 3 to 1 over all documents, with continuation
counts (the number of different characters in front) below the highest order of each. So what
either class has hardly seen is smoothed alike in both and says nothing. Counts are kept by the 64-bit
hashes of grams and contexts, in tables that grow with the number of different ones: no two
spellings share a count, unless all 64 bits of their hashes agree. Tables of up to BROADCAST_GRAMS
rows are broadcast; beyond that, the corpus's different words are joined with the grams they
need, and documents with their words' ratios.

A word's log-likelihood ratio is that of its characters. A document's features are sums of its
words' ratios, normalised by the number of words or its root, taken over the whole text, over
the best ten and fifty consecutive words and over the three highest, and the same of what each
ratio exceeds the noise by. A logistic regression over these, fitted on a bounded sample of
labelled rows that the class counts have not seen, makes them a score.

Only labelled rows outside the held-out fold are learnt from (fold: crc32 of the id as text,
mod 5; 0 is held out, 1 calibrates, 2 to 4 are counted). Repeated labels of an id count as
toxic if one is; null labels are none. Null and empty texts have all features 0. Without both
classes among the labels every score is the share of toxic ones, or 0. An empty table gives no
rows. Ids that repeat are scored each on its own text; labels join all of them; ids are integers (others are cast to
long); a text of any length is scored whole, by one task; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import dealt, new_root, stash
from sieveline.llm.shingles import mixed

ORDER, SHARED = 6, 3
DISCOUNT, PRIOR = 0.75, 60.0
WINDOWS, TOP, NOISE = (10, 50), 3, 1.0
FEATURES = ["mean", "rooted", "best10", "best50", "excess", "excess_rooted", "top", "excess_log"]
FIT_ROWS = 50_000
#: Up to so many grams (about 100 bytes each in a worker) the models are broadcast; larger ones are joined.
BROADCAST_GRAMS = 3_000_000
#: Words that are scored together where models are joined; bytes of scored words that a task keeps.
GROUP, KNOWN_BYTES = 5_000, 100_000_000
#: Up to so many labelled ids (some 16 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 1_000_000
_SPLIT = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_GRAM = "gram string, t double, o double"


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters (and whatever isn't ASCII), lower-cased."""
    return (text or "").lower().encode("utf-8", "replace").translate(_SPLIT).split()


def fold_of(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5, F.lit(0)).cast("int")


def gram_hash(codes: np.ndarray, n: int, salt: int) -> np.ndarray:
    """The hash of the n codes that end at each position, never 0; the first n - 1 have none of their own."""
    h = np.full(len(codes), np.uint64((salt * 64 + n) * 0x9E3779B97F4A7C15 % 2**64))
    for k in range(min(n, len(codes))):
        shifted = codes[: len(codes) - k]
        h[k:] = mixed(h[k:] ^ (shifted.astype(np.uint64) + np.uint64(k << 32)))
    return np.maximum(h, np.uint64(1))


class Table:
    """Rows of values by hash, with open addressing: at most half of the places are taken, and rows[0] is for what isn't there."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        self.mask = (1 << max(2 * len(hashes) - 1, 1).bit_length()) - 1
        self.keys, self.at = np.zeros(self.mask + 1, np.uint64), np.zeros(self.mask + 1, np.int32)
        self.rows = np.concatenate((np.zeros((1, values.shape[1]), np.float32), values.astype(np.float32)))
        left, place = np.arange(len(hashes)), self._first(hashes)
        while len(left):
            free = np.flatnonzero(self.keys[place] == 0)
            self.at[place[free]] = left[free] + 1  # of several that want a place the last one gets it
            self.keys[place[free]] = hashes[left[free]]
            lost = self.at[place] != left + 1
            left, place = left[lost], (place[lost] + 1) & self.mask

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64(self.mask)).astype(np.int64)

    def __getitem__(self, hashes: np.ndarray) -> np.ndarray:
        place = self._first(hashes)
        key = self.keys[place]
        left = np.flatnonzero((key != hashes) & (key != 0))
        while len(left):
            place[left] = (place[left] + 1) & self.mask
            key = self.keys[place[left]]
            left = left[(key != hashes[left]) & (key != 0)]
        return self.rows[self.at[place]]


class Spelling:
    """The models: num[hash] = (toxic, ordinary, shared) counts of a gram; ctx[hash] = sum and kinds of each after a context."""

    def __init__(self, num: Table, ctx: Table):
        self.num, self.ctx = num, ctx

    @staticmethod
    def coded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The characters of all words, with ^ before and $ behind each, and their places in the words."""
        texts = ["^" + w.decode("utf-8", "replace") + "$" for w in words]
        lengths = np.array([len(t) for t in texts])
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        return codes, np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)

    def ratios(self, words: list[bytes]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary), for words."""
        codes, place = self.coded(words)
        starts = np.flatnonzero(place == 0)
        shared = (self.num[gram_hash(codes, 1, 0)][:, 2] + 1.0) / (self.ctx[gram_hash(codes[:1], 0, 1)][0, 4] + 1000.0)
        ratio = np.zeros(len(codes))
        for n in range(2, ORDER + 1):
            at = np.flatnonzero(place >= n - 1)
            num, ctx = self.num[gram_hash(codes, n, 0)[at]], self.ctx[gram_hash(codes, n - 1, 1)[at - 1]]
            den = np.maximum(ctx[:, 4], 1e-9)
            seen = ctx[:, 4] > 0
            mixed_in = np.minimum(np.maximum(num[:, 2] - DISCOUNT, 0), den) / den + np.minimum(DISCOUNT * ctx[:, 5] / den, 1.0) * shared[at]
            shared[at] = np.where(seen, mixed_in, shared[at])
            best = (place[at] == n - 1) | (n == ORDER)  # the longest context that the place has
            i, num, ctx = at[best], num[best].astype(float), ctx[best].astype(float)
            logs = []
            for k in range(2):
                den = ctx[:, 2 * k] + PRIOR
                logs.append(np.log(np.maximum((np.maximum(num[:, k] - DISCOUNT, 0) + (DISCOUNT * ctx[:, 2 * k + 1] + PRIOR) * shared[i]) / den, 1e-12)))
            ratio[i] = logs[0] - logs[1]
        return np.add.reduceat(ratio, starts)


def spelled(text: str = "text") -> Column:
    """The words of words_of(), as strings."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[\\x00-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def word_counts(docs: DataFrame) -> DataFrame:
    """docs: (text, toxic), toxic null where the class is unknown or may not be learnt. (word, t, o, n): a row for each different word, with its counts in either class and everywhere."""
    one = lambda c: F.sum(c.cast("double"))
    words = docs.select(F.explode(spelled()).alias("word"), "toxic")
    return words.groupBy("word").agg(F.coalesce(one(F.col("toxic")), F.lit(0.0)).alias("t"), F.coalesce(one(1 - F.col("toxic")), F.lit(0.0)).alias("o"), F.count("*").cast("double").alias("n"))


def class_grams(words: DataFrame) -> DataFrame:
    """words: as of word_counts(). (kind, gram, t, o) counts by class; kind 1: over all documents, in t."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            own: dict[str, list[float]] = {}
            everywhere: Counter = Counter()
            for word, toxic, ordinary, n in zip(b["word"], b["t"].tolist(), b["o"].tolist(), b["n"].tolist(), strict=True):
                t = "^" + word + "$"
                for i in range(len(t) - SHARED + 1):
                    everywhere[t[i : i + SHARED]] += n
                everywhere[t[:2]] += n
                if toxic or ordinary:
                    for g in [t[i : i + ORDER] for i in range(len(t) - ORDER + 1)] + [t[:k] for k in range(2, min(ORDER, len(t) + 1))]:
                        v = own.setdefault(g, [0.0, 0.0])
                        v[0] += toxic
                        v[1] += ordinary
            yield pd.DataFrame({"kind": 0, "gram": pd.Series(list(own), dtype=object), "t": [v[0] for v in own.values()], "o": [v[1] for v in own.values()]})
            yield pd.DataFrame({"kind": 1, "gram": pd.Series(list(everywhere), dtype=object), "t": list(everywhere.values()), "o": 0.0})

    return words.mapInPandas(run, f"kind int, {_GRAM}").groupBy("kind", "gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def hashes_of(grams: list[str], salt: int) -> np.ndarray:
    """gram_hash() of whole grams."""
    out = np.zeros(len(grams), np.uint64)
    lengths = np.fromiter(map(len, grams), np.int64, len(grams))
    for n in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == n)
        codes = np.frombuffer("".join([grams[k] for k in own]).encode("utf-32-le", "surrogatepass"), np.uint32) if n else np.zeros(len(own), np.uint32)
        out[own] = gram_hash(codes, n, salt)[max(n, 1) - 1 :: max(n, 1)]
    return out


def hashed(df: DataFrame, salt: int, values: list[str]) -> DataFrame:
    """df: (gram, *values). (hash, *values)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[values].assign(hash=hashes_of(b["gram"].tolist(), salt).view(np.int64))[["hash", *values]]

    return df.mapInPandas(run, "hash bigint, " + ", ".join(f"{v} double" for v in values))


def _table(df: DataFrame, values: list[str]) -> Table:
    """df: (hash, *values), at most BROADCAST_GRAMS rows, which come to the driver."""
    found = df.toArrow()
    column = lambda c, kind: found[c].to_numpy().astype(kind)
    return Table(column("hash", np.int64).view(np.uint64), np.column_stack([column(v, np.float32) for v in values]))


NUM, CTX = list("tos"), ["t", "t_kinds", "o", "o_kinds", "s", "s_kinds"]


def train(words: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """words: as of word_counts(). The models as two tables by hash: grams (hash, *NUM) and contexts (hash, *CTX)."""
    grams = stash(class_grams(words), root, "grams")
    front, at = F.col("gram").startswith("^"), lambda n: F.length("gram") == n
    own, everywhere = grams.where("kind = 0").select("gram", "t", "o"), grams.where("kind = 1").select("gram", F.col("t").alias("s"))
    behind = lambda df, n: df.groupBy(F.substring("gram", 2, n).alias("gram")).agg(F.count("*").cast("double").alias("s"))
    pooled = own.select("gram", (F.col("t") + F.col("o")).alias("s"))
    levels = [pooled.where(at(ORDER))]
    for n in range(ORDER - 1, SHARED, -1):
        levels.append(behind(levels[-1], n).unionByName(pooled.where(at(n) & front)))
    levels.append(everywhere.where(at(SHARED)))
    for n in range(SHARED - 1, 0, -1):
        levels.append(behind(levels[-1], n).unionByName(everywhere.where(at(n) & front)))
    counts = own.withColumn("s", F.lit(0.0))
    for x in levels:
        counts = counts.unionByName(x.select("gram", F.lit(0.0).alias("t"), F.lit(0.0).alias("o"), "s"))
    counts = stash(counts.groupBy("gram").agg(*[F.sum(c).alias(c) for c in "tos"]), root, "counts")
    before = F.substring("gram", F.lit(1), F.length("gram") - 1).alias("gram")
    sums = [x for c in "tos" for x in (F.sum(c).alias(c), F.sum((F.col(c) > 0).cast("double")).alias(f"{c}_kinds"))]
    return stash(hashed(counts, 0, NUM), root, "num"), stash(hashed(counts.groupBy(before).agg(*sums), 1, CTX), root, "ctx")


def summary(r: np.ndarray) -> tuple[float, ...]:
    """FEATURES of the ratios of a text's words."""
    n, root, excess = len(r), np.sqrt(len(r)), np.maximum(r - NOISE, 0)
    sums = np.concatenate(([0.0], np.cumsum(r)))
    best = [(sums[min(k, n) :] - sums[: n + 1 - min(k, n)]).max() / k for k in WINDOWS]
    top = np.partition(r, n - min(TOP, n))[n - min(TOP, n) :].sum() / TOP
    return (r.mean(), r.sum() / root, *best, excess.mean(), excess.sum() / root, top, np.log1p(excess.sum()))


def features(docs: DataFrame, model: Spelling, keep: str) -> DataFrame:
    """docs: (..., text). Adds FEATURES in place of the text; keep is the schema of the other columns. The model is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((model.num, model.ctx))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spelling, known, size = Spelling(*shared.value), {}, 0
        for b in batches:
            out = []
            for k in range(0, len(b), 64):
                own = [words_of(t) for t in b["text"].iloc[k : k + 64]]
                if size > KNOWN_BYTES:
                    known.clear()
                    size = 0
                new = list({w for ws in own for w in ws} - known.keys())
                if new:
                    known.update(zip(new, spelling.ratios(new).tolist(), strict=True))
                    size += sum(map(len, new)) + 128 * len(new)
                for ws in own:
                    out.append(summary(np.fromiter(map(known.__getitem__, ws), np.float64, len(ws))) if ws else (0.0,) * len(FEATURES))
            yield b.drop(columns="text").assign(**dict(zip(FEATURES, map(list, zip(*out, strict=True)), strict=True)))

    return docs.mapInPandas(run, ", ".join([keep, *(f"{c} double" for c in FEATURES)]))


def word_ratios(words: DataFrame, num: DataFrame, ctx: DataFrame, root: str) -> DataFrame:
    """(word, ratio) for each different word, where the model is too large to broadcast: words are dealt into groups of about GROUP, and each is joined with the grams and contexts it needs."""
    groups = 1 + words.count() // GROUP
    dealt = words.select("word", F.pmod(F.xxhash64("word"), F.lit(groups)).alias("g"))

    def needed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for g, own in b.groupby("g"):
                codes, place = Spelling.coded([w.encode() for w in own["word"]])
                hashes = {(0, 0): gram_hash(codes[:1], 0, 1)[:1]} | {(salt, n): gram_hash(codes, n, salt)[place >= n - 1] for salt in (0, 1) for n in range(1, ORDER + 1)}
                for (salt, n), h in hashes.items():
                    yield pd.DataFrame({"g": g, "salt": 1 if n == 0 else salt, "hash": np.unique(h).view(np.int64)})

    wanted = dealt.mapInPandas(needed, "g bigint, salt int, hash bigint").distinct()
    both = num.select(F.lit(0).alias("salt"), "hash", F.array(*NUM).alias("row")).unionByName(ctx.select(F.lit(1).alias("salt"), "hash", F.array(*CTX).alias("row")))
    rows = stash(wanted.join(both, ["salt", "hash"]), root, "needed")

    def run(own: pd.DataFrame, grams: pd.DataFrame) -> pd.DataFrame:
        tables = []
        for salt, width in ((0, len(NUM)), (1, len(CTX))):
            part = grams[grams["salt"] == salt]
            tables.append(Table(part["hash"].to_numpy(np.int64).view(np.uint64), np.array(part["row"].tolist(), float).reshape(len(part), width)))
        return pd.DataFrame({"word": own["word"], "ratio": Spelling(*tables).ratios([w.encode() for w in own["word"]]) if len(own) else []})

    return stash(dealt.groupBy("g").cogroup(rows.groupBy("g")).applyInPandas(lambda w, r: run(w, r), "word string, ratio double"), root, "ratios")


def joined_features(docs: DataFrame, ratios: DataFrame, keep: str) -> DataFrame:
    """The same as features(), by a join of each document's words with their ratios; the words of one document meet in one row."""
    rows = docs.withColumn("row", F.monotonically_increasing_id())
    names = [c.split()[0] for c in keep.split(", ")]
    words = rows.select("row", *names, F.posexplode_outer(spelled()).alias("at", "word")).join(ratios, "word", "left")
    listed = words.groupBy("row", *names).agg(F.array_sort(F.collect_list(F.when(F.col("ratio").isNotNull(), F.struct("at", "ratio")))).alias("r")).select(*names, F.col("r.ratio").alias("r"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [summary(np.asarray(r, float)) if len(r) else (0.0,) * len(FEATURES) for r in b["r"]]
            yield b.drop(columns="r").assign(**dict(zip(FEATURES, map(list, zip(*out, strict=True)) if out else [[]] * len(FEATURES), strict=True)))

    return listed.mapInPandas(run, ", ".join([keep, *(f"{c} double" for c in FEATURES)]))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights (intercept first) by Newton's method with a small ridge; features are scaled inside."""
    mean, sd = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / sd])
    w, ridge = np.zeros(z.shape[1]), np.array([1e-6] + [0.1] * x.shape[1])
    loss = lambda w: np.logaddexp(0, np.where(y > 0, -1, 1) * (z @ w)).sum() + (ridge * w * w).sum() / 2
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9), z.T @ (y - p) - ridge * w)
        while loss(w + step) > loss(w) and np.abs(step).max() > 1e-9:
            step /= 2
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return np.concatenate(([w[0] - (w[1:] * mean / sd).sum()], w[1:] / sd))


def score_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs."""
    spark = docs.sparkSession
    root = new_root(spark, "toxicity")
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), fold_of(doc_id).alias("fold"))
    learnt = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    learnt = stash(learnt.where(fold_of("doc_id") > 0), root, "labels")
    if learnt.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        learnt = F.broadcast(learnt)

    joined = source.join(learnt, "doc_id", "left")
    words = stash(word_counts(joined.select("text", F.when(F.col("fold") > 1, F.col("toxic")).alias("toxic"))), root, "words")
    num, ctx = train(words, root)
    if num.limit(BROADCAST_GRAMS + 1).count() <= BROADCAST_GRAMS:  # each context begins a gram, so there are fewer of these
        found = features(source, Spelling(_table(num, NUM), _table(ctx, CTX)), "doc_id bigint, fold int")
    else:
        found = joined_features(source, word_ratios(words, num, ctx, root), "doc_id bigint, fold int")
    rows = stash(found, root, "features")
    sample = rows.where("fold = 1").join(learnt, "doc_id").orderBy(F.xxhash64("doc_id"), *FEATURES).limit(FIT_ROWS).select(*FEATURES, "toxic").toPandas()
    x, y = sample[FEATURES].to_numpy(), sample["toxic"].to_numpy(float)
    if 0 < y.sum() < len(y):
        w0, *rest = (float(w) for w in logistic(x, y))
        score = 1 / (1 + F.exp(-sum((F.col(c) * w for c, w in zip(FEATURES, rest, strict=True)), F.lit(w0))))
    else:
        score = F.lit(float(y.mean()) if len(y) else 0.0)
    return rows.withColumn("score", score).select("doc_id", (F.col("fold") == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs whose text isn't predicted toxic; all rows of an id go if one is."""
    found = score_toxicity(docs, labels).where("predicted = 1").select("doc_id").distinct()
    return docs.join(dealt(found), "doc_id", "left_anti").select(*docs.columns)
