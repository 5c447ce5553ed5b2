"""Filter interaction audit: what each of five filters removes, in every order in which they can be applied.

Texts are scanned once, as the bytes of Arrow buffers: a table of byte classes, prefix sums over them and
differences at the places where texts begin give words, capitals, symbols and code points of all texts of a piece at once. Words
get a rolling hash from prefix sums too; sorted by text and hash, equal neighbours are compared byte by byte, and
texts in which equal hashes stand for different words are counted by their words themselves. What leaves a task is a row
of a few numbers and a SHA-256 digest for each text; texts are never shuffled. Rows come down to counts by part, set of failed
filters and labels, at most 128 for a part, from which all orders follow.

Cases: null texts count as empty, null languages as ''. An empty text fails only A, and E where a smaller doc_id is empty too.
Rows of one doc_id are rows of their own; E asks for a *smaller* doc_id, so rows that share the smallest one pass, and a null
doc_id neither fails E nor makes others fail, and has no labels. Where labels repeat a doc_id, the larger value counts. An empty table gives no rows.
Columns other than doc_id, text and lang aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
#: A: words a text needs. B: different words in a hundred. C: capitals in a hundred code points. D: characters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 3, b"#$%&*|"
#: Bytes scanned together.
PIECE = 1 << 18
#: Where the counts of three byte classes stand in one number, so that one prefix sum has them all; INNER: bytes of a code point after its first.
CAPITAL, SYMBOL, INNER, FIELD = 0, 21, 42, (1 << 21) - 1
#: Texts scanned together: their number shares 64 bits with a hash.
TEXTS = 1 << 16
BASE = 0x9E3779B97F4A7C15


class Scanner:
    """Counts of many texts at once. base: of the rolling hash."""

    def __init__(self, base: int = BASE):
        self.blank = np.zeros(256, bool)
        self.blank[[0x20, *range(0x09, 0x0E)]] = True
        self.classes = np.zeros(256, np.int64)
        self.classes[ord("A") : ord("Z") + 1] = 1 << CAPITAL
        self.classes[list(SYMBOLS)] = 1 << SYMBOL
        self.classes[0x80:0xC0] = 1 << INNER
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up, self.down = (np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(PIECE, x)))) for x in (self.base, self.inverse))

    def counts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A row (words, different words, capitals, symbols, code points) for each text data[at[k]:at[k + 1]]; PIECE bytes at most."""
        n, texts = len(data), len(at) - 1
        found = np.zeros((texts, 5), np.int64)
        held = np.diff(_sums(self.classes[data])[at])
        for column, place in ((2, CAPITAL), (3, SYMBOL), (4, INNER)):
            found[:, column] = held >> place & FIELD
        found[:, 4] = np.diff(at) - found[:, 4]
        solid = ~self.blank[data]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        starts = np.flatnonzero(solid & (edge[:-1] | ~np.concatenate(([False], solid[:-1]))))
        ends = np.flatnonzero(solid & (edge[1:] | ~np.concatenate((solid[1:], [False])))) + 1
        found[:, 0] = found[:, 1] = np.diff(np.searchsorted(starts, at))
        if not len(starts):
            return found
        sums = _sums((data.astype(np.uint64) + np.uint64(1)) * self.up[:n])
        key = (sums[ends] - sums[starts]) * self.down[starts] * np.uint64(BASE)
        text = np.repeat(np.arange(texts, dtype=np.uint64), found[:, 0])
        key = (text << np.uint64(48)) | (key >> np.uint64(16))
        order = np.argsort(key)
        key = key[order]
        twins = np.flatnonzero(key[1:] == key[:-1])
        a, b = order[twins], order[twins + 1]
        same = _equal(data, starts[a], ends[a], starts[b], ends[b])
        where = text[a].astype(np.int64)
        found[:, 1] -= np.bincount(where, minlength=texts)
        for t in np.unique(where[~same]):
            found[t, 1] = len(set(data[at[t] : at[t + 1]].tobytes().split()))
        return found

    def long(self, data: np.ndarray) -> np.ndarray:
        """The same for one text of any length, piece by piece; a word that is cut counts once."""
        total, words, rest = np.zeros(5, np.int64), set(), b""
        for k in range(0, len(data), PIECE):
            piece = data[k : k + PIECE]
            total += self.counts(piece, np.array([0, len(piece)]))[0]
            total[0] -= k > 0 and not self.blank[data[k - 1 : k + 1]].any()
            own = (rest + piece.tobytes()).split()
            rest = b"" if self.blank[piece[-1]] else own.pop()
            words.update(own)
        total[1] = len(words | ({rest} - {b""}))
        return total

    def batch(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        found, k = np.zeros((len(at) - 1, 5), np.int64), 0
        while k < len(at) - 1:
            end = max(k + 1, min(int(np.searchsorted(at, at[k] + PIECE, "right")) - 1, k + TEXTS, len(at) - 1))
            piece = data[at[k] : at[end]]
            found[k:end] = self.long(piece) if len(piece) > PIECE else self.counts(piece, at[k : end + 1] - at[k])
            k = end
        return found


def _sums(x: np.ndarray) -> np.ndarray:
    """Prefix sums, from 0 on."""
    out = np.zeros(len(x) + 1, x.dtype)
    np.cumsum(x, out=out[1:])
    return out


def _equal(data: np.ndarray, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether data[a:a_end] and data[b:b_end] hold the same bytes, for arrays of places; eight bytes at a time."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))
    size = a_end - a
    same = size == b_end - b
    left = np.flatnonzero(same)
    done = 0
    while len(left):
        rest = np.minimum(size[left] - done, 8)
        mask = ~np.uint64(0) >> (np.uint64(64) - np.uint64(8) * rest.astype(np.uint64))
        good = ((eights[a[left] + done] ^ eights[b[left] + done]) & mask) == 0
        same[left[~good]] = False
        done += 8
        left = left[good & (size[left] > done)]
    return same


def facts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "lang", base: int = BASE) -> DataFrame:
    """(doc_id, part, n_words, n_distinct, n_capitals, n_symbols, n_points, digest) for every row of docs; digest is the SHA-256 of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base)
        for b in batches:
            texts = pc.fill_null(b.column("text"), "").cast(pa.large_string())
            _, places, body = texts.buffers()
            at = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
            found = scanner.batch(data, at)
            digests = [hashlib.sha256(data[x:y]).digest() for x, y in zip(at[:-1], at[1:], strict=True)]
            columns = [b.column("doc_id"), b.column("part"), *(pa.array(found[:, k]) for k in range(5)), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, n_words long, n_distinct long, n_capitals long, n_symbols long, n_points long, digest binary")


NAMES = ["doc_id", "part", "n_words", "n_distinct", "n_capitals", "n_symbols", "n_points", "digest"]


def failed(found: DataFrame) -> DataFrame:
    """found with fails: bits 0 to 3 for the filters A to D, which look at one text."""
    tests = [
        F.col("n_words") < LEAST_WORDS,
        100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"),
        100 * F.col("n_capitals") > MOST_CAPITALS * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]
    bits = [F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)]
    return found.withColumn("fails", sum(bits[1:], bits[0]))


def masks(found: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents of facts() by the filters they fail, E among them, and by their labels.

    Copies are summed up by task before they are shuffled, so a text with very many copies is no hot key.
    """
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    own = failed(found).select("doc_id", "part", "fails", "digest").join(marks, "doc_id", "left")
    texts = ["digest", "part", "fails", "good", "toxic"]
    own = own.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    rows = own.groupBy("doc_id", *texts).agg(F.count("*").alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")
    kinds = rows.groupBy(*texts).agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("free"), first)
    least = kinds.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
    kept = F.col("free") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = kinds.join(least, "digest").select(*texts[1:], kept.alias("kept"), (F.col("n") - kept).alias("gone"))
    both = F.explode(F.array(F.struct(F.col("fails").alias("mask"), F.col("kept").alias("n")), F.struct((F.col("fails") + 16).alias("mask"), F.col("gone").alias("n")))).alias("x")
    return split.select("part", "good", "toxic", both).groupBy("part", "x.mask", "good", "toxic").agg(F.sum("x.n").alias("n")).where("n > 0")


def _orders() -> tuple[list[str], list[int], dict[str, np.ndarray]]:
    """The order and the step of each of the 600 rows of a part; and by name a matrix that turns counts by mask into what the rows say."""
    orders, steps, rows = [], [], {"kept": [], "removed": [], "redundant": [], "unique_fails": []}
    mask = np.arange(1 << len(FILTERS))
    letters = []
    for order in permutations(FILTERS):
        seen = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            here, earlier = (mask & bit) > 0, (mask & seen) > 0
            rows["removed"].append(here & ~earlier)
            rows["redundant"].append(here & earlier)
            rows["unique_fails"].append(mask == bit)
            rows["kept"].append(~here & ~earlier)
            orders.append("".join(order))
            steps.append(step)
            letters.append(letter)
            seen |= bit
    found = {k: np.array(v, np.int64) for k, v in rows.items()}
    same = np.array(letters)[:, None] == np.array(letters)[None, :]
    found["shapley"] = same.astype(np.int64) @ found["removed"]
    return orders, steps, found


def interactions(counts: DataFrame) -> DataFrame:
    """600 rows for each part of masks(): one for each order and step."""
    orders, steps, rows = _orders()

    def run(own: pd.DataFrame) -> pd.DataFrame:
        total, good, toxic = (np.bincount(own["mask"], own["n"].where(own[c], 0) if c else own["n"], 1 << len(FILTERS)).astype(np.int64) for c in ("", "good", "toxic"))
        out = {"part": own["part"].iloc[0], "filter_order": orders, "step": np.array(steps, np.int32)}
        out |= {k: m @ total for k, m in rows.items()} | {"good_lost": rows["removed"] @ good, "toxic_lost": rows["removed"] @ toxic}
        return pd.DataFrame(out)[[c.split()[0] for c in schema.split(", ")]]

    schema = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return counts.groupBy("part").applyInPandas(run, schema)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) over all documents."""
    return interactions(masks(facts(docs), labels))


def audit_sql() -> str:
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
        WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
        w AS (SELECT *, regexp_extract_all(text, '{word}') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
        l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
            CAST(len(words) < {LEAST_WORDS} AS INT) + 2 * CAST(100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) AS INT)
            + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(text) AS INT)
            + 8 * CAST(regexp_matches(text, '[{SYMBOLS.decode()}]') AS INT) + 16 * CAST(coalesce(doc_id > least, false) AS INT) AS mask
          FROM w LEFT JOIN l USING (doc_id)),
        c AS (SELECT part, mask, good, toxic, count(*) AS n FROM f GROUP BY ALL),
        a AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM a, a b, a c, a d, a e
          WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT filter_order, CAST(step AS INT) AS step, filter_order[step] AS letter, 1 << (ascii(filter_order[step]) - 65) AS bit,
            CAST(list_sum(list_transform(string_split(filter_order[1:step], ''), lambda y: 1 << (ascii(y) - 65))) AS INT) AS upto
          FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        r AS (SELECT part, filter_order, step, letter,
            sum(CASE WHEN mask & upto = 0 THEN n ELSE 0 END) AS kept,
            sum(CASE WHEN mask & upto = bit THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN mask & bit > 0 AND mask & upto <> bit THEN n ELSE 0 END) AS redundant,
            sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN mask & upto = bit AND good THEN n ELSE 0 END) AS good_lost,
            sum(CASE WHEN mask & upto = bit AND toxic THEN n ELSE 0 END) AS toxic_lost
          FROM c, s GROUP BY ALL)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
          CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
          CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM r"""
