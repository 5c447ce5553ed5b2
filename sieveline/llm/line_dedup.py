"""Line dedup by a log-template tree of fixed depth.

A line's tokens are its words, lower-cased, with <*> for a word that holds a digit. The tree
sorts lines by token count and then by their first three tokens; below that,

* equal masked lines are one template, and
* a leaf's different lines become one template if at least 75 % of the positions are constant
  (one token in at least 80 % of them); the other positions are variable fields. A leaf that isn't
  so is parted by the tokens at one position, the one at which most lines have a token that five
  lines share, and its parts are tried again for as long as they can be parted; lines whose token there is
  rare are a part of their own. So a leaf yields as many templates as it holds.

A template recurs, and its lines are dropped wherever they stand, when it is found in five
documents that differ: copies and near copies count as one, or they would delete each other.
Which documents differ is told by BANDS classes of each, made of two minima each of the hashes of
its masked five-word shingles (those from each twelfth of the hashes' range on). Documents with the same classes are one; of the rest,
each counts as one through the number of those with which it shares its most common class, so a group of near copies
counts about one, however large it is. Where these counts reach five, and a thousandth of what they leave uncounted more (near copies that share no class), the
template recurs.
So a footer counts on short pages too, in which it makes up half of the words, a footer
of a thousand texts with five copies each counts a thousand times, and copies of one text more change nothing for the others; but where shared lines make up most
of otherwise different pages, these pass for near copies and keep their lines.

Lines, leaves and tokens are compared by 64-bit hashes. Blank lines are never templates. Null
texts count as empty and stay as they are; equal rows (same id and text) are cleaned alike; rows
without an id count like all others. Ids may have any type; other columns come along, and
n_lines and n_dropped replace columns of these names. A text of any length is read whole by one
task, and its lines are rows from then on. Where a split or a constant position is a tie, the
smaller hash or place decides. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import bit_filter, maybe_in, new_root, stash, text_of
from sieveline.llm.shingles import SHINGLE, mixed, raw_text, rolling, word_hashes, word_starts

DEPTH, MIN_DOCS, CONSTANT, SIMILAR, BANDS = 3, 5, 0.8, 0.75, 6
#: Share of near copies that may have no class in common with the others.
STRAY = 0.001
#: Of the filter that picks the texts to read again: 2**26 bits are 8 MB.
FILTER_BITS = 26
#: Up to so many leaves (8 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_LEAVES = 500_000
_DOC = ["doc_id", "copy"]
_FIELD = word_hashes([b"<*>"])[0]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_DIGIT = np.isin(np.arange(256), range(48, 58))
_EDGES = np.arange(2 * BANDS, dtype=np.uint64) * np.uint64(2**64 // (2 * BANDS))


def masked_words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of a text, masked; where each line that isn't blank begins among them; the lines' numbers."""
    b = np.frombuffer(raw, np.uint8)
    starts = word_starts(b)
    h = word_hashes(raw.split(), starts)
    if not len(h):
        return h, starts, starts
    h[np.searchsorted(starts, np.flatnonzero(_DIGIT[b]), "right") - 1] = _FIELD
    line_no = np.searchsorted(np.flatnonzero(b == 10), starts)
    first = np.concatenate(([0], np.flatnonzero(line_no[1:] != line_no[:-1]) + 1))
    return h, first, line_no[first]


def hashed_lines(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line, its token count, the hash of its leaf and its own."""
    n = np.diff(np.append(first, len(h)))
    place = np.arange(len(h)) - np.repeat(first, n)
    line = mixed(np.add.reduceat(mixed(h + place.astype(np.uint64) * _STEP), first) + n.astype(np.uint64)) if len(h) else h
    leaf = n.astype(np.uint64)
    for k in range(DEPTH):
        token = np.where(n > k, h[np.minimum(first + k, max(len(h) - 1, 0))], np.uint64(0)) if len(h) else h
        leaf = mixed(leaf * _STEP + token)
    return n, leaf.view(np.int64), line.view(np.int64)


def classes(h: np.ndarray) -> np.ndarray:
    """The BANDS classes of a text by its words' hashes: near copies agree in most of them, others in few."""
    s = np.sort(rolling(h, min(SHINGLE, max(len(h), 1))))
    least = s[np.searchsorted(s, _EDGES) % len(s)] if len(s) else np.zeros(2 * BANDS, np.uint64)
    return (mixed(least[::2] * _STEP + least[1::2]) >> np.uint64(33)).astype(np.int32)


def masked_lines(docs: DataFrame) -> DataFrame:
    """docs: (doc_id, text). (doc_id, copy, line_no, leaf, line, fresh, classes), a row for each line that isn't blank; fresh if the text has it there first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, parts, kinds = [], [], []
            for k, text in enumerate(b.column("text").to_pylist()):
                h, first, line_no = masked_words(raw_text(text, True))
                _, leaf, line = hashed_lines(h, first)
                fresh = np.zeros(len(line), bool)
                fresh[np.unique(line, return_index=True)[1]] = True
                rows.append(np.full(len(line), k))
                parts.append((line_no, leaf, line, fresh))
                kinds.append(classes(h))
            if parts:
                line_no, leaf, line, fresh = (np.concatenate([p[c] for p in parts]) for c in range(4))
                own = np.repeat(np.stack(kinds), [len(p[0]) for p in parts], axis=0).ravel()
                ends = pa.array(np.arange(len(line) + 1, dtype=np.int32) * BANDS, pa.int32())
                columns = [pa.array(line_no, pa.int32()), pa.array(leaf, pa.int64()), pa.array(line, pa.int64()), pa.array(fresh), pa.ListArray.from_arrays(ends, pa.array(own, pa.int32()))]
                names = [*_DOC, "line_no", "leaf", "line", "fresh", "classes"]
                yield pa.RecordBatch.from_arrays([*b.select([0, 1]).take(pa.array(np.concatenate(rows), pa.int64())).columns, *columns], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("copy"), "text")
    return source.mapInArrow(run, f"doc_id {kind}, copy bigint, line_no int, leaf bigint, line bigint, fresh boolean, classes array<int>")


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which values are in a sorted list."""
    if not len(listed):
        return np.zeros(len(values), bool)
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def lines_below(docs: DataFrame, leaves: DataFrame) -> DataFrame:
    """(path, line, tokens): the different lines below the leaves, with their tokens' hashes.

    Few leaves are broadcast to a second reading of the texts; with many, the lines it yields are joined with them.
    """
    few = leaves.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES
    wanted = docs.sparkSession.sparkContext.broadcast(np.sort(leaves.toPandas()["leaf"].to_numpy(np.int64)) if few else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[int, tuple[int, np.ndarray]] = {}
            for text in b.column("text").to_pylist():
                h, first, _ = masked_words(raw_text(text, True))
                n, leaf, line = hashed_lines(h, first)
                for i in range(len(n)) if wanted.value is None else np.flatnonzero(_among(leaf, wanted.value)):
                    found[int(line[i])] = int(leaf[i]), h[first[i] : first[i] + n[i]].view(np.int64)
            tokens = [t for _, t in found.values()]
            ends = pa.array(np.concatenate(([0], np.cumsum([len(t) for t in tokens], dtype=np.int64))), pa.int32())
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *tokens]), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found.values()], pa.int64()), pa.array(list(found), pa.int64()), pa.ListArray.from_arrays(ends, flat)], names=["path", "line", "tokens"]
            )

    found = docs.select("text").mapInArrow(run, "path bigint, line bigint, tokens array<bigint>").dropDuplicates(["line"])
    return found if few else found.join(leaves.withColumnRenamed("leaf", "path"), "path", "left_semi")


def recurring(rows: DataFrame, key: str) -> DataFrame:
    """rows: (key, classes), one for each document with the key. Keys that MIN_DOCS documents which differ have: (key).

    Sums over the sizes of classes tell most keys: a key is sure where the effective number of classes (the square of the number of documents through the sum of
    squares of the classes' sizes, on average over the bands) reaches MIN_DOCS, and out where a band has fewer classes. Only for
    the rest the different documents are held against their classes.
    """
    often = rows.groupBy(key).count().where(F.col("count") >= MIN_DOCS).select(key)
    # a filter instead of a join: what it lets through by mistake is too rare to recur, and a key that very many rows have is summed up before it is shuffled
    likely = maybe_in(rows.where(F.col(key).isNotNull()), key, bit_filter(often, key, FILTER_BITS), FILTER_BITS)
    sizes = likely.select(key, F.posexplode("classes").alias("band", "class")).groupBy(key, "band", "class").agg(F.count("*").cast("double").alias("size"))
    several = [F.count(F.when(F.col("band") == b, 1)).alias(f"b{b}") for b in range(BANDS)]
    total = sizes.groupBy(key).agg(F.sum("size").alias("s"), F.sum(F.col("size") * F.col("size")).alias("q"), *several)
    sure = F.col("s") * F.col("s") >= F.col("q") * (MIN_DOCS * BANDS)
    total = total.where(F.least(*[F.col(f"b{b}") for b in range(BANDS)]) >= MIN_DOCS).select(key, sure.alias("sure"))
    open_keys = total.where("not sure").select(key)
    kinds = maybe_in(likely, key, bit_filter(open_keys, key, FILTER_BITS), FILTER_BITS).select(key, "classes").distinct()
    each = kinds.select(key, "classes", F.posexplode("classes").alias("band", "class"))
    shared = each.groupBy(key, "band", "class").agg(F.count("*").alias("size"))
    most = each.join(shared, [key, "band", "class"]).groupBy(key, "classes").agg(F.max("size").alias("most"))
    counted = most.groupBy(key).agg(F.sum(1 / F.col("most")).alias("w"), F.count("*").alias("n")).where(F.col("w") + 1e-9 >= MIN_DOCS + (F.col("n") - F.col("w")) * STRAY)
    return total.join(counted.select(key, F.lit(True).alias("counts")), key, "left").where("sure or counts").select(key)


def generalised(lines: DataFrame, root: str) -> DataFrame:
    """lines: (path, line, tokens), all different. (line, template): the lines that fit a template with variable fields."""
    found, k = None, -1
    while True:  # each part is smaller than what it is a part of
        k += 1
        lines = stash(lines, root, f"lines-{k}")
        tokens = lines.select("path", F.posexplode("tokens").alias("at", "token")).groupBy("path", "at", "token").count()
        place = tokens.groupBy("path", "at").agg(
            F.max_by("token", F.struct("count", F.bitwise_not("token"))).alias("top"),
            F.max("count").alias("most"),
            F.sum("count").alias("lines"),
            F.count("*").alias("kinds"),
            F.sum(F.when(F.col("count") >= MIN_DOCS, F.col("count")).otherwise(0)).alias("shared"),
        )
        constant = F.col("most") >= F.col("lines") * CONSTANT
        parting = F.when(~constant & (F.col("shared") > 0), F.struct("shared", (-F.col("kinds")).alias("kinds"), (-F.col("at")).alias("at")))
        paths = (
            place.groupBy("path")
            .agg(
                F.max("lines").alias("lines"),
                F.count("*").alias("n"),
                F.sum(constant.cast("int")).alias("constants"),
                F.transform(F.array_sort(F.collect_list(F.struct("at", F.when(constant, F.col("top")).alias("token")))), lambda x: x["token"]).alias("template"),
                F.max(parting).alias("by"),
            )
            .where(F.col("lines") >= MIN_DOCS)
        )
        paths = stash(paths, root, f"paths-{k}")
        general = F.col("constants") >= F.col("n") * SIMILAR
        fits = F.forall(F.zip_with("tokens", "template", lambda t, c: c.isNull() | (t == c)), lambda x: x)
        fitting = lines.join(paths.where(general).select("path", "template"), "path").where(fits).select("line", F.col("path").alias("template"))
        found = fitting if found is None else found.unionByName(fitting)
        mixed_paths = paths.where(~general & F.col("by").isNotNull()).select("path", (-F.col("by.at")).alias("at"))
        if not mixed_paths.take(1):
            return found
        own = F.element_at("tokens", F.col("at") + 1)
        rare = tokens.where(F.col("count") < MIN_DOCS).select("path", "at", F.col("token").alias("own"), F.lit(True).alias("rare"))
        parted = lines.join(mixed_paths, "path").withColumn("own", own).join(rare, ["path", "at", "own"], "left")
        lines = parted.select(F.xxhash64("path", "at", F.when(F.col("rare").isNull(), F.col("own"))).alias("path"), "line", "tokens")


def dropped_lines(docs: DataFrame, root: str) -> DataFrame:
    """(doc_id, copy, dropped): the numbers of the lines to drop, for documents that have some."""
    lines = stash(masked_lines(docs), root, "lines")
    whole = stash(recurring(lines.where("fresh").select("line", "classes"), "line"), root, "whole")
    found = lines.join(whole, "line", "left_semi").select(*_DOC, "line_no")

    by_class = lines.groupBy("leaf", F.element_at("classes", 1).alias("class")).agg(F.min("line").alias("lo"), F.max("line").alias("hi"))
    leaves = by_class.groupBy("leaf").agg(F.count("*").alias("classes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    leaves = stash(leaves.where(f"lo <> hi and classes >= {MIN_DOCS}").select("leaf"), root, "leaves")
    holders = lines.join(leaves, "leaf", "left_semi").select("copy").distinct()
    held = maybe_in(docs.withColumn("copy", F.xxhash64("doc_id", "text")), "copy", bit_filter(holders, "copy", FILTER_BITS), FILTER_BITS)
    fitting = stash(generalised(lines_below(held, leaves), root), root, "fitting")
    members = lines.join(fitting, "line").select("template", *_DOC, "line_no", "classes")
    general = stash(recurring(members.dropDuplicates(["template", *_DOC]).select("template", "classes"), "template"), root, "general")
    found = found.unionByName(members.join(general, "template", "left_semi").select(*_DOC, "line_no"))
    return found.groupBy(*_DOC).agg(F.collect_set("line_no").alias("dropped"))


def line_dedup(docs: DataFrame, counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """docs with text cut, and the columns counts added (or replaced): of every row its lines and those dropped."""
    root = new_root(docs.sparkSession, "line-dedup")
    dropped = stash(dropped_lines(docs.select("doc_id", "text"), root), root, "dropped").toDF("_ld_id", "_ld_copy", "_ld_dropped")
    same = F.col("doc_id").eqNullSafe(F.col("_ld_id")) & (F.xxhash64("doc_id", "text") == F.col("_ld_copy"))
    hit = F.col("_ld_dropped").isNotNull()
    rows = docs.join(dropped, same, "left").withColumn("_ld_pieces", F.when(hit, F.split(text_of(), "\n")))  # a column, as the lambda below would split the text again for every line
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size("_ld_pieces") - 1), "_ld_dropped"), lambda i: F.get("_ld_pieces", i)), "\n")
    line_ends = F.length(text_of()) - F.length(F.replace(text_of(), F.lit("\n"), F.lit("")))
    added = {
        counts[0]: (line_ends + 1).cast("long"),
        counts[1]: F.when(hit, F.size("_ld_dropped")).otherwise(0).cast("long"),
        "text": F.when(hit, kept).otherwise(F.col("text")),
    }
    return rows.withColumns(added).drop("_ld_id", "_ld_copy", "_ld_dropped", "_ld_pieces")


def digest(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(text_of(), 256).alias("kept_sha256"))
