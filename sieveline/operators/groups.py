"""Aggregates, windows, sequences and top lists."""

from __future__ import annotations

import re
import tempfile
from collections import Counter
from collections.abc import Iterator
from heapq import nlargest

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def most_common(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """The k commonest values; ties by the values."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by).limit(k)


def mode(df: DataFrame, by: list[str], value: str, least: int = 1) -> DataFrame:
    """The commonest value of each group, the smallest of equals, if it occurs at least so often."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    w = Window.partitionBy(*by).orderBy(F.desc("n"), value)
    return counts.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def longest(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """df with the longest value of its group, the smallest of equals."""
    best = df.groupBy(*by).agg(F.max(F.struct(F.length(value).alias("l"), value)).getField(value).alias(name))
    return df.join(best, by)


def keepers(df: DataFrame, by: list[str], score: list[Column], key: str) -> DataFrame:
    """(loser, keeper, *by): every row of a group but the one whose score comes first; ties by key."""
    w = Window.partitionBy(*by).orderBy(*score, F.col(key))
    ranked = df.withColumn("rn", F.row_number().over(w)).withColumn("keeper", F.first(key).over(w))
    return ranked.where("rn > 1").select(F.col(key).alias("loser"), "keeper", *by)


def first_of(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """The first row of each group in order (which must not tie)."""
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("rn = 1").drop("rn")


def forward_fill(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def context(df: DataFrame, by: list[str], order: list[str], value: str, before: int, after: int, name: str, between: str = " ") -> DataFrame:
    """df with the values from so many rows before to so many after, joined."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-before, after)
    return df.withColumn(name, F.concat_ws(between, F.collect_list(value).over(w)))


def islands(df: DataFrame, by: list[str], order: list[str], breaks: Column, name: str = "island") -> DataFrame:
    """df with the number of its run, from 0; breaks is true where a new run begins."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.sum(breaks.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def merge_runs(df: DataFrame, by: list[str], order: str, joins_next: Column, text: str) -> DataFrame:
    """Rows merged into the next one while joins_next holds: (*by, first, parts, text)."""
    w = Window.partitionBy(*by).orderBy(order)
    starts = ~F.coalesce(F.lag(joins_next).over(w), F.lit(False))
    runs = islands(df.withColumn("_starts", starts), by, [order], F.col("_starts"))
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return runs.groupBy(*by, "island").agg(F.min(order).alias("first"), F.count("*").alias("parts"), F.array_join(F.transform(parts, lambda p: p[text]), " ").alias("text")).drop("island")


def missing_numbers(df: DataFrame, by: list[str], number: str, from_one: bool = True) -> DataFrame:
    """(*by, number) of the numbers from 1 (or the smallest) to the largest that a group lacks."""
    low = F.lit(1) if from_one else F.min(number)
    spans = df.groupBy(*by).agg(low.alias("lo"), F.max(number).alias("hi")).where("lo <= hi")
    all_ = spans.select(*by, F.explode(F.sequence(F.col("lo").cast("int"), F.col("hi").cast("int"))).alias(number))
    return all_.join(df.select(*by, F.col(number).cast("int").alias(number)).distinct(), [*by, number], "left_anti")


def checkpoints(spark) -> None:
    """Checkpoints go to the shared folder in spark.checkpoint.dir; without one, only a local session (a test) goes on, in a folder of its own."""
    if spark.sparkContext.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over all cores, some times over: a file of a few MB is read by one task, and what is made of each of its rows can take long."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def dealt(df: DataFrame, order: list, at: str) -> DataFrame:
    """df in order, range-partitioned and checkpointed, with at: the partition in the bits from 33 on, the place in it below."""
    checkpoints(df.sparkSession)
    return df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()).checkpoint()


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """df with each row's number in order, from 1; only the partitions' sizes meet in one place."""
    rows = dealt(df, order, "_at").withColumn("_part", F.shiftright("_at", 33))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    nth = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(F.broadcast(before), "_part").withColumn(name, nth).drop("_part", "_at", "_before")


#: Rows that greedy_bins() takes as one block.
BIN_ROWS = 10_000


def _next_cut(c: np.ndarray, start: int, total: float, target: int, before: bool) -> int:
    """The first row of the bin after the one that is open at row start and holds total; len(c) if none begins. c: sums of the sizes up to each row."""
    base = (c[start - 1] if start else 0) - total
    if not before:
        return int(min(max(np.searchsorted(c, base + target, "left"), start) + 1, len(c) + 1))
    k = max(np.searchsorted(c, base + target, "right"), start)
    if total <= 0:  # a bin that holds nothing doesn't close
        k = max(k, np.searchsorted(c, base, "right") + 1)
    return int(min(k, len(c)))


def _block_of_bins(c: np.ndarray, target: int, before: bool) -> tuple[list[int], list[float]]:
    """For each row, how many bins close from there on if a bin begins with it, and what the open one holds at the end."""
    m = len(c)
    closed, rest = [0] * (m + 1), [0.0] * (m + 1)
    for k in range(m - 1, -1, -1):
        cut = _next_cut(c, k, 0, target, before)
        none = cut >= m + (not before)
        closed[k], rest[k] = (0, float(c[-1] - (c[k - 1] if k else 0))) if none else (1 + closed[cut], rest[cut])
    return closed, rest


def greedy_bins(df: DataFrame, by: list[str], order: list[str], size: str, target: int, before: bool) -> DataFrame:
    """df with bin, from 0, within each group in order: a bin closes before it would exceed target, or after it has reached it.

    Sizes aren't negative; null counts as 0. Groups of any size are cut into blocks of rows. What a
    block does to a bin that is open where it begins depends only on the row where that bin closes,
    so a block's summary has an entry for each such row, that is, for its first target of size. One
    task a group goes through the summaries; rows are then binned block by block.
    """
    at = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    block = F.shiftright("_at", 33) * (1 << 33) + F.floor(at / BIN_ROWS)
    rows = dealt(df, [*by, *order], "_at").withColumn("_block", block)
    kinds = ", ".join(f"_by{k} {df.schema[c].dataType.simpleString()}" for k, c in enumerate(by))
    keyed = rows.select(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)], "_block", "_at", F.coalesce(F.col(size).cast("double"), F.lit(0.0)).alias("_size"))
    names, columns = [f"_by{k}" for k in range(len(by))], df.columns

    def summed(b: pd.DataFrame) -> pd.DataFrame:
        c = b.sort_values("_at")["_size"].to_numpy().cumsum()
        closed, rest = _block_of_bins(c, target, before)
        most = min(len(c), max(_next_cut(c, 0, 0, target, before), int(np.searchsorted(c, target, "right"))) + 2)
        return b[[*names, "_block"]].iloc[:1].assign(m=len(c), all=c[-1], c=[c[:most]], closed=[closed[: most + 1]], rest=[rest[: most + 1]])

    def carried(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("_block")
        k, total, starts = 0, 0.0, []
        for m, whole, c, closed, rest in zip(g["m"], g["all"], g["c"], g["closed"], g["rest"], strict=True):
            starts.append((k, total))
            cut = _next_cut(np.asarray(c), 0, total, target, before)
            if cut >= m + (not before):
                total += whole
            else:
                k, total = k + 1 + closed[cut], rest[cut]
        return g[[*names, "_block"]].assign(k=[x for x, _ in starts], total=[x for _, x in starts])

    def binned(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("_at")
        k, total, bins = int(b["_k"].iloc[0]), float(b["_total"].iloc[0]), []
        for n in b[size].fillna(0):
            if before and total and total + n > target:
                k, total = k + 1, 0
            bins.append(k)
            total += n
            if not before and total >= target:
                k, total = k + 1, 0
        return b[columns].assign(bin=bins)

    sums = keyed.groupBy(*names, "_block").applyInPandas(summed, f"{kinds}, _block bigint, m bigint, all double, c array<double>, closed array<bigint>, rest array<double>")
    starts = sums.groupBy(*names).applyInPandas(carried, f"{kinds}, _block bigint, k bigint, total double").toDF(*names, "_begun", "_k", "_total")
    same = F.col("_block") == F.col("_begun")
    for c, n in zip(by, names, strict=True):
        same &= F.col(c).eqNullSafe(F.col(n))
    return rows.join(starts, same).groupBy(*by, "_block").applyInPandas(binned, df.withColumn("bin", F.lit(0).cast("long")).schema)


def folded_bins(df: DataFrame, by: list[str], order: str, size: str, most: int, total: int) -> DataFrame:
    """(*by, order, bin): rows in order into bins of at most so many rows and at most so much size together (a larger row has a bin of its own). A fold over each group, so for groups that are small by nature; greedy_bins() has no such bound."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("size"))))
    state = F.struct(F.lit(0).alias("bin"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("sum"), F.array().cast("array<int>").alias("bins"))

    def step(s: Column, x: Column) -> Column:
        full = (s["n"] > 0) & ((s["n"] >= most) | (s["sum"] + x["size"] > total))
        b = s["bin"] + F.when(full, 1).otherwise(0)
        return F.struct(b.alias("bin"), (F.when(full, 0).otherwise(s["n"]) + 1).alias("n"), (F.when(full, F.lit(0).cast("long")).otherwise(s["sum"]) + x["size"]).alias("sum"), F.concat(s["bins"], F.array(b)).alias("bins"))

    g = df.groupBy(*by).agg(rows.alias("rows"))
    zipped = F.arrays_zip(F.col("rows.at").alias("at"), F.aggregate("rows", state, step)["bins"].alias("bin"))
    return g.select(*by, F.explode(zipped).alias("z")).select(*by, F.col("z.at").alias(order), F.col("z.bin").alias("bin"))


def subdivided(df: DataFrame, group: str, finer: Column, target: int, slack: float = 1.4) -> DataFrame:
    """df with shelf: the group, or group and finer where the group has more than slack times target rows."""
    n = F.count("*").over(Window.partitionBy(group))
    return df.withColumn("shelf", F.when(n > target * slack, F.concat_ws("-", group, finer)).otherwise(F.col(group)))


def quota(df: DataFrame, score: list, category: Column, most: int, total: int, by: list[str] = ()) -> DataFrame:
    """The best total rows of each group with at most so many of the category; if too few are left, the best others are put at the end."""
    groups = Window.partitionBy(*by)
    ranked = df.withColumn("_in", category).withColumn("_nth", F.row_number().over(Window.partitionBy(*by, category).orderBy(*score)))
    ranked = ranked.where(F.col("_nth") <= most + total)  # no others can get a place; each partition is cut before the shuffle
    ranked = ranked.withColumn("_over", (F.col("_in") & (F.col("_nth") > most)).cast("int"))
    ranked = ranked.withColumn("place", F.row_number().over(groups.orderBy("_over", *score)))
    return ranked.where(F.col("place") <= total).drop("_in", "_nth", "_over")


def protected_top(df: DataFrame, protected: Column, score: list, k: int) -> DataFrame:
    """All protected rows and the best others, k rows or as many as are protected; in score order."""
    held, others = df.where(F.coalesce(protected, F.lit(False))), df.where(~F.coalesce(protected, F.lit(False)))
    places = F.greatest(F.lit(k) - held.agg(F.count("*")).scalar(), F.lit(0))
    best = others.orderBy(*score).limit(k).withColumn("_place", F.row_number().over(Window.orderBy(*score))).where(F.col("_place") <= places)
    return held.unionByName(best.drop("_place")).orderBy(*score)


def prefix_rollup(df: DataFrame, paths: Column, value: Column) -> DataFrame:
    """(prefix, n, total) over all ancestors of each row's path; paths is an array of them."""
    return df.select(F.explode(paths).alias("prefix"), value.alias("v")).groupBy("prefix").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


def document_frequency(df: DataFrame, terms: Column, most: float = 1.0) -> DataFrame:
    """(term, df): how many rows hold each term, of the terms that at most this share of rows hold. terms is an array."""
    held = df.select(F.explode(F.array_distinct(terms)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return held.where(F.col("df") <= df.agg(F.count("*")).scalar() * most)


def top_terms(words: list[str], extra: list[tuple[str | None, int]], k: int) -> list[tuple[str | None, int]]:
    """The k terms with the highest scores, ties by term, null last: a word counts 1, two words in a row 2, and each of extra its own weight."""
    scores, pairs = Counter(words), Counter(zip(words, words[1:]))
    for term, weight in extra:
        two = tuple(term.split(" ")) if term is not None else ()
        if len(two) == 2 and two in pairs:
            weight += 2 * pairs.pop(two)
        scores[term] += weight
    least = min(nlargest(k, scores.values())[-1:] + [2 * n for n in nlargest(k, pairs.values())[-1:]], default=0) if len(scores) + len(pairs) > k else 0
    kept = [(t, n) for t, n in scores.items() if n >= least] + [(" ".join(t), 2 * n) for t, n in pairs.items() if 2 * n >= least]
    return sorted(kept, key=lambda x: (-x[1], x[0] is None, x[0] or ""))[:k]


def scored_terms(df: DataFrame, key: str, text: Column, word: str, stop: Iterator[str], extra: str, weight: int, k: int) -> DataFrame:
    """(key, term, score, rn) of the k best terms of each row by top_terms(); words are the matches of a Python pattern but for stop. Keys are unique: a row is scored by itself, where it is read."""
    schema = f"{key} {df.schema[key].dataType.simpleString()}, term string, score long, rn long"
    out = (key, "term", "score", "rn")

    def scored(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find, drop = re.compile(word).findall, frozenset(stop)
        for frame in frames:
            rows = []
            for of, body, own in zip(frame[key].tolist(), frame["_text"].tolist(), frame[extra].tolist()):
                words = [w for w in find(body or "") if w not in drop]
                rows += [(of, t, n, i + 1) for i, (t, n) in enumerate(top_terms(words, [(own, weight)], k))]
            yield pd.DataFrame(rows, columns=list(out))

    return df.select(key, text.alias("_text"), extra).mapInPandas(scored, schema)


def rare_terms(df: DataFrame, key: str, terms: Column, most: float) -> DataFrame:
    """(key, term, df) of the terms that at most this share of rows hold."""
    return df.select(key, F.explode(F.array_distinct(terms)).alias("term")).join(document_frequency(df, terms, most), "term")


def letters(n: Column) -> Column:
    """0, 1, … as a, b, …, z, aa, ab, …; up to five letters."""
    out, first = F.lit(""), 0
    for k in range(5):
        place = F.floor((n - first) / 26**k) % 26 + 97
        out = F.concat(F.when(n >= first, F.char(place)).otherwise(""), out)
        first += 26 ** (k + 1)
    return out


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """n rows in an order that depends on the key only."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def rules_score(text: Column, rules: list[tuple[str, str, int]]) -> Column:
    """(label, score) entries of the labels whose patterns the text has, weights added up, best first; ties in the order of the rules."""
    labels = list(dict.fromkeys(name for name, _, _ in rules))
    entries = []
    for k, name in enumerate(labels):
        total = sum((F.when(text.rlike(p), w).otherwise(0) for n, p, w in rules if n == name), F.lit(0))
        entries.append(F.struct((-total).alias("minus"), F.lit(k).alias("nth"), F.lit(name).alias("label")))
    return F.filter(F.array_sort(F.array(*entries)), lambda x: x["minus"] < 0)


def clusters(links: DataFrame) -> DataFrame:
    """links: (a, b). (node, comp): the smallest node that each reaches; labels are checkpointed in spark.checkpoint.dir after each round.
    Both sides of each join are shuffled: a table of labels that a round broadcasts goes through the driver, round after round."""
    checkpoints(links.sparkSession)
    edges = links.select("a", "b").union(links.select("b", "a")).distinct().checkpoint()
    labels = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("comp"))
    while True:
        told = edges.join(labels.hint("merge"), F.col("b") == F.col("node")).select(F.col("a").alias("node"), "comp")
        low = labels.union(told).groupBy("node").agg(F.min("comp").alias("comp"))
        up = labels.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = low.join(up.hint("merge"), "comp", "left").select("node", F.least("comp", F.coalesce("up", "comp")).alias("comp")).checkpoint()
        if not new.join(labels.withColumnRenamed("comp", "old").hint("merge"), "node").where("comp <> old").take(1):
            return new
        labels = new


def shrink_to(df: DataFrame, by: list[str], size: str, total: int, floor: int) -> DataFrame:
    """df with allowed: sizes of each group cut, the largest first and never below floor, until they add up to at most total.

    The same level cuts all that lie above it; it comes from running sums over the sizes in
    descending order.
    """
    w = Window.partitionBy(*by).orderBy(F.desc(size)).rowsBetween(Window.unboundedPreceding, 0)
    g = Window.partitionBy(*by)
    rest = F.sum(size).over(g) - F.sum(size).over(w)
    nth = F.count("*").over(w)
    level = F.floor((F.lit(total) - rest) / nth)
    lead = F.coalesce(F.lead(size).over(Window.partitionBy(*by).orderBy(F.desc(size))), F.lit(0))
    ok = df.withColumn("_level", F.when(level >= lead, level))
    cut = ok.withColumn("_cut", F.greatest(F.max("_level").over(g), F.lit(floor)))
    over = F.sum(size).over(g) > total
    return cut.withColumn("_over", over).withColumn("allowed", F.when(F.col("_over"), F.least(F.col(size), F.col("_cut"))).otherwise(F.col(size))).drop("_level", "_cut", "_over")


def chunks(text: str, most: int, least: int, overlap: int) -> list[str]:
    """A text in chunks of at most so many characters: paragraphs, else sentences, else words are packed; each chunk but the first starts with the tail of the one before; a short last one joins it."""
    units: list[str] = []
    for paragraph in filter(None, (p.strip() for p in re.split(r"\n\s*\n", text))):
        for sentence in [paragraph] if len(paragraph) <= most else filter(None, re.split(r"(?<=[.!?])\s+", paragraph)):
            words = [sentence] if len(sentence) <= most else sentence.split()
            units += [w[k : k + most] for w in words for k in range(0, len(w), most)]
    packed: list[str] = []
    for unit in units:
        if packed and len(packed[-1]) + 1 + len(unit) <= most - (overlap if len(packed) > 1 else 0):
            packed[-1] += " " + unit
        else:
            packed.append(unit)
    if len(packed) > 1 and len(packed[-1]) < least:
        tail = packed.pop()
        packed[-1] += " " + tail
    return [c if not k or not overlap else f"{packed[k - 1][-overlap:]} {c}" for k, c in enumerate(packed)]


def chunked(df: DataFrame, key: str, text: str, most: int, least: int, overlap: int) -> DataFrame:
    """(key, nth, chunk)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, n, c) for k, t in zip(b[key], b[text], strict=True) for n, c in enumerate(chunks(t or "", most, least, overlap))]
            yield pd.DataFrame(rows, columns=[key, "nth", "chunk"], dtype=object)

    return df.select(key, text).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, nth int, chunk string")
