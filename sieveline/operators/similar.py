"""Joins by likeness, containment and edit distance. Each has an index, so that only pairs that can match meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Added to a ratio where one text holds the other.
BONUS = 0.05
#: Characters of the pieces that containment is looked up by.
GRAM = 4
#: Edit distances found by pieces; names without a match at the last of them meet the whole list, in blocks of BLOCK names.
DISTANCES, BLOCK = (1, 2), 1000


def _token_lists(texts: DataFrame, by: list[str], text: str) -> DataFrame:
    """(by, text, w, k): the words of each text, the k-th time that they stand in it; a text without words has the word ''."""
    words = F.regexp_extract_all(F.col(text), F.lit(r"(?U)([^\s\x1c-\x1f]+)"), F.lit(1))
    each = texts.select(*by, text, F.explode(F.when(F.size(words) > 0, words).otherwise(F.array(F.lit("")))).alias("w"))
    return each.groupBy(*by, text, "w").count().select(*by, text, "w", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))).alias("k"))


def most_alike(left: DataFrame, right: DataFrame, by: list[str], text: str, other: str, key: str, candidate: str, least: float) -> DataFrame:
    """(key, candidate, ratio) of the candidate of the same group with the highest sequence ratio of words, BONUS added where one text holds the other; ties by the candidate. Null texts match nothing.

    A ratio of r asks for at least r / (2 - r) of a text's words in the other one. So texts are
    looked up by their rarest words only, as many as can't all be missing, and a pair's ratio is taken
    only if the words that both hold are enough for it. Equal texts are compared once.
    """
    from sieveline.operators.gates import sequence_ratio  # its functions need a session

    floor = least - BONUS - 1e-6
    if floor <= 0:
        raise ValueError(f"least must be above {BONUS}")
    share = floor / (2 - floor)
    ours = left.where(F.col(text).isNotNull()).select(*by, text).distinct()
    theirs = right.where(F.col(other).isNotNull()).groupBy(*by, other).agg(F.min(candidate).alias("_c"))
    a, b = _token_lists(ours, by, text), _token_lists(theirs, by, other)
    rare = b.groupBy(*by, "w", "k").agg(F.count("*").alias("f"))

    def ordered(tokens: DataFrame, name: str, to: str) -> DataFrame:
        """Each text's words, the rarest first, and those of them that it is looked up by."""
        found = tokens.join(rare, [*by, "w", "k"], "left").groupBy(*by, name).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "w", "k"))).alias(to))
        n = F.size(to)
        return found.withColumn(f"{to}_few", F.slice(to, 1, (n - F.ceil(n * share) + 1).cast("int")))

    x = ordered(a, text, "_a").withColumn("_t", F.explode("_a_few"))
    y = ordered(b, other, "_b").withColumn("_t", F.explode("_b_few"))
    both = F.size("_a") + F.size("_b")
    pairs = x.join(y, [*by, "_t"]).where(2 * F.least(F.size("_a"), F.size("_b")) >= floor * both)
    pairs = pairs.where(F.col("_t") == F.array_min(F.array_intersect("_a_few", "_b_few"))).where(2 * F.size(F.array_intersect("_a", "_b")) >= floor * both)
    bonus = F.when(F.col(text).contains(F.col(other)) | F.col(other).contains(F.col(text)), BONUS).otherwise(0.0)
    scored = pairs.select(*by, text, other, F.round(sequence_ratio(text, other) + bonus, 6).alias("ratio")).where(F.col("ratio") >= least)
    best = scored.join(theirs, [*by, other]).groupBy(*by, text).agg(F.min(F.struct((-F.col("ratio")).alias("r"), F.col("_c").alias("c"))).alias("_best"))
    return left.select(*by, text, key).join(best, [*by, text]).select(key, F.col("_best.c").alias(candidate), (-F.col("_best.r")).alias("ratio"))


def _grams(text: str, sizes: Column) -> Column:
    """All different pieces of the text that are as long as one of the sizes; '' for size 0."""
    of = lambda n: F.when(n == 0, F.array(F.lit(""))).when(F.length(text) < n, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(F.col(text), i, n)))
    return F.array_distinct(F.flatten(F.transform(sizes, of)))


def by_prefix(left: DataFrame, right: DataFrame, by: list[str], text: str, full: str, key: str, candidate: str) -> DataFrame:
    """(key, candidate, score) of the best candidate of the same group: 2 if its full text starts with the text, 1 if it holds it; ties by the candidate. Nulls match nothing.

    Beginnings of full texts, as long as texts of the group are, are an index for the first. What no full text starts with
    is looked up by its rarest piece of GRAM characters, shorter texts by themselves; pairs that share it are compared.
    """
    texts = left.where(F.col(text).isNotNull()).select(*by, text).distinct()
    fulls = right.where(F.col(full).isNotNull()).groupBy(*by, full).agg(F.min(candidate).alias("_c"))

    def sized(rows: DataFrame, size: Column) -> DataFrame:
        return rows.groupBy(*by).agg(F.collect_set(size).alias("_sizes"))

    lengths = sized(texts, F.length(text))
    starts = fulls.join(lengths, by).withColumn("_n", F.explode("_sizes")).where(F.length(full) >= F.col("_n")).select(*by, F.substring(F.col(full), F.lit(1), F.col("_n")).alias(text), "_c")
    first = starts.groupBy(*by, text).agg(F.min("_c").alias("_c")).join(texts, [*by, text], "left_semi").withColumn("score", F.lit(2))

    rest = texts.join(first, [*by, text], "left_anti")
    anchors = rest.withColumn("_g", F.explode(_grams(text, F.array(F.least(F.length(text), F.lit(GRAM))))))
    short = sized(rest, F.least(F.length(text), F.lit(GRAM)))
    pieces = fulls.join(short, by).select(*by, full, "_c", F.explode(_grams(full, F.col("_sizes"))).alias("_g"))
    wanted = anchors.select(*by, "_g").distinct()
    held = pieces.join(wanted, [*by, "_g"], "left_semi").groupBy(*by, "_g").agg(F.count("*").alias("_f"))
    rarest = anchors.join(held, [*by, "_g"], "left").groupBy(*by, text).agg(F.min(F.struct(F.coalesce("_f", F.lit(0)).alias("f"), F.col("_g").alias("g"))).alias("_a"))
    looked = rarest.where("_a.f > 0").select(*by, text, F.col("_a.g").alias("_g"))
    second = looked.join(pieces, [*by, "_g"]).where(F.col(full).contains(F.col(text))).groupBy(*by, text).agg(F.min("_c").alias("_c")).withColumn("score", F.lit(1))
    found = first.unionByName(second)
    return left.select(*by, text, key).join(found, [*by, text]).select(key, F.col("_c").alias(candidate), "score")


def _pieces(name: str, k: int) -> Column:
    """A listed name cut into k + 1 pieces of about the same length: (length of the name, number of the piece, piece); k edits leave one of them whole. Names of k characters at most have one empty piece."""
    n, parts = F.length(name), F.lit(k + 1)
    start = lambda p: F.floor(p * n / parts).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.lit(k)), lambda p: F.struct(n.alias("n"), p.alias("p"), F.substring(F.col(name), start(p) + 1, start(p + 1) - start(p)).alias("s")))
    return F.when(n > k, cut).otherwise(F.array(F.struct(n.alias("n"), F.lit(0).alias("p"), F.lit("").alias("s"))))


def _places(name: str, k: int) -> Column:
    """Where pieces of listed names can stand in a name at most k edits away: for each length within k and each piece, the places within k of its own."""
    n, parts = F.length(name), F.lit(k + 1)

    def of(length: Column) -> Column:
        start = lambda p: F.floor(p * length / parts).cast("int")

        def piece(p: Column) -> Column:
            size = start(p + 1) - start(p)
            at = F.filter(F.sequence(start(p) - k, start(p) + k), lambda i: (i >= 0) & (i + size <= n))
            return F.transform(at, lambda i: F.struct(length.alias("n"), p.alias("p"), F.substring(F.col(name), i + 1, size).alias("s")))

        cut = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(k)), piece))
        return F.when(length > k, cut).otherwise(F.array(F.struct(length.alias("n"), F.lit(0).alias("p"), F.lit("").alias("s"))))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.greatest(n - k, F.lit(0)), n + k), of)))


def best_match(left: DataFrame, name: str, reference: DataFrame, listed: str, order: str) -> DataFrame:
    """left with the listed name at the smallest edit distance as match, and the distance; the first in order wins ties. Null names get none, and null listed names are left out.

    Each different name is looked up once, by pieces at distance 1, then 2. Only names without a match so near meet all
    listed names, in blocks of about BLOCK; that is a long job for many such names and a long list, but no row holds more than a block.
    """
    items = reference.where(F.col(listed).isNotNull()).groupBy(F.col(listed).alias("_n")).agg(F.min(order).alias("_o"))
    names = left.where(F.col(name).isNotNull()).select(name).distinct()
    at = F.struct("_d", "_o", "_n")
    same = names.join(items, F.col(name) == F.col("_n")).select(name, F.struct(F.lit(0).alias("_d"), "_o", "_n").alias("best"))
    found = [same]
    for k in DISTANCES:
        rest = names
        for f in found:
            rest = rest.join(f.select(name), name, "left_anti")
        keys = rest.select(name, F.explode(_places(name, k)).alias("_key"))
        pairs = keys.join(items.select("_n", "_o", F.explode(_pieces("_n", k)).alias("_key")), "_key").select(name, "_n", "_o").distinct()
        near = pairs.withColumn("_d", F.levenshtein(F.col(name), F.col("_n"), k)).where("_d >= 0")
        found.append(near.groupBy(name).agg(F.min(at).alias("best")))
    rest = names
    for f in found:
        rest = rest.join(f.select(name), name, "left_anti")
    count = items.agg(F.ceil(F.count("*") / BLOCK).cast("int")).scalar()
    blocks = items.groupBy(F.pmod(F.xxhash64("_n"), count).alias("_block")).agg(F.collect_list(F.struct("_o", "_n")).alias("_options"))
    every = rest.withColumn("_block", F.explode(F.sequence(F.lit(0), count - 1))).withColumn("_block", F.col("_block").cast("long")).join(blocks, "_block")
    scored = F.transform("_options", lambda x: F.struct(F.levenshtein(F.col(name), x["_n"]).alias("_d"), x["_o"].alias("_o"), x["_n"].alias("_n")))
    found.append(every.select(name, F.array_min(scored).alias("best")).groupBy(name).agg(F.min("best").alias("best")))
    all_found = found[0]
    for f in found[1:]:
        all_found = all_found.unionByName(f)
    return left.join(all_found.select(name, F.col("best._n").alias("match"), F.col("best._d").alias("distance")), name, "left")
