"""Gates that compare a text with what a pass made of it, word by word, in Arrow batches.

Two texts are cut at anchors: words that stand once in each, as many as are in the same order in both. Only what lies between two anchors
is compared by longest common blocks, and cut again where it is long, so a long text takes time in proportion to its length.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs of words up to which two stretches are compared by longest common blocks. A longer stretch without an anchor counts as replaced.
SMALL = 1_000_000


def anchors(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of words that stand once in a and once in b, in the longest run that increases in both."""
    once_a, once_b = Counter(a), Counter(b)
    at = {w: j for j, w in enumerate(b) if once_b[w] == 1}
    pairs = [(i, at[w]) for i, w in enumerate(a) if once_a[w] == 1 and w in at]
    ends: list[int] = []  # the least last place of a run of each length, and which pair it is
    of: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        n = bisect_left(ends, j)
        back[k] = of[n - 1] if n else -1
        ends[n : n + 1], of[n : n + 1] = [j], [k]
    run, k = [], of[-1] if of else -1
    while k >= 0:
        run.append(pairs[k])
        k = back[k]
    return run[::-1]


def changes(a: list[str], b: list[str]) -> Iterator[tuple[str, int, int]]:
    """(what, words of a, words of b) of the stretches that make b of a: equal, delete, insert or replace, in no order."""
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        if i < i_end and j < j_end and (i_end - i) * (j_end - j) <= SMALL:
            for what, p, q, r, s in SequenceMatcher(None, a[i:i_end], b[j:j_end], autojunk=False).get_opcodes():
                yield what, q - p, s - r
            continue
        start, end = i, i_end
        while i < i_end and j < j_end and a[i] == b[j]:
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
        if same := i - start + end - i_end:
            yield "equal", same, same
        if i == i_end or j == j_end:
            if i < i_end or j < j_end:
                yield "delete" if i < i_end else "insert", i_end - i, j_end - j
        elif (i_end - i) * (j_end - j) <= SMALL:
            todo.append((i, i_end, j, j_end))
        elif cuts := anchors(a[i:i_end], b[j:j_end]):
            edges = [(i, j), *((i + x, j + y) for x, y in cuts), (i_end, j_end)]
            todo += [(p, q, r, s) for (p, r), (q, s) in zip(edges, edges[1:], strict=False)]
        else:
            yield "replace", i_end - i, j_end - j


def ratio(a: list[str], b: list[str]) -> float:
    """2 M / T of two lists of words, M being the equal ones."""
    total = len(a) + len(b)
    return 2 * sum(n for what, n, _ in changes(a, b) if what == "equal") / total if total else 1.0


@F.pandas_udf("double")
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2 M / T over the words of both texts."""
    return pd.Series([ratio(x.split(), y.split()) for x, y in zip(a.fillna(""), b.fillna(""), strict=True)])


@F.pandas_udf("array<double>")
def edit_shares(a: pd.Series, b: pd.Series) -> pd.Series:
    """Of the words of a: the share deleted, the number replaced, and the number that b adds."""
    out = []
    for x, y in zip(a.fillna(""), b.fillna(""), strict=True):
        x, y = x.split(), y.split()
        n = Counter()
        for what, p, q in changes(x, y):
            n[what] += max(p, q)
        out.append([n["delete"] / max(len(x), 1), float(n["replace"]), float(n["insert"])])
    return pd.Series(out)


def fidelity(df: DataFrame, key: str, before: str, after: str, ratio: float = 0.85) -> DataFrame:
    """(key, same_digits, length_ok, ratio, passed): the same digits in the same order and no new number, 0.9 to 1.1 of the length, and the ratio. Cheap tests come first; the ratio is taken only where they pass."""
    numbers = lambda c: F.regexp_extract_all(F.coalesce(F.col(c), F.lit("")), F.lit("([0-9]+)"), F.lit(1))
    digits = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    share = F.length(after) / F.greatest(F.length(before), F.lit(1))
    cheap = df.select(key, before, after, ((digits(F.col(before)) == digits(F.col(after))) & (F.size(F.array_except(numbers(after), numbers(before))) == 0)).alias("same_digits"), share.between(0.9, 1.1).alias("length_ok"))
    tried = cheap.withColumn("a", F.when(F.col("same_digits") & F.col("length_ok"), F.col(before))).withColumn("b", F.when(F.col("a").isNotNull(), F.col(after)))
    rated = tried.withColumn("r", sequence_ratio("a", "b")).withColumn("ratio", F.when(F.col("a").isNotNull(), F.col("r")))
    return rated.select(key, "same_digits", "length_ok", "ratio", F.coalesce(F.col("ratio") >= ratio, F.lit(False)).alias("passed"))


def deletion_only(df: DataFrame, key: str, before: str, after: str, most: float = 0.3, replaced: int = 3) -> DataFrame:
    """(key, passed): after is before with at most this share deleted, so few words replaced, and nothing added."""
    shares = df.select(key, edit_shares(before, after).alias("s"))
    return shares.select(key, ((F.get("s", F.lit(0)) <= most) & (F.get("s", F.lit(1)) <= replaced) & (F.get("s", F.lit(2)) == 0)).alias("passed"))
