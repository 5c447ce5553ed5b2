"""Joins beyond the plain ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def anti_any(left: DataFrame, right: DataFrame, key_sets: list[list[str]]) -> DataFrame:
    """Rows of left that match right on none of the key sets; one anti join a set, so no join has an OR."""
    return reduce(lambda df, keys: df.join(right.select(*keys).distinct(), keys, "left_anti"), key_sets, left)


def full_diff(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, change): new, vanished, changed or equal; nulls are equal to nulls."""
    row = F.struct(*columns)
    o, n = old.select(key, row.alias("old_row")), new.select(key, row.alias("new_row"))
    change = F.when(F.col("old_row").isNull(), "new").when(F.col("new_row").isNull(), "vanished").when(F.col("old_row").eqNullSafe(F.col("new_row")), "equal").otherwise("changed")
    return o.join(n, key, "full").select(key, change.alias("change"))


def in_both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows that both sides hold, null equal to null. Rows are grouped, where INTERSECT would send all rows of a common value to one task of a semi-join."""
    sides = left.withColumn("_left", F.lit(True)).unionByName(right.withColumn("_left", F.lit(False)))
    return sides.groupBy(*left.columns).agg(F.bool_or("_left").alias("_a"), F.bool_and("_left").alias("_b")).where("_a and not _b").drop("_a", "_b")


def only_once(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys no other row has."""
    return df.join(df.groupBy(*keys).count().where("count = 1").drop("count"), keys, "left_semi")


def exact_else_unique(left: DataFrame, right: DataFrame, exact: str, name: str, value: str) -> DataFrame:
    """left with value: of the right row with the same exact key; else of the one with the same name, if that name is the only one on both sides."""
    first = right.where(F.col(exact).isNotNull()).groupBy(exact).agg(F.min(value).alias("_exact"))
    second = only_once(right.select(name, F.col(value).alias("_named")), [name])
    alone = left.groupBy(name).agg((F.count("*") == 1).alias("_alone"))
    joined = left.join(first, exact, "left").join(alone, name, "left").join(second, name, "left")
    return joined.withColumn(value, F.coalesce("_exact", F.when(F.col("_alone"), F.col("_named")))).drop("_exact", "_named", "_alone")


def by_row_index(left: DataFrame, right: DataFrame, by: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """Rows of groups that are equally large on both sides, paired in order; other groups have no pairs."""
    def nth(df: DataFrame, order: list[str]) -> DataFrame:
        return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).withColumn("_all", F.count("*").over(Window.partitionBy(*by)))

    return nth(left, left_order).join(nth(right, right_order), [*by, "_nth", "_all"]).drop("_nth", "_all")


def without_orphan_suffixes(files: DataFrame, by: list[str], name: str, key: str) -> DataFrame:
    """files where a name ending in ' (N)' gives that up if its folder has no file of the bare name; of several, the one with the smallest key."""
    bare = F.regexp_replace(name, r" \([0-9]+\)$", "")
    suffixed = files.where(bare != F.col(name)).withColumn("_bare", bare)
    free = suffixed.join(files.select(*by, F.col(name).alias("_bare")).distinct(), [*by, "_bare"], "left_anti")
    first = free.groupBy(*by, "_bare").agg(F.min(key).alias(key)).select(key, "_bare")
    return files.join(first, key, "left").withColumn(name, F.coalesce("_bare", name)).drop("_bare")


def cascade(left: DataFrame, right: DataFrame, steps: list[tuple[str, bool]], value: str) -> DataFrame:
    """left with value and step: from the first key of steps that finds a row of right.

    A weak key (True) counts only where it is unique on the right; a strong key takes the
    smallest value.
    """
    found, used = None, None
    for k, (key, weak) in enumerate(steps):
        side = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(f"v{k}"), F.count("*").alias("n"))
        side = side.where("n = 1") if weak else side
        left = left.join(side.drop("n"), key, "left")
        found = F.col(f"v{k}") if found is None else F.coalesce(found, F.col(f"v{k}"))
        used = F.when(F.col(f"v{k}").isNotNull(), key) if used is None else used.when(F.col(f"v{k}").isNotNull(), key)
    return left.withColumn(value, found).withColumn("step", used).drop(*[f"v{k}" for k in range(len(steps))])


def positional(left: DataFrame, right: DataFrame, key: str, left_order: list[str], right_order: list[str]) -> DataFrame:
    """The k-th row of a key on the left with the k-th on the right; leftovers of either side stay alone."""
    nth = lambda df, order: df.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return nth(left, left_order).join(nth(right, right_order), [key, "nth"], "full")


def interval(points: DataFrame, ranges: DataFrame, at: str, low: str, high: str, width: int, by: list[str] = ()) -> DataFrame:
    """Pairs with low <= at <= high, all dates; ranges are dealt into bins of width days, so it is an equality join."""
    day = lambda c: F.floor(F.unix_date(F.col(c)) / width)
    binned = ranges.where(F.col(low) <= F.col(high)).withColumn("bin", F.explode(F.sequence(day(low), day(high))))
    return points.withColumn("bin", day(at)).join(binned, ["bin", *by]).where(F.col(at).between(F.col(low), F.col(high))).drop("bin")


def either(rows: DataFrame, key: str, same: list[str], near: Column, day: str, width: int) -> DataFrame:
    """(key, n, key_sum): how many other rows each row meets, and the sum of their keys. A row meets those that agree with it in the columns same, and, if near holds for it, those
    of its day and of the width days before; one that it meets in both ways counts once. Keys are unique and whole; null columns agree with nothing; rows that meet none are left out.

    Groups and days are summed up first, so no pairs of rows of a large group or day are made: what a row meets in both ways is
    the sum of its own group within its days, and is taken off again.
    """
    sums = lambda c: (F.count("*").alias(f"{c}_n"), F.sum(key).alias(f"{c}_s"))

    def reached(totals: DataFrame, by: list[str], c: str) -> DataFrame:
        spread = totals.withColumn("_day", F.explode(F.transform(F.sequence(F.lit(0), F.lit(width)), lambda k: F.date_add(day, k))))
        return spread.groupBy(*by, "_day").agg(F.sum(f"{c}_n").alias(f"{c}_n"), F.sum(f"{c}_s").alias(f"{c}_s"))

    own = rows.select(key, *same, day, F.when(near, F.col(day)).alias("_day")).where(F.col(key).isNotNull())
    groups = own.groupBy(*same).agg(*sums("g"))
    days = reached(own.where(F.col(day).isNotNull()).groupBy(day).agg(*sums("d")), [], "d")
    both = reached(own.where(F.col(day).isNotNull()).groupBy(*same, day).agg(*sums("b")), same, "b")
    met = own.join(groups, same, "left").join(days, "_day", "left").join(both, [*same, "_day"], "left")
    # a row meets itself by its group and by its day, and by both
    total = lambda c, itself: sum((F.coalesce(F.col(f"{x}_{c}") - itself, F.lit(0)) * sign for x, sign in (("d", 1), ("b", -1))), F.coalesce(F.col(f"g_{c}") - itself, F.lit(0)))
    return met.select(key, total("n", F.lit(1)).alias("n"), total("s", F.col(key)).alias("key_sum")).where("n > 0")


def neighbours(rows: DataFrame, by: list[str], order: str, date: str) -> DataFrame:
    """before and after: the last date of a smaller order and the first of a larger one that rows of the group have."""
    w = Window.partitionBy(*by).orderBy(order)
    return rows.withColumn("before", F.max(date).over(w.rangeBetween(Window.unboundedPreceding, -1))).withColumn("after", F.min(date).over(w.rangeBetween(1, Window.unboundedFollowing)))


def token_subset(left: DataFrame, right: DataFrame, tokens: str, right_tokens: str, value: str) -> DataFrame:
    """left with value of the only row of right whose tokens hold all of its own. Joined on one token of each left row, its smallest."""
    right_rows = right.select(F.col(right_tokens).alias("_all"), F.col(value).alias("_value"), F.explode(F.array_distinct(right_tokens)).alias("_token"))
    keyed = left.withColumn("_token", F.array_min(tokens)).withColumn("_row", F.xxhash64(tokens))
    pairs = keyed.select("_row", tokens, "_token").distinct().join(right_rows, "_token").where(F.size(F.array_except(tokens, "_all")) == 0)
    one = pairs.groupBy("_row").agg(F.min("_value").alias(value), F.count_distinct("_value").alias("n")).where("n = 1").drop("n")
    return keyed.join(one, "_row", "left").drop("_row", "_token")


def confront(ours: DataFrame, theirs: DataFrame, exact: str, normal: str, key: str) -> DataFrame:
    """ours with a level: binary (theirs have the same bytes), internal (a smaller key of ours has the same text), text (theirs have the same normal form), empty or missing."""
    theirs_exact = theirs.select(exact).distinct().withColumn("_exact", F.lit(True))
    theirs_normal = theirs.where(F.col(normal) != "").select(normal).distinct().withColumn("_normal", F.lit(True))
    first = F.row_number().over(Window.partitionBy(normal).orderBy(key)) == 1
    level: Column = (
        F.when(F.col("_exact"), "binary").when(F.col(normal) == "", "empty").when(~F.col("_first"), "internal").when(F.col("_normal"), "text").otherwise("missing")
    )
    return ours.withColumn("_first", first).join(theirs_exact, exact, "left").join(theirs_normal, normal, "left").withColumn("level", level).drop("_first", "_exact", "_normal")


def parents(rows: DataFrame, path: str, separator: str = "/") -> DataFrame:
    """rows with parent: the longest existing ancestor of its path, null for roots."""
    cut = rows.select(path).distinct().withColumn("_up", F.slice(F.split(path, separator), 1, F.size(F.split(path, separator)) - 1))
    ups = cut.where(F.size("_up") > 0).select(path, F.posexplode(F.transform(F.sequence(F.lit(1), F.size("_up")), lambda k: F.array_join(F.slice("_up", 1, k), separator))).alias("_depth", "_parent"))
    there = rows.select(F.col(path).alias("_parent")).distinct()
    best = ups.join(there, "_parent").groupBy(path).agg(F.max_by("_parent", "_depth").alias("parent"))
    return rows.join(best, path, "left")
