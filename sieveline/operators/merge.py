"""Snapshots merged into what is there: inserts, updates, archives, late rows, purges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """target with the rows of source put in by key."""
    return target.join(source.select(key), key, "left_anti").unionByName(source.select(*target.columns))


def two_phase(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The merged table with state: inserted, updated, kept or archived (vanished; its old values stay)."""
    side = lambda df, p: df.select(key, F.struct(*columns).alias(f"{p}_row"))
    both = side(old, "old").join(side(new, "new"), key, "full")
    state = (
        F.when(F.col("old_row").isNull(), "inserted").when(F.col("new_row").isNull(), "archived").when(F.col("old_row").eqNullSafe(F.col("new_row")), "kept").otherwise("updated")
    )
    return both.select(key, F.coalesce("new_row", "old_row").alias("r"), state.alias("state")).select(key, "r.*", "state")


def preserve(new: DataFrame, old: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """new with columns filled from old where they are missing."""
    kept = old.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    return new.join(kept, key, "left").withColumns({c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"_{c}")) for c in columns}).drop(*[f"_{c}" for c in columns])


def latest(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last entry of each key."""
    w = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return log.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def late_rows(created: DataFrame, date: str, principal: Column, redone: DataFrame, week: str) -> DataFrame:
    """Rows created now with a date before the principal week whose own week isn't made anew in this run."""
    late = created.where(F.col(date) < principal).withColumn(week, F.date_trunc("week", date).cast("date"))
    return late.join(redone.select(week).distinct(), week, "left_anti")


def stale(reports: DataFrame, counts: DataFrame, by: list[str], n: str) -> DataFrame:
    """Windows whose count isn't what their report has, or that have no report."""
    now = counts.select(*by, F.col(n).alias("n_now"))
    return now.join(reports.select(*by, F.col(n).alias("n_then")), by, "left").where(~F.col("n_now").eqNullSafe(F.col("n_then")))


def guarded_purge(target: DataFrame, snapshot: DataFrame, key: str, least: float = 0.5) -> DataFrame:
    """target without the rows that the snapshot lacks, unless the snapshot is empty or has less than this share of the rows: then all stays."""
    held = snapshot.select(key).distinct()
    n, there = held.agg(F.count("*")).scalar(), target.agg(F.count("*")).scalar()
    marked = target.join(held.withColumn("_held", F.lit(True)), key, "left")
    return marked.where(F.col("_held").isNotNull() | (n == 0) | (n < least * there)).drop("_held")


def not_done(rows: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Rows that the manifest lacks; a second run adds nothing."""
    return rows.join(manifest.select(key).distinct(), key, "left_anti")


def reuse(rows: DataFrame, cache: DataFrame, keys: list[str], value: str) -> DataFrame:
    """rows with value from the cache where key and hash are the same, and todo where they aren't."""
    return rows.join(cache.select(*keys, value), keys, "left").withColumn("todo", F.col(value).isNull())


def fresh(cache: DataFrame, status: str, stamp: str, now: Column, terminal: list[str], ttl_days: int) -> DataFrame:
    """Entries that need no second try: a terminal status, or younger than their time to live."""
    return cache.where(F.col(status).isin(*terminal) | (F.date_add(F.col(stamp).cast("date"), ttl_days) >= now))
