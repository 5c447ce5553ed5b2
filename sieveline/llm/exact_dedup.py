"""Exact dedup by a log-structured merge index of text digests.

Digest rows come in batches. A batch fills memtables, one for each range of digests and so
many that each holds about MEMTABLE rows; flushing them leaves a run: one row per digest, with
its smallest id and its number of rows, in files sorted by digest, and beside it a filter of fixed
size over its digests. A manifest entry, written last, makes the run part of the index, so a batch whose
write broke off is written again and a batch that is there already changes nothing.

When a level has FANOUT runs, compaction merges them into one run of the next level, which keeps
the smallest id of each digest and adds up the rows. A lookup asks the filters of the runs first,
and joins only what they let through with the runs themselves.

exact_dedup() indexes a table in batches and looks all of its digests up. Digests that more than
one row has are hits; a fixed-size bit filter over the hits picks the texts that are worth moving,
and these are grouped by their whole bytes, so equal digests of unequal texts never merge.
new_texts() tells which rows of a later table the indexed texts hold already, with the same check.

Null texts count as empty; rows with equal ids are rows of their own, and of a group whose smallest id
several rows have, all those rows are kept; ids are integers (others are cast to long); a text of any length is hashed
whole by one task; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import BLANK, Manifest, bit_filter, maybe_in, new_root, stash, text_of

MEMTABLE, FANOUT, FILTER_BITS = 4_000_000, 4, 26


def normalised(text: str = "text") -> Column:
    """The text with every run of ASCII white space as one space."""
    return F.regexp_replace(text_of(text), BLANK, " ")


def sha256(col: Column) -> Column:
    return F.unhex(F.sha2(col, 256))


class DigestIndex:
    """Runs below root, in levels; digests, ids and counts only, never texts."""

    def __init__(self, spark: SparkSession, root: str, memtable: int = MEMTABLE, fanout: int = FANOUT, filter_bits: int = FILTER_BITS):
        self.spark, self.root, self.memtable, self.fanout, self.bits = spark, root, memtable, fanout, filter_bits
        self.manifest = Manifest(spark, root)

    def runs(self) -> list[tuple[str, int, list[str]]]:
        """The live runs: name, level and the batches they hold. A name or two a batch; compaction keeps them few."""
        return sorted((name, int(name.split("-")[0]), batches) for name, batches in self.manifest.live().items())

    def batches(self) -> set[str]:
        return {b for _, _, batches in self.runs() for b in batches}

    def _flush(self, name: str, rows: DataFrame, memtables: int) -> DataFrame:
        """Write rows (digest, id, n) as a sorted run and its filter; both count once the manifest has the name."""
        run = rows.repartitionByRange(memtables, "digest").sortWithinPartitions("digest")
        run.write.option("parquet.bloom.filter.enabled#digest", "true").option("parquet.bloom.filter.adaptive.enabled", "true").parquet(f"{self.root}/runs/{name}")
        bit_filter(self._run(name), "digest", self.bits).coalesce(1).write.parquet(f"{self.root}/filters/{name}")
        return self._run(name)

    def _run(self, name: str) -> DataFrame:
        return self.spark.read.schema("digest binary, id bigint, n bigint").parquet(f"{self.root}/runs/{name}")

    def append(self, batch: str, rows: DataFrame, hits: str | None = None) -> None:
        """rows: (digest, id). The batch becomes a run of level 0, unless the index has it; then levels that are full are compacted.

        hits names a folder for the digests that the batch holds twice or that runs before it hold; it is written before the batch counts.
        """
        if batch in self.batches():
            return
        before = [r[0] for r in self.runs()]
        memtables = 1 + rows.count() // self.memtable
        run = rows.groupBy("digest").agg(F.min("id").alias("id"), F.count("*").alias("n"))
        name = f"0-{uuid.uuid4().hex}"
        own = self._flush(name, run, memtables)
        if hits:
            own.where("n > 1").select("digest").union(self.lookup(own, before).select("digest")).write.mode("overwrite").parquet(hits)
        self.manifest.add(name, [batch])
        self.compact()

    def compact(self) -> None:
        """Merge the runs of each level that has fanout of them, from the lowest up."""
        level = 0
        while True:
            live = self.runs()
            full = [r for r in live if r[1] == level]
            if len(full) >= self.fanout:
                names, batches = [r[0] for r in full], sorted(b for r in full for b in r[2])
                merged, name = self.merged(names), f"{level + 1}-{uuid.uuid4().hex}"
                rows = sum(self._run(n).count() for n in names)
                self._flush(name, merged, 1 + rows // self.memtable)
                self.manifest.add(name, batches, names)
            if level >= max((r[1] for r in live), default=0):
                return
            level += 1

    def vacuum(self, grace: float = 7 * 86400.0) -> None:
        """Delete runs that were merged into others more than grace seconds ago, and their filters."""
        self.manifest.vacuum([f"{self.root}/runs", f"{self.root}/filters"], grace)

    def merged(self, names: list[str] | None = None) -> DataFrame:
        """(digest, id, n) of runs together: the smallest id and the number of rows of each digest."""
        rows = self.spark.createDataFrame([], "digest binary, id bigint, n bigint")
        for name in [r[0] for r in self.runs()] if names is None else names:
            rows = rows.unionByName(self._run(name))
        return rows.groupBy("digest").agg(F.min("id").alias("id"), F.sum("n").alias("n"))

    def lookup(self, rows: DataFrame, runs: list[str] | None = None) -> DataFrame:
        """rows: (..., digest). (digest, id, n) for the digests of rows that some run (of these, or of all) holds. A run is read only for digests that its filter lets through."""
        found = self.spark.createDataFrame([], "digest binary, id bigint, n bigint")
        wanted = rows.select("digest")
        for name in [r[0] for r in self.runs()] if runs is None else runs:
            likely = maybe_in(wanted, "digest", self.spark.read.parquet(f"{self.root}/filters/{name}"), self.bits).distinct()
            found = found.unionByName(self._run(name).join(likely, "digest", "left_semi"))
        return found.groupBy("digest").agg(F.min("id").alias("id"), F.sum("n").alias("n"))


def new_texts(index: DigestIndex, old: DataFrame, new: DataFrame, text: str = "text", doc_id: str = "doc_id", digest=sha256) -> DataFrame:
    """(doc_id, known_id): of each row of new, the smallest id of an equal text in old, the table that index holds; null if there is none.

    Texts of old are read only for digests that the lookup finds, and compared by their bytes.
    """
    root = new_root(new.sparkSession, "new-texts")
    rows = stash(new.select(F.col(doc_id).cast("long").alias("id"), normalised(text).alias("body")).withColumn("digest", digest(F.col("body"))), root, "rows")
    hits = stash(index.lookup(rows).select("digest"), root, "hits")
    bodies = old.select(F.col(doc_id).cast("long").alias("id"), normalised(text).alias("body")).withColumn("digest", digest(F.col("body")))
    known = maybe_in(bodies, "digest", bit_filter(hits, "digest", index.bits), index.bits).groupBy("digest", "body").agg(F.min("id").alias("known_id"))
    return rows.join(known, ["digest", "body"], "left").select(F.col("id").alias("doc_id"), "known_id")


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", batches: int = 4, filter_bits: int = FILTER_BITS, digest=sha256, memtable: int = MEMTABLE) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of docs.

    The table is indexed in so many batches. filter_bits fixes the size of the filters (2**26 bits:
    8 MB, about 17 MB once hashed for a join); when one fills up, more texts are moved, and the
    result stays the same. digest and memtable are parameters for tests.
    """
    spark = docs.sparkSession
    root = new_root(spark, "exact-dedup")
    source = docs.select(F.col(doc_id).cast("long").alias("id"), normalised(text).alias("body"))
    rows = source.select("id", digest(F.col("body")).alias("digest"), sha256(F.col("body")).alias("sha"))
    rows = stash(rows if digest is not sha256 else rows.drop("sha"), root, "rows")
    sha = F.col("sha" if "sha" in rows.columns else "digest").alias("sha")

    index = DigestIndex(spark, root, memtable, filter_bits=filter_bits)
    for k in range(batches):
        index.append(f"{k:03d}", rows.where(F.pmod(F.xxhash64("id"), F.lit(batches)) == k).select("digest", "id"), f"{root}/hits/batch={k}")
    hits = spark.read.schema("digest binary, batch int").parquet(f"{root}/hits").select("digest")

    suspects = maybe_in(source.withColumn("digest", digest(F.col("body"))), "digest", bit_filter(hits, "digest", filter_bits), filter_bits)
    texts = suspects.groupBy("digest", "body").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    verified = stash(texts.select("digest", "keep_id", "group_size"), root, "verified")

    clash = verified.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest")
    if not clash.take(1):
        found = rows.join(verified, "digest", "left").withColumn("sha", sha)
    else:  # unequal texts under one digest: these rows find their group by the text itself
        own = suspects.join(clash, "digest", "left_semi").withColumn("sha", sha256(F.col("body")))
        single = rows.join(clash, "digest", "left_anti").join(verified, "digest", "left").withColumn("sha", sha)
        found = single.unionByName(own.join(texts, ["digest", "body"]).drop("body"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.coalesce("keep_id", "id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("keep_id", "id").eqNullSafe(F.col("id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
