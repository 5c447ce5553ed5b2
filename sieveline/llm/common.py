"""Shared pieces: tables in the cluster's shared folder, word patterns, fixed-size filters."""

from __future__ import annotations

import re
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, and words between it.
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; without spark.checkpoint.dir only a local session (a test) goes on, in a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_root(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sieveline/{name}-{uuid.uuid4().hex}"


def stash(df: DataFrame, root: str, name: str, codec: str = "snappy") -> DataFrame:
    """Write df as a table under root and read it back: lineage ends there, and the table survives lost executors."""
    path = f"{root}/{name}"
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """df, to be joined by a shuffle however small it seems: what a compressed file or exploded rows are taken to be says little of what the driver would hold to broadcast them."""
    return df.hint("merge")


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table of stash() that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Manifest:
    """What a folder of tables holds: an entry (name, batches, gone, at) for each table, written after it by one job of one file, and so there or not.

    A table is live unless a later entry lists it as gone. Of several live tables that hold one batch (two
    writers at once), only the one first by name counts. Entries come to the driver: a few short strings for each table.
    A table that is gone stays on disk, for those who read it still, until vacuum() deletes it.
    """

    SCHEMA = "name string, batches array<string>, gone array<string>, at double"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root}/manifest"

    def _entries(self, path: str | None = None) -> list:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(path or self.path)
        if not there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there):
            return []
        return self.spark.read.schema(self.SCHEMA).json(path or self.path).withColumn("file", F.input_file_name()).collect()

    def live(self) -> dict[str, list[str]]:
        """Live tables by name, and the batches each holds."""
        entries = self._entries()
        gone = {x for e in entries for x in e["gone"]}
        found, seen = {}, set()
        for e in sorted(entries, key=lambda e: (-len(e["batches"]), e["name"])):
            if e["name"] not in gone and not seen & set(e["batches"]):
                found[e["name"]] = list(e["batches"])
                seen |= set(e["batches"])
        return found

    def _write(self, entries: list[tuple]) -> None:
        self.spark.createDataFrame(entries, self.SCHEMA).coalesce(1).write.mode("append").json(self.path)

    def add(self, name: str, batches: list[str], gone: list[str] = ()) -> None:
        self._write([(name, batches, list(gone), time.time())])

    def vacuum(self, folders: list[str], grace: float) -> list[str]:
        """Delete from each of folders the tables that went more than grace seconds ago, and put the entries together in one file; the names of these tables.

        Tables go before their entries do, and old entries after the file that replaces them, so
        a vacuum that broke off leaves the same tables live. Run one at a time.
        """
        entries, now = self._entries(), time.time()
        old = sorted({x for e in entries if now - (e["at"] or 0) >= grace for x in e["gone"]})
        for name in old:
            for folder in folders:
                forget(self.spark, f"{folder}/{name}")
        kept = {e["name"]: (e["name"], list(e["batches"]), [x for x in e["gone"] if x not in old], e["at"]) for e in entries if e["name"] not in old}
        files = {e["file"] for e in entries}
        if kept and len(files) > 1:
            self._write(list(kept.values()))
            for file in files:
                forget(self.spark, file)
        return old


def text_of(col: str | Column = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(col: Column) -> Column:
    """A-Z as a-z; lower() does that for ASCII, and much faster."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, _UPPER, _UPPER.lower()))


def word_count(col: Column) -> Column:
    return F.regexp_count(col, F.lit(WORD)).cast("long")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def filter_slot(key: Column, bits: int) -> Column:
    """Where a key falls in a filter of 2**bits places, from 1."""
    return F.xxhash64(key).bitwiseAND(F.lit((1 << bits) - 1)) + F.lit(1)


def bit_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """A filter over keys[key]: rows (bucket, bitmap), 4 KB each and at most 2**(bits - 15) of them, whatever the keys' number."""
    slot = filter_slot(F.col(key), bits)
    return (
        keys.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
        .groupBy("bucket")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )


def maybe_in(df: DataFrame, key: str, filter_rows: DataFrame, bits: int) -> DataFrame:
    """Rows of df whose key may be in the filter: all that are, few that aren't. The filter's size is fixed by bits, so it is broadcast."""
    slot = filter_slot(F.col(key), bits)
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return (
        df.withColumn("bucket", F.bitmap_bucket_number(slot))
        .join(F.broadcast(filter_rows), "bucket")
        .where(F.call_function("getbit", byte, (at % 8).cast("int")) == 1)
        .drop("bucket", "bitmap")
    )
