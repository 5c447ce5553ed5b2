"""A table kept in parts, of which a merge writes only those that change; readers keep the snapshot they have."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.operators.merge import upsert


class StoredTable:
    """Rows with unique keys under root, dealt to parts by key.

    Each merge writes the parts that have changed keys to a new folder, and then a snapshot: a file of one job, so there
    or not, that names the folder of each part. The snapshot with the highest number counts. A merge that broke off
    leaves no snapshot and can be run again; one writer at a time. Folders that no snapshot needs any more stay for those who read
    them until vacuum(). A snapshot, a row a part, is all that comes to the driver, so parts is bounded by choice, not by the rows.
    """

    SNAPSHOT = "version bigint, at double, parts array<struct<part: bigint, folder: string>>"

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str, parts: int = 256, part_of: Column | None = None):
        """part_of: which part (a whole number) a row belongs to, from its key alone; by default its hash modulo parts."""
        self.spark, self.root, self.schema, self.key = spark, root, schema, key
        self.part = (F.pmod(F.xxhash64(key), F.lit(parts)) if part_of is None else part_of).cast("long")

    def _snapshots(self) -> list:
        there = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/snapshots")
        if not there.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(there):
            return []
        found = self.spark.read.schema(self.SNAPSHOT).json(f"{self.root}/snapshots").withColumn("file", F.input_file_name()).collect()
        return sorted(found, key=lambda s: s["version"])

    def _folders(self, version: int | None = None) -> tuple[int, dict[int, str]]:
        found = [s for s in self._snapshots() if version is None or s["version"] == version]
        if version is not None and not found:
            raise ValueError(f"no snapshot {version}")
        return (found[-1]["version"], {p["part"]: p["folder"] for p in found[-1]["parts"]}) if found else (0, {})

    def _read(self, folders: dict[int, str]) -> DataFrame:
        paths = sorted(f"{self.root}/data/{folder}/part={part}" for part, folder in folders.items())
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def version(self) -> int:
        return self._folders()[0]

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the last snapshot, or of an earlier one that vacuum() has left."""
        return self._read(self._folders(version)[1])

    def merge(self, rows: DataFrame, deleted: DataFrame | None = None) -> int:
        """Put rows in by key and take the keys of deleted out; the number of parts written. Keys of rows are unique and not null; a key in both is put in."""
        version, folders = self._folders()
        gone = (rows.select(self.key).limit(0) if deleted is None else deleted.select(self.key)).withColumn("_part", self.part)
        rows = rows.select(*self._read({}).columns)
        touched = {r["_part"] for r in rows.select(self.part.alias("_part")).union(gone.select("_part")).distinct().collect()}
        if not touched:
            return 0
        kept = self._read({p: f for p, f in folders.items() if p in touched}).join(gone, self.key, "left_anti")
        folder = f"v{version + 1}-{uuid.uuid4().hex}"
        merged = upsert(kept, rows, self.key).withColumn("part", self.part)
        merged.repartition("part").write.partitionBy("part").parquet(f"{self.root}/data/{folder}")
        left = {p: f for p, f in folders.items() if p not in touched}
        # A part that lost its last row has no folder.
        written = self.spark.read.schema(f"{self.schema}, part bigint").parquet(f"{self.root}/data/{folder}").select("part").distinct()
        left |= {r["part"]: folder for r in written.collect()}
        self.spark.createDataFrame([(version + 1, time.time(), sorted(left.items()))], self.SNAPSHOT).coalesce(1).write.mode("append").json(f"{self.root}/snapshots")
        return len(touched)

    def vacuum(self, grace: float = 7 * 86400.0) -> None:
        """Delete snapshots that were replaced more than grace seconds ago, and the parts that only these name."""
        found = self._snapshots()
        old = [a for a, b in zip(found, found[1:], strict=False) if time.time() - b["at"] >= grace]
        needed = {(p["part"], p["folder"]) for s in found if s not in old for p in s["parts"]}
        paths = sorted({(p["part"], p["folder"]) for s in old for p in s["parts"]} - needed)
        for path in [*[s["file"] for s in old], *[f"{self.root}/data/{folder}/part={part}" for part, folder in paths]]:
            p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
