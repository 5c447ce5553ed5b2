"""Structured Streaming: weekly windows, late rows, merges by batch."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Parts of a week that are counted apart, so that a week with a third of all rows is no single task.
SALTS = 16


def root_of(spark: SparkSession, name: str) -> str:
    """A new folder in the one that the cluster shares; without spark.checkpoint.dir only a local session (a test) goes on, in a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/sieveline/{name}-{uuid.uuid4().hex}"


def weekly(events: DataFrame, ts: str, by: list[str], lateness: str = "7 days") -> DataFrame:
    """Counts in weeks from Monday to Sunday; the watermark lets late rows in for so long. Epoch day 0 was a Thursday, hence the start."""
    week = F.window(ts, "7 days", startTime="4 days")
    return events.withWatermark(ts, lateness).groupBy(week.alias("week"), *by).agg(F.count("*").alias("n")).select(F.col("week.start").cast("date").alias("week"), *by, "n")


def run_now(stream: DataFrame, root: str, each, mode: str = "update") -> None:
    """Everything that is there now, batch by batch; a restart with the same root goes on from its checkpoint."""
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).foreachBatch(each).start()
    q.awaitTermination()


def appended_batches(path: str):
    """A foreachBatch function that writes each batch to a folder of its own under path; a repeated batch replaces its folder, and what is there already is not read or written again."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return each


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Of each key, the row of the last batch that has it."""
    log = spark.read.parquet(path)
    rest = [c for c in log.columns if c not in (*keys, "batch")]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, "r.*")


def weekly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly counts of events by type, streamed from the table's files; each batch brings the new counts of the weeks it changes."""
    schema, root = spark.read.parquet(f"{sf_dir}/events.parquet").schema, root_of(spark, "weekly")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/events.parquet*")
    run_now(weekly(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"]), root, appended_batches(f"{root}/log"))
    return latest_rows(spark, f"{root}/log", ["week", "event_type"])


def reported_weeks(events: DataFrame, ts: str, key: str, run: str, salts: int = SALTS) -> DataFrame:
    """(week, salt, run, n_then, n_now) for each part of a week that a batch changes, out of a stream.

    The state of a part holds its count, the run that changed it last, and its count as of the run before; what a run
    that comes later adds to a week is late. run names this run and rises from run to run; a restart under the same name goes on with it.
    """

    def counted(part: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, then, last = state.get if state.exists else (0, 0, "")
        if last != run:
            then = n
        n += sum(len(b) for b in batches)
        state.update((n, then, run))
        yield pd.DataFrame({"week": [part[0]], "salt": [part[1]], "run": [run], "n_then": [then], "n_now": [n]})

    week = F.date_trunc("week", ts).cast("date").alias("week")
    rows = events.where(F.col(ts).isNotNull()).select(week, F.pmod(F.xxhash64(key), F.lit(salts)).alias("salt"))
    return rows.groupBy("week", "salt").applyInPandasWithState(
        counted, "week date, salt bigint, run string, n_then bigint, n_now bigint", "n bigint, n_then bigint, run string", "update", GroupStateTimeout.NoTimeout
    )


def stale_reports(log: DataFrame, run: str) -> DataFrame:
    """(week, n_now, n_then) of the weeks that this run changed: n_then is what the runs before it had reported, null for a week that is new.

    log: all rows that reported_weeks() brought, with the batch of each.
    """
    last = log.where(F.col("run") <= run).groupBy("week", "salt").agg(F.max_by(F.struct("run", "n_then", "n_now"), "batch").alias("r")).select("week", "r.*")
    then = F.when(F.col("run") == run, F.col("n_then")).otherwise(F.col("n_now"))
    weeks = last.groupBy("week").agg(F.sum("n_now").alias("n_now"), F.nullif(F.sum(then), F.lit(0)).alias("n_then"), F.max("run").alias("run"))
    return weeks.where(F.col("run") == run).select("week", "n_now", "n_then")


def stale_by_runs(spark: SparkSession, first: DataFrame, late: DataFrame, ts: str, key: str) -> DataFrame:
    """Two runs over one checkpoint: first is reported, then late arrives; the weeks whose report it makes stale."""
    root = root_of(spark, "stale")
    for run, rows in (("1", first), ("2", late)):
        rows.select(key, F.col(ts).cast("timestamp").alias(ts)).write.mode("append").parquet(f"{root}/events")
        stream = spark.readStream.schema(spark.read.parquet(f"{root}/events").schema).parquet(f"{root}/events")
        run_now(reported_weeks(stream, ts, key, run), root, appended_batches(f"{root}/log"))
    return stale_reports(spark.read.parquet(f"{root}/log"), "2")
