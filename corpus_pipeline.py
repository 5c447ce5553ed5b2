"""A training-data pipeline over the table documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Rows whose ids repeat are judged by their own texts, except that all
rows of an id go where one is toxic or leaks; null texts count as empty and stay. Of near copies that tie
the smallest id stays, and all its rows. Texts of any length are read whole; extra columns come
along, and only epoch, n_words and target are replaced, at the end. Ids to drop are joined by shuffles, not by way of the driver. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import WORD, dealt, documents, new_root, stash, text_of
from sieveline.llm.decontamination import decontaminate
from sieveline.llm.line_dedup import line_dedup
from sieveline.llm.mixing import mix
from sieveline.llm.near_dedup import near_dedup
from sieveline.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models predict toxic go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go; n_chars follows the text. Every document stays."""
    cleaned = line_dedup(docs, counts=("_all_lines", "_cut_lines"))
    n_chars = F.when(F.col("_cut_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", n_chars).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays; documents without words stay."""
    copies = near_dedup(docs).where("not kept").select("doc_id").distinct()
    return docs.join(dealt(copies), "doc_id", "left_anti").select(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document: its columns, epoch (from 1), n_words and target (which replace columns of these names). The one document a source's budget ends in is cut there."""
    rows = mix(docs, keep=docs.columns).where("taken > 0")
    epochs = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    rows = rows.select("size", "taken", "target", "kept", F.explode(epochs).alias("epoch"))
    n_words = F.least(F.col("size"), F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    cut = F.array_join(F.slice(F.regexp_extract_all(text_of("kept.text"), F.lit(WORD), F.lit(0)), 1, n_words.cast("int")), " ")
    own = [F.col(f"kept.`{c}`") for c in docs.columns if c not in ("text", "epoch", "n_words", "target")]
    text = F.when(n_words < F.col("size"), cut).otherwise(F.col("kept.text"))
    return rows.select(*own, text.alias("text"), "epoch", n_words.alias("n_words"), "target")


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_recurring_lines),
    ("near dedup", without_near_copies),
    ("decontamination", without_leaks),
    ("mixing", mixed),
]

#: Models and signatures of the first stages aren't SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again for the next."""
    docs, root = documents(spark, sf_dir), new_root(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, root, f"stage{k}")
    return docs
