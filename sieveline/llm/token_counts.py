"""Token totals by source, language and tokenizer version, kept up to date by signed deltas.

A batch is a set of changes: inserts (+), deletes (-) and revisions (- the old count, + the new
one). commit() adds a batch up, writes it as a table and enters it in the manifest. A batch is
committed once its entry is there: a try that broke off before that left nothing that counts,
and a commit of an id that has an entry already, whatever it brings, changes nothing. Totals are the
sum of all committed batches. fold() replaces their tables by one with their sums, which holds
the ids of them all, so a late retry of a folded batch changes nothing either. The old tables stay
for totals that were taken before, until vacuum() deletes what has been replaced for long enough.

Null sources and languages are groups of their own, null and empty texts have no tokens, a text of any length is
counted whole by one task, a repeated row counts as often as it is there, other columns are not
looked at, and an empty table commits as no change.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import Manifest, text_of

KEYS = ("source", "lang", "version")
_SCHEMA = "source string, lang string, version string, n_docs bigint, n_tokens bigint"
TOKENIZERS = "/opt/tokenizers"

# Fixed value: the pattern that parts a text before the merges of these vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def rank_tokens(spark: SparkSession, version: str, text: str | Column = "text", folder: str = TOKENIZERS) -> Column:
    """Token counts by a public vocabulary of byte-level BPE, <folder>/<version>.tiktoken. The file (about 1 MB) is read by the driver and broadcast."""
    with open(f"{folder}/{version}.tiktoken", "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.value.splitlines())}
        t = tiktoken.Encoding(version, pat_str=SPLIT, mergeable_ranks=merges, special_tokens={})
        for texts in batches:
            yield pd.Series([len(t.encode_ordinary(x)) for x in texts], dtype="int64")

    return count(text_of(text))


def bpe_tokens(path: str, text: str = "text") -> Column:
    """Token counts by a public tokenizer.json file that every executor can open under path."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        for texts in batches:
            yield pd.Series([len(t.encode(x, add_special_tokens=False).ids) for x in texts], dtype="int64")

    return count(text_of(text))


class TokenRollup:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.manifest = spark, root, Manifest(spark, root)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """changes: (source, lang, version, docs, tokens), signed. Pre-aggregated before the shuffle; one small table a batch. False if the batch was there."""
        if any(batch in batches for batches in self.manifest.live().values()):
            return False
        name = f"delta-{uuid.uuid4().hex}"
        changes.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens")).write.parquet(f"{self.root}/{name}")
        self.manifest.add(name, [batch])
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens); groups whose documents are all gone are left out."""
        names = sorted(self.manifest.live())
        deltas = self.spark.read.schema(_SCHEMA).parquet(*[f"{self.root}/{n}" for n in names]) if names else self.spark.createDataFrame([], _SCHEMA)
        return deltas.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def fold(self) -> None:
        """One table of sums for all that is committed; it holds their batches. Readers see the old tables or the new one, as the manifest has it."""
        live = self.manifest.live()
        if len(live) > 1:
            name = f"base-{uuid.uuid4().hex}"
            self.totals().write.parquet(f"{self.root}/{name}")
            self.manifest.add(name, sorted(b for batches in live.values() for b in batches), sorted(live))

    def vacuum(self, grace: float = 7 * 86400.0) -> None:
        """Delete tables that a fold replaced more than grace seconds ago; totals taken before that can't be read any more."""
        self.manifest.vacuum([self.root], grace)


def signed(docs: DataFrame, version: str, sign: int, tokens: str = "tokens") -> DataFrame:
    """docs: (source, lang, <tokens>) as inserts (sign 1) or deletes (sign -1)."""
    return docs.select("source", "lang", F.lit(version).alias("version"), F.lit(sign).cast("long").alias("docs"), (F.col(tokens) * sign).alias("tokens"))


def revised(docs: DataFrame, old: tuple[str, str], new: tuple[str, str]) -> DataFrame:
    """docs whose count (version, column) old is replaced by new, in one pass."""
    pair = F.array(
        *[F.struct(F.lit(v).alias("version"), F.lit(s).cast("long").alias("docs"), (F.col(c) * s).alias("tokens")) for (v, c), s in ((old, -1), (new, 1))]
    )
    return docs.select("source", "lang", F.explode(pair).alias("x")).select("source", "lang", "x.*")
