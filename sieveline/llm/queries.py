"""The queries opN_<name> and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import bit_filter, documents, maybe_in, new_root, stash
from sieveline.llm.decontamination import leaks_sql
from sieveline.llm.filter_audit import audit_sql
from sieveline.llm.license_scan import license_sql
from sieveline.llm.top_k import top_k_sql


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.line_dedup import digest, line_dedup

    return digest(line_dedup(documents(spark, sf_dir)))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.exact_dedup import exact_dedup

    return exact_dedup(documents(spark, sf_dir))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.mixing import mix

    return mix(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All documents come in by one vocabulary; those labelled toxic are deleted again; those of low quality are recounted by another one; the delete is sent twice, before and after a fold."""
    from sieveline.llm.token_counts import TOKENIZERS, TokenRollup, rank_tokens, revised, signed

    root, old, new = new_root(spark, "tokens"), "byte_bpe_50k", "byte_bpe_multi_50k"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("quality").alias("quality"))
    tokens = lambda version: rank_tokens(spark, version, folder=folder or TOKENIZERS)
    docs = documents(spark, sf_dir)
    counts = stash(docs.select("doc_id", "source", "lang", tokens(old).alias("t1")), root, "counts")
    low = stash(labels.where("quality = 0 and toxic = 0").select("doc_id"), root, "low")
    recounted = maybe_in(docs, "doc_id", bit_filter(low, "doc_id", 26), 26)  # so that no text is shuffled
    recounted = stash(recounted.select("doc_id", "source", "lang", tokens(old).alias("t1"), tokens(new).alias("t2")), root, "recounted").join(low, "doc_id")
    rollup = TokenRollup(spark, f"{root}/rollup")
    rollup.commit("1-insert", signed(counts, old, 1, "t1"))
    gone = signed(counts.join(labels.where("toxic = 1").select("doc_id"), "doc_id"), old, -1, "t1")
    rollup.commit("2-toxic", gone)
    rollup.fold()
    rollup.commit("2-toxic", gone)
    rollup.commit("3-revise", revised(recounted, (old, "t1"), (new, "t2")))
    return rollup.totals()


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.license_scan import license_scan

    return license_scan(documents(spark, sf_dir))


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.decontamination import leaks

    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.near_dedup import near_dedup

    return near_dedup(documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.toxicity import score_toxicity

    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.pii import find_pii

    return find_pii(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.substring_dedup import substring_dedup

    return substring_dedup(documents(spark, sf_dir))


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.top_k import top_k

    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.filter_audit import filter_audit

    return filter_audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.whitening import whiten

    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_license_scan, op3_token_counts, op4_benchmark_leaks, op5_toxicity, op6_mix_sources, op7_near_dedup, op8_substring_dedup, op9_exact_dedup, op10_pii, op11_top_k, op12_filter_audit, op13_whitening)
}

SQL: dict[str, str] = {
    "op2_license_scan": license_sql(),
    "op4_benchmark_leaks": leaks_sql(),
    "op6_mix_sources": r"""
        WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk,
                len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
        s AS (SELECT sk, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY sk),
        w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(row_number() OVER (ORDER BY sk) - 1) % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS room FROM s),
        v AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(room) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
              FROM w WINDOW o AS (ORDER BY room / weight, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (SELECT arg_min(level, (room / weight, sk)) AS final FROM v WHERE room > level * weight),
        t AS (SELECT sk, source_size, coalesce(least(room, final * weight), room) AS target FROM v, f),
        p AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY sk ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
                CAST(floor(target) AS BIGINT) AS budget FROM d JOIN t USING (sk)),
        e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
          CAST(epochs * size + greatest(0, least(size, budget - epochs * source_size - start)) AS BIGINT) AS taken FROM e""",
    "op11_top_k": top_k_sql(),
    "op12_filter_audit": audit_sql(),
    "op9_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        g AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g""",
}
