"""Registered queries over the operators: each returns its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelry.llm.bpe import coded_column
from funnelry.llm.cotraining import quality_scores
from funnelry.llm.crf_language import held_out, learn, predict_column
from funnelry.llm.equal_average import cluster_vectors
from funnelry.llm.filter_audit import audit_documents
from funnelry.llm.jaccard_join import jaccard_components
from funnelry.llm.mixing import measured, mix_sources
from funnelry.llm.private_spans import KINDS, find_private
from funnelry.llm.quality_rules import quality_rules
from funnelry.llm.quotient_dedup import exact_copies
from funnelry.llm.shard_tree import regular_tree, shard_rows
from funnelry.llm.topk import top_k
from funnelry.llm.url_globs import judge_urls
from funnelry.sources.tables import stored

SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    predicted = predict_column(learn(documents), documents, F.col("text"))
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predicted.alias("x"))
    return rows.select("doc_id", "held_out", "x.lang_pred", "x.score")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    sized = stored(measured(documents).drop("text"), "sized")
    return mix_sources(sized).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "quality", "copies"
    )


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", every=50)


def op4_bpe(
    spark: SparkSession,
    sf_dir: str,
    path: str = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = coded_column(spark, F.col("text"), path, pattern)
    return documents.select("doc_id", coded.alias("x")).select("doc_id", "x.*")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op6_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, pages, labels = (_table(spark, sf_dir, x) for x in ("documents", "pages", "labels"))
    return quality_scores(documents, pages, labels)


def _written(spans: Column) -> Column:
    parts = F.transform(
        spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"])
    )
    return F.array_join(parts, ",")


def op7_private_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = documents.select("doc_id", find_private(F.col("text")).alias("all"))
    split = found.withColumn("plain", F.filter("all", lambda x: x["base"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("plain", lambda x: x["kind"] == kind)).cast("long")

    return split.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_written(F.col("plain")).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("all")).alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules(documents)
    fields = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept",
    ]
    return judged.select("doc_id", *[F.col(f"quality.{x}").alias(x) for x in fields])


def op9_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = shard_rows(
        sized, "doc_id", regular_tree(SHARDS), regular_tree(SHARDS + 1), ["text_crc32", "size"]
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op10_url_globs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", judge_urls(F.col("url")).alias("x")).select("page_id", "x.*")


def op11_quotient_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_copies(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (_table(spark, sf_dir, x) for x in ("documents", "labels"))
    return audit_documents(spark, documents, labels)


def op13_equal_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark, _table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_crf_language": op1_crf_language,
    "op2_mix_sources": op2_mix_sources,
    "op3_top_k": op3_top_k,
    "op4_bpe": op4_bpe,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_cotraining": op6_cotraining,
    "op7_private_spans": op7_private_spans,
    "op8_quality_rules": op8_quality_rules,
    "op9_shard_tree": op9_shard_tree,
    "op10_url_globs": op10_url_globs,
    "op11_quotient_dedup": op11_quotient_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_equal_average": op13_equal_average,
    "pipeline": pipeline,
}
