"""The training-data pipeline: quality rules, near duplicates, personal data, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's documents. All but the last return the documents' columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelry.llm.bpe import coded_column
from funnelry.llm.jaccard_join import jaccard_components
from funnelry.llm.mixing import measured, mix_sources, repeat_rows
from funnelry.llm.private_spans import redact_private
from funnelry.llm.quality_rules import quality_column
from funnelry.sources.tables import stored

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the base rules and the threshold table."""
    return docs.filter(quality_column(F.col("text"))["kept"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: the one with the smallest id, then the smallest text.

    Groups are of rows, whatever their ids: repeated and null ids are rows like others. A row
    without id is kept only where its group has no id. Texts without words are linked to
    nothing and all stay. Columns of any name and type are passed on.
    """
    whole = docs.select(F.struct(*docs.columns).alias("doc"))
    keyed = stored(whole.withColumn("row", F.monotonically_increasing_id()), "keyed")
    found = jaccard_components(keyed.select("row", "doc.text"), "row").select(
        F.col("doc_id").alias("row"), F.col("component_id").alias("group")
    )
    plain = [f.name for f in docs.schema if isinstance(f.dataType, T.AtomicType)]
    rest = [c for c in docs.columns if c not in ("doc_id", "text") and c in plain]
    # Each column travels once, in the order of rows itself; those without order go beside it.
    ordered = ["doc_id", "text", *rest]
    order = F.struct(
        F.col("doc.doc_id").isNull(),
        *[F.col(f"doc.{c}").alias(f"c{i}") for i, c in enumerate(ordered)],
        "row",
    )
    best = [F.min(order).alias("best")]
    others = [c for c in docs.columns if c not in ordered]
    best += [F.min_by(F.col(f"doc.{c}"), order).alias(f"o{i}") for i, c in enumerate(others)]
    first = keyed.join(found, "row").groupBy("group").agg(*best)
    places = {c: f"best.c{i}" for i, c in enumerate(ordered)}
    places |= {c: f"o{i}" for i, c in enumerate(others)}
    return first.select(*[F.col(places[c]).alias(c) for c in docs.columns])


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their personal data replaced by its kind."""
    redacted = docs.withColumn("text", redact_private(F.col("text")))
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them; columns of any name stay."""
    whole = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", "text", "source")
    sized = stored(measured(whole).drop("text"), "sized")
    return repeat_rows(mix_sources(sized)).select("doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, packed, with what shows that they decode to it."""
    coded = coded_column(spark, F.col("text"), RANKS, public_tokenizers.PATTERN, with_ids=True)
    rows = docs.select("doc_id", "source", coded.alias("x"))
    return rows.select("doc_id", "source", "x.ids", "x.n_tokens", "x.decoded_sha256")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mix", mix),
    ("tokens", tokens),
]

#: Byte-pair merges and 64-bit hashes are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of the folder; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
