"""Pipeline stages with columns of any name, without optional ones, and on empty tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from funnelry.llm import jaccard_join

NAMES = ["target", "source_size", "size", "quality", "draw", "copies", "taken", "_source", "_key",
         "_block", "_group", "_row", "row", "group", "doc", "x", "ids", "_copy"]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    words = "the of and to in is that with for by stone river cloud paper green".split()
    rows = [(i, " ".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(90)) + " of the", f"s{i % 3}") for i in range(24)]
    rows += [(50, rows[3][1], "s0"), (51, None, None), (None, rows[4][1], "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.withColumns({n: F.concat(F.lit(f"{n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in NAMES})


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_pass_on_columns_of_any_name(spark, docs, stage):
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, "")
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) >= 20
    for r in rows:
        own = "-" if r["doc_id"] is None else str(r["doc_id"])
        assert all(r[n] == f"{n} {own}" for n in NAMES)


def test_near_duplicates_keep_one_of_each_group(spark, docs):
    kept = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([*range(24), 51], key=str)


def test_last_stage_and_empty_tables(spark, docs):
    out = dict(corpus_pipeline.STAGES)["tokens"](spark, docs, "")
    assert out.columns == ["doc_id", "source", "ids", "n_tokens", "decoded_sha256"]
    assert out.count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0


def test_near_duplicates_sends_words_of_likely_pairs_only(spark, monkeypatch):
    rng = random.Random(31)
    fresh = lambda n: [f"u{rng.getrandbits(60)}" for _ in range(n)]
    texts = []
    for _ in range(6):
        passage = fresh(180)
        texts += [" ".join(passage + fresh(120)) for _ in range(5)]
        texts.append(texts[-1] + " more words")
    sent, store = [], jaccard_join.stored

    def stored(df, name):
        sent.append((name, store(df, name)))
        return sent[-1][1]

    monkeypatch.setattr(jaccard_join, "stored", stored)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r["doc_id"] for r in kept) == [i for i in range(36) if i % 6 != 5]
    assert sum(df.count() for name, df in sent if name == "likely") == 6
    assert [name for name, _ in sent].count("payloads") == 1
