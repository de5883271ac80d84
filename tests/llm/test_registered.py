"""Registered functions of the llm operators: contract columns, plans, clashing names."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from funnelry.llm import bpe
from funnelry.llm.oracle import ORACLE
from funnelry.llm.quality_rules import quality_column, quality_rules
from funnelry.llm.queries import QUERIES

from checks.compare import duck, rows_of

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["op3_top_k", "op8_quality_rules", "op10_url_globs"])
def test_query_agrees_with_sql(spark, name):
    df = QUERIES[name](spark, SF)
    result = duck(SF).execute(ORACLE[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in result.description], result.fetchall())


def test_bpe_query_agrees_with_the_library(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    codec = bpe.encoding(open(path, "rb").read(), public_tokenizers.PATTERN)
    df = QUERIES["op4_bpe"](spark, SF)
    assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert df.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.asarray(codec.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_coded_column_of_odd_texts(spark):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    df = spark.createDataFrame([(1, None), (2, ""), (3, "ü " * 90_000), (4, "x" * 5000)], "doc_id int, text string")
    column = bpe.coded_column(spark, F.col("text"), path, pattern, with_ids=True)
    codec = bpe.encoding(open(path, "rb").read(), pattern)
    for r in df.withColumn("x", column).collect():
        assert np.frombuffer(r["x"]["ids"], "<u4").tolist() == codec.encode_ordinary(r["text"] or "")
    assert df.limit(0).withColumn("x", column).count() == 0


def test_measures_are_worked_out_once_below_a_filter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = optimized(docs.filter(quality_column(F.col("text"))["kept"]))
    assert plan.count("array_remove(") == 1 and plan.count("sort_array(") == 2
    assert "Project" not in plan


def test_quality_keeps_columns_of_any_name(spark):
    names = ["quality_text", "quality_counted", "t", "w", "x", "kept"]
    df = spark.createDataFrame([("a b c",), (None,)], "text string").withColumns({n: F.lit(n) for n in names})
    out = quality_rules(df)
    assert out.columns == [*df.columns, "quality"]
    assert all(r[n] == n for r in out.collect() for n in names)
