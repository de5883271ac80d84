"""How the filters of a chain interact, in every order in which they can be applied.

A document is reduced to a mask: which filters it fails, whatever the order. Only counts of
masks go on. Orders are ranked lexicographically (by their Lehmer code), so the orders that
begin with the same letters are an interval of ranks, and so are those in which one mask is
removed at one step by a given beginning. A mask's count is added where such an interval
begins and taken off where it ends; running sums over the ranks give every order's totals.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby, permutations
from math import factorial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelry.sources.tables import stored

#: The letters of the filters, in the order of their bits.
FILTERS = "ABCDE"
#: The filter that needs other documents: the text of a smaller id.
COPY_BIT = 1 << FILTERS.index("E")
MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_CAPITALS = 10
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOL = re.compile(r"[#$%&*|]")


def text_mask(text: str | None) -> int:
    """Which of the filters A to D a text fails; null is an empty text."""
    text = text or ""
    raw = text.encode()
    # Splitting bytes without an argument splits at space and U+0009 to U+000D only.
    words = raw.split()
    fails = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT * len(words),
        100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > MAX_CAPITALS * len(text),
        _SYMBOL.search(text) is not None,
    )
    return sum(1 << bit for bit, fail in enumerate(fails) if fail)


@F.pandas_udf(T.IntegerType())
def _text_masks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([text_mask(t) for t in batch], dtype="int32")


def masked_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask``, ``n``, ``good`` and ``toxic``: documents of a part by mask.

    The part is the language, empty for null. ``docs`` has ``doc_id``, ``text`` and ``lang``,
    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; other columns are not looked at. Every
    row is a document. A row fails E if its text stands under a smaller id: rows of one id do
    not fail for each other, and a null id is neither smaller nor greater than any. A document
    is good or toxic if any label of its id says so. Texts are the same if their SHA-256 is.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select(
            F.col("doc_id").alias("id"),
            F.coalesce("lang", F.lit("")).alias("part"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            _text_masks(F.col("text")).alias("mask"),
        ),
        "masks",
    )
    # Only copies matter, and a text with any number of them is one row of each map task. Both
    # sides of the join are dealt for it alone, so a digest with many rows can be split there.
    first = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    first = stored(first.where("copies > 1").select("digest", "first"), "first")
    judged = rows.where(F.col("id").isNotNull()).join(first, "digest", "left")
    later = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    known = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("id"))
        .agg(
            F.coalesce(F.max(F.when(F.col("quality") == 1, 1)), F.lit(0)).alias("good"),
            F.coalesce(F.max(F.when(F.col("toxic") == 1, 1)), F.lit(0)).alias("toxic"),
        )
    )
    flagged = judged.select(
        "id", "part", F.when(later, F.col("mask") + COPY_BIT).otherwise(F.col("mask")).alias("mask")
    ).join(known, "id", "left")
    # Rows without id have neither an earlier copy nor labels.
    without = rows.where(F.col("id").isNull()).select(
        "part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic")
    )
    return (
        flagged.select("part", "mask", "good", "toxic")
        .unionByName(without)
        .groupBy("part", "mask")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        )
    )


def rank_intervals(n: int) -> list[tuple[int, int, int, int, bool]]:
    """(mask, step, start, stop, late): orders of ranks start to stop - 1 whose filter at the
    step (from 1) fails the mask; late if an earlier one does already.

    Beginnings of one length come in the order of their ranks, each covering equally many
    orders; neighbours with the same outcome make one interval.
    """
    found = []
    for step in range(1, n + 1):
        width = factorial(n - step)
        begun = list(permutations(range(n), step))
        for mask in range(1, 1 << n):
            def outcome(numbered, mask=mask):
                *before, last = numbered[1]
                if not mask >> last & 1:
                    return None
                return any(mask >> x & 1 for x in before)

            for late, run in groupby(enumerate(begun), key=outcome):
                if late is not None:
                    places = [place for place, _ in run]
                    found.append((mask, step, places[0] * width, (places[-1] + 1) * width, late))
    return found


def interaction_audit(spark: SparkSession, counts: DataFrame, letters: str) -> DataFrame:
    """For each part, order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley, zeros included.

    ``counts`` has one row per ``part`` and ``mask`` with ``n``, ``good`` and ``toxic``; an
    empty one gives no rows. The table of intervals has less than n! * e * 2^n rows for n
    letters (at most 7 are sensible), whatever the data; work is in proportion to the parts.
    """
    n = len(letters)
    orders = factorial(n)
    ranked = F.broadcast(
        spark.createDataFrame(
            [(i, "".join(x)) for i, x in enumerate(permutations(letters))],
            "rank int, filter_order string",
        )
    )
    intervals = F.broadcast(
        spark.createDataFrame(
            rank_intervals(n), "mask int, step int, start int, stop int, late boolean"
        )
    )
    counts = stored(counts, "masked_counts")
    measures = ["removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    gone, alone = ~F.col("late"), F.expr("bit_count(mask) = 1")

    def at(when, what):
        return F.when(when, F.col("sign") * F.col(what)).otherwise(0).cast("long")

    ends = F.array(
        F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")),
        F.struct(F.col("stop").alias("rank"), F.lit(-1).alias("sign")),
    )
    changes = (
        counts.join(intervals, "mask")
        .select("*", F.explode(ends).alias("end"))
        .select("*", "end.rank", "end.sign")
        .where(F.col("rank") < orders)
        .select(
            "part",
            "step",
            "rank",
            at(gone, "n").alias("removed"),
            at(F.col("late"), "n").alias("redundant"),
            at(gone & alone, "n").alias("unique_fails"),
            at(gone, "good").alias("good_lost"),
            at(gone, "toxic").alias("toxic_lost"),
        )
    )
    parts = counts.groupBy("part").agg(F.sum("n").alias("documents"))
    every = parts.select("part", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("rank"))
    zeros = every.select(
        "part",
        F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"),
        "rank",
        *[F.lit(0).cast("long").alias(x) for x in measures],
    )
    summed = changes.unionByName(zeros).groupBy("part", "step", "rank").agg(
        *[F.sum(x).alias(x) for x in measures]
    )
    up_to = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    totals = summed.select("part", "step", "rank", *[F.sum(x).over(up_to).alias(x) for x in measures])
    placed = totals.join(ranked, "rank").join(parts, "part")
    letter = F.expr("substring(filter_order, step, 1)")
    so_far = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    one = Window.partitionBy("part", letter)
    return placed.select(
        "part",
        "filter_order",
        "step",
        (F.col("documents") - F.sum("removed").over(so_far)).alias("kept"),
        *measures,
        F.sum("removed").over(one).alias("shapley"),
    )


def audit_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over all documents, by language."""
    return interaction_audit(spark, masked_counts(docs, labels), FILTERS)
