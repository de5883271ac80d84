"""Mixing sources to target weights by Efraimidis-Spirakis keys and word budgets.

Each document draws an exponential key with its quality weight as the rate: good documents
tend to small keys. A source's budget first buys whole passes over the source; what is left
buys a prefix of its documents in key order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.llm.running import blocks_for, ranked, totals_before
from funnelry.llm.texts import sizes
from funnelry.sources.tables import stored

#: Weights of the sources in code point order, repeating.
SOURCE_WEIGHTS = [3, 1, 2]
#: Words of the mix against words there are, and the most passes over a source.
SHARE, MOST_PASSES = 1.5, 2


def uniform(text: Column) -> Column:
    """A number between 0 and 1, both excluded, that follows from the text alone."""
    number = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")
    return (number + F.lit(0.5)) / F.lit(float(1 << 52))


def measured(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Adds ``size`` (words), ``quality`` (words against words and symbols) and ``draw``.

    A null text has size 0. A text without words has quality 1: it costs nothing.
    """
    counts = df.withColumn("_counts", sizes(F.col(text)))
    size, symbols = F.col("_counts.size"), F.col("_counts.symbols")
    quality = F.when(size > 0, size / (size + symbols)).otherwise(F.lit(1.0))
    identity = F.concat(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"),
        F.coalesce(F.col(text), F.lit("")),
    )
    return counts.withColumns(
        {"size": size, "quality": quality, "draw": uniform(identity)}
    ).drop("_counts")


def targets(sources: DataFrame, weights: list[int] = SOURCE_WEIGHTS) -> DataFrame:
    """Adds ``target`` to one row per source (``_source`` in order, ``source_size``).

    Sources share the budget by weight; none gets more than its cap, and what a cap leaves
    is shared again. Each round of sharing is an aggregate over the sources; the driver sees
    its two sums only. A round caps at least one more source or ends the sharing.
    """
    place = F.col("_place") % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    rows = stored(
        ranked(sources, "_source", "_place").withColumn("_weight", weight).drop("_place"),
        "sources",
    )
    first = rows.agg(F.sum("source_size").alias("n"), F.sum("_weight").alias("w")).first()
    budget = SHARE * (first["n"] or 0)
    left, shared = budget, first["w"] or 0
    cap = F.col("source_size") * float(MOST_PASSES)
    while shared:
        fair = F.lit(float(left)) * F.col("_weight") / F.lit(float(shared))
        over = cap <= fair
        sums = rows.agg(
            F.sum(F.when(over, cap).otherwise(0.0)).alias("capped"),
            F.sum(F.when(over, 0).otherwise(F.col("_weight"))).alias("w"),
        ).first()
        if sums["w"] == shared:
            break
        left, shared = budget - sums["capped"], sums["w"]
    if not shared:
        return rows.withColumn("target", cap).drop("_weight")
    fair = F.lit(float(left)) * F.col("_weight") / F.lit(float(shared))
    return rows.withColumn("target", F.least(cap, fair)).drop("_weight")


def mix_sources(
    df: DataFrame,
    source: str = "source",
    doc_id: str = "doc_id",
    weights: list[int] = SOURCE_WEIGHTS,
) -> DataFrame:
    """Adds ``source_size``, ``target``, ``copies`` and ``taken`` to rows of ``measured``.

    ``df`` is read several times: give a stored table. Documents without source are a source
    of their own, the last one. A prefix of documents ends where the taken words are
    nearest to the target. Rows equal in key, id and size are interchangeable; a source of
    no words takes nothing. Reruns agree.
    """
    blocks = blocks_for(df.count())
    key = -F.log(F.col("draw")) / F.col("quality")
    name = F.col(source).cast("string")
    keyed = df.withColumns(
        {
            # Never null, in code point order, null last.
            "_source": F.when(name.isNull(), "1").otherwise(F.concat(F.lit("0"), name)),
            "_key": key,
            # Follows the key's order and spreads keys of any weight evenly enough.
            "_block": F.least(
                F.floor(key / (key + 1) * blocks).cast("long"), F.lit(blocks - 1)
            ),
        }
    )
    by_source = keyed.groupBy("_source").agg(F.sum("size").alias("source_size"))
    order = [F.col("_key"), F.col(doc_id), F.col("size")]
    rows = totals_before(
        keyed, "_source", "_block", order, F.col("size"), "_before", targets(by_source, weights)
    )
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    rest = F.col("target") - whole * F.col("source_size")
    chosen = (F.col("size") > 0) & (2 * F.col("_before") + F.col("size") <= 2 * rest)
    copies = (whole + F.when(chosen, 1).otherwise(0)).cast("long")
    return (
        rows.withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_source", "_key", "_block", "_before")
    )


def repeat_rows(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as often as its copies say; rows of no copies go."""
    times = F.explode(F.sequence(F.lit(1), F.col(copies)))
    return df.filter(F.col(copies) > 0).withColumn("_copy", times).drop("_copy")
