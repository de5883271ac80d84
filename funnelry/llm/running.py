"""Running totals and ranks over groups too large for one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from funnelry.sources.tables import stored


def blocks_for(rows: int) -> int:
    """Blocks of a group: the square root of its rows, so that neither the rows of a block
    nor the blocks of a group become many."""
    return max(1, math.isqrt(max(rows, 0)))


def totals_before(
    df: DataFrame,
    group: str,
    block: str,
    order: list[Column],
    value: Column,
    into: str,
    groups: DataFrame | None = None,
) -> DataFrame:
    """Adds the sum of ``value`` over the rows before a row in its group.

    Rows are in the order of their ``block``, then ``order``; both keys must not be null.
    Each block is summed by itself, the blocks of a group are then summed over one row each,
    so no task gets a whole group. ``df`` is read twice: give a stored table. Columns of
    ``groups``, one row per group, are added too; they travel with the blocks.
    """
    totals = df.groupBy(group, block).agg(F.sum(value).alias("_total"))
    blocks = Window.partitionBy(group).orderBy(block)
    earlier = F.sum("_total").over(blocks.rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(group, block, F.coalesce(earlier, F.lit(0)).alias("_offset"))
    if groups is not None:
        offsets = offsets.join(groups, group)
    rows = Window.partitionBy(group, block).orderBy(*order)
    here = rows.rowsBetween(Window.unboundedPreceding, -1)
    within = df.withColumn("_within", F.coalesce(F.sum(value).over(here), F.lit(0)))
    return (
        within.join(offsets, [group, block])
        .withColumn(into, F.col("_offset") + F.col("_within"))
        .drop("_offset", "_within")
    )


def ranked(df: DataFrame, key: str, into: str) -> DataFrame:
    """Adds the place, from 0, of each row in the order of ``key`` (distinct, not null).

    Rows are dealt by key ranges; only the row count of each range comes to the driver.
    """
    parts = stored(
        df.repartitionByRange(key).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    counts = {r["_range"]: r["count"] for r in parts.groupBy("_range").count().collect()}
    before, pairs = 0, []
    for part in sorted(counts):
        pairs += [F.lit(part), F.lit(before)]
        before += counts[part]
    if not pairs:
        return parts.drop("_range").withColumn(into, F.lit(0).cast("long"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    offset = F.create_map(*pairs)[F.col("_range")]
    return parts.withColumn(into, (place + offset).cast("long")).drop("_range")
