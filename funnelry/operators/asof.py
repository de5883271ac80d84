"""First event at or after a point in time, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelry.operators.skew import HEAVY_ROWS, bounded_broadcast, split_heavy
from funnelry.sources.tables import stored

LANE, SHARE, SHARES = "_lane", "_share", "_shares"


def with_lane(events: DataFrame, key: str, at: str, event_id: str) -> DataFrame:
    """Lane 0 for rows that can match, spread lanes for rows without key or time.

    A NULL key or time never matches anything; spreading those rows by a hash of their
    plain columns keeps them out of one single NULL group however many there are, and
    whether or not they have an id.
    """
    placed = F.col(key).isNotNull() & F.col(at).isNotNull()
    plain = [
        f.name
        for f in events.schema
        if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)
    ]
    row = F.xxhash64(*dict.fromkeys([event_id, *plain]))
    spread = F.when(row == 0, F.lit(1).cast("bigint")).otherwise(row)
    return events.withColumn(LANE, F.when(placed, F.lit(0).cast("bigint")).otherwise(spread))


def _found(at: str, take: Sequence[str], wanted: Column) -> Column:
    return F.when(wanted & (F.col(LANE) == 0), F.struct(at, *take))


def next_in_window(
    events: DataFrame, key: str, at: str, wanted: Column, take: Sequence[str], into: str
) -> DataFrame:
    """Adds the first wanted row at or after each row, in one sort per key.

    Newest first with a running minimum: linear per key, where the mirrored frame
    (current row to unbounded following) would recompute every suffix. A range frame
    includes rows of the same instant, and the struct orders those by ``take``.
    """
    later = (
        Window.partitionBy(key, LANE)
        .orderBy(F.col(at).desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return events.withColumn(into, F.min(_found(at, take, wanted)).over(later))


def with_shares(events: DataFrame, key: str, at: str, event_id: str, max_rows: int) -> DataFrame:
    """Numbers that divide the rows of an overcrowded instant among several tasks.

    Instants with more than ``max_rows`` rows are fewer than rows / ``max_rows``; their
    share counts are broadcast if that is few enough.
    """
    crowded = (
        events.where(F.col(LANE) == 0)
        .groupBy(key, at)
        .agg(F.ceil(F.count("*") / max(max_rows, 1)).cast("int").alias(SHARES))
        .where(F.col(SHARES) > 1)
    )
    known = bounded_broadcast(stored(crowded, "crowded_instants"))
    counted = events.join(known, [key, at], "left")
    shares = F.coalesce(F.col(SHARES), F.lit(1))
    return counted.withColumn(SHARES, shares).withColumn(
        SHARE, F.pmod(F.xxhash64(event_id), F.col(SHARES)).cast("int")
    )


def _minute(events: DataFrame, at: str) -> Column:
    """Running number of the minute, in time order whatever the session's zone."""
    if isinstance(events.schema[at].dataType, T.TimestampType):
        return F.floor(F.unix_seconds(at) / 60)
    # Wall-clock parts: a cast to an instant would fold minutes around clock changes.
    days = F.datediff(at, F.lit("1970-01-01")).cast("bigint")
    return days * 1440 + F.hour(at) * 60 + F.minute(at)


def next_by_instant(
    events: DataFrame, key: str, at: str, wanted: Column, take: Sequence[str], into: str
) -> DataFrame:
    """Same result for keys too large for one task; ``events`` is read twice.

    Rows of one instant share their match, so they are first combined to one row per
    (key, instant), on the map side. Those are solved per calendar minute (at most one
    row per microsecond) and, across minutes, on one row per minute; no window then
    holds more than these bounds, however the rows are spread over time. Each share of a
    crowded instant gets its own copy of the match to join.
    """
    newest_first = Window.partitionBy(key, "_minute").orderBy(F.col(at).desc())
    instants = (
        events.where(F.col(LANE) == 0)
        .groupBy(key, at)
        .agg(F.min(_found(at, take, wanted)).alias("_own"), F.max(SHARES).alias(SHARES))
        .select(key, at, _minute(events, at).alias("_minute"), SHARES, "_own")
        .withColumn("_near", F.min("_own").over(newest_first))
    )
    minutes = instants.groupBy(key, "_minute").agg(F.min("_own").alias("_own"))
    after = (
        Window.partitionBy(key)
        .orderBy(F.col("_minute").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    minutes = minutes.select(key, "_minute", F.min("_own").over(after).alias("_far"))
    matched = instants.join(minutes, [key, "_minute"]).select(
        key,
        at,
        F.lit(0).cast("bigint").alias(LANE),
        F.explode(F.sequence(F.lit(0), F.col(SHARES) - 1)).alias(SHARE),
        F.coalesce("_near", "_far").alias(into),
    )
    return events.join(matched, [key, at, LANE, SHARE], "left")


def first_at_or_after(
    events: DataFrame,
    key: str,
    at: str,
    event_id: str,
    steps: Sequence[tuple[str, Column, Sequence[str]]],
    max_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Adds, for each step ``(name, wanted, take)``, a struct of the first wanted row.

    Steps may take the result of an earlier step, which chains matches: a sale found for
    a strategy call travels with that call. For ordinary keys all steps share one
    partitioning and one sort. ``events`` is read twice (key counts, then matching);
    pass a stored table.
    """
    columns = [*events.columns, *[name for name, _, _ in steps]]
    lanes = with_lane(events, key, at, event_id)
    ordinary, heavy = split_heavy(lanes, key, max_rows)
    for name, wanted, take in steps:
        ordinary = next_in_window(ordinary, key, at, wanted, [event_id, *take], name)
    if heavy is None:
        return ordinary.select(*columns)
    heavy = with_shares(heavy, key, at, event_id, max_rows)
    for name, wanted, take in steps:
        heavy = stored(heavy, "heavy_rows")
        heavy = next_by_instant(heavy, key, at, wanted, [event_id, *take], name)
    return ordinary.select(*columns).unionByName(heavy.select(*columns))
