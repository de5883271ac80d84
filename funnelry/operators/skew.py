"""Finding keys that hold too many rows for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelry.sources.tables import stored

#: Rows of one key that a single task may sort; keys above it take the split form.
HEAVY_ROWS = 2_000_000
#: Key lists up to this many rows are broadcast; longer ones are shuffled.
BROADCAST_KEYS = 100_000


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_KEYS) -> DataFrame:
    """Broadcast hint given only after counting the rows; the plain frame beyond the bound."""
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def heavy_keys(df: DataFrame, key: str, max_rows: int = HEAVY_ROWS) -> DataFrame | None:
    """Keys with more than ``max_rows`` rows, ready to join; None if there are none.

    There are fewer than rows / ``max_rows`` of them. The count needs the key column only
    and combines on the map side; NULL keys are left out.
    """
    heavy = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .count()
        .where(F.col("count") > max_rows)
        .select(key)
    )
    heavy = stored(heavy, "heavy_keys")
    return None if heavy.isEmpty() else bounded_broadcast(heavy)


def split_heavy(
    df: DataFrame, key: str, max_rows: int = HEAVY_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of heavy keys (if any).

    NULL keys stay with the ordinary rows: callers never group by a NULL key.
    """
    keys = heavy_keys(df, key, max_rows)
    if keys is None:
        return df, None
    return df.join(keys, key, "left_anti"), df.join(keys, key, "left_semi")


def join_key_totals(
    rows: DataFrame, totals: DataFrame, key: str, max_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Left join of many rows to a table with one row per key, safe for heavy keys.

    The totals of heavy keys are few and are broadcast when their count allows it, so
    rows of heavy keys never move; ordinary keys take a normal shuffle join.
    """
    keys = heavy_keys(rows, key, max_rows)
    if keys is None:
        return rows.join(totals, key, "left")
    few = bounded_broadcast(stored(totals.join(keys, key, "left_semi"), "heavy_totals"))
    ordinary = rows.join(keys, key, "left_anti").join(totals, key, "left")
    return ordinary.unionByName(rows.join(keys, key, "left_semi").join(few, key, "left"))
