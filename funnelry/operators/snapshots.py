"""Snapshots stored with checksums, so that comparing two reads only what differs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.functions import values
from funnelry.operators.changes import classify_changes
from funnelry.sources.tables import stored
from funnelry.sources.versions import BUCKET, Store

HASH = "row_hash"


def _sums(rows: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """Rows of each bucket and the sum of their hashes: repeated rows count, order does not."""
    both = F.xxhash64(*keys, HASH).cast("decimal(38,0)")
    return rows.groupBy(bucket.alias(BUCKET)).agg(
        F.count("*").alias("n"), F.sum(both).alias("checksum")
    )


def keep_snapshot(
    store: Store,
    name: str,
    df: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    newest: Sequence[str] = (),
    buckets: int = 256,
) -> None:
    """Stores a snapshot of a table: keys, versions, a hash of the compared columns.

    The buckets' checksums are committed with it. Two snapshots can be compared if they have
    the same keys and number of buckets. ``df`` is read once.
    """
    rows = stored(df.select(*keys, *newest, values.row_hash(*compare).alias(HASH)), "snapshot")
    change = store.begin()
    table = change.create(name, rows.schema, keys, buckets)
    change.replace(name, rows, range(buckets))
    sums = _sums(rows, keys, table.bucket_of())
    change.create(f"{name}_checksums", sums.schema, [BUCKET], 1)
    change.replace(f"{name}_checksums", sums, [0])
    change.commit()


def differing_buckets(store: Store, before: str, after: str) -> set[int]:
    """Buckets whose rows are not the same in both: one row per bucket is compared.

    Two different contents of a bucket have the same checksum once in 2^64.
    """
    sides = [store.read(f"{n}_checksums") for n in (before, after)]
    old, new = (df.toDF(BUCKET, "n", x) for df, x in zip(sides, ("old", "new"), strict=True))
    both = old.join(new.withColumnRenamed("n", "m"), BUCKET, "full_outer")
    same = F.col("n").eqNullSafe(F.col("m")) & F.col("old").eqNullSafe(F.col("new"))
    return {r[0] for r in both.where(~same).select(BUCKET).collect()}


def snapshot_changes(
    store: Store, before: str, after: str, newest: Sequence[str] = ()
) -> DataFrame:
    """Keys inserted, updated or missing between two snapshots, from differing buckets only.

    Of a key's repeated rows the newest counts; NULL keys are one key.
    """
    buckets = differing_buckets(store, before, after)
    keys = store.manifest().tables[before].keys
    old, new = store.read(before, buckets), store.read(after, buckets)
    found = classify_changes(old, new, keys, [HASH], newest)
    return found.where(F.col("change_type") != "unchanged").select(*keys, "change_type")
