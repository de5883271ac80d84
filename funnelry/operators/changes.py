"""Upserts and change detection without a merge-capable table format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelry.functions import values
from funnelry.operators.latest import latest_by


def upsert_latest(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """Current rows with incoming ones merged in, newest version per key.

    Of versions equally new the incoming one wins, then the later ``update_date``, then the
    greater row hash. ``insert_date`` is kept from the first time a key was seen;
    ``update_date`` is the load time of its latest delivery, be that an older version. Both
    frames carry the two columns. NULL keys are one key. The newest row and the stamps are
    found apart, both combined on the map side, and meet without a further shuffle.
    """
    stamps = ["insert_date", "update_date"]
    payload = [c for c in current.columns if c not in {*keys, *stamps}]
    both = current.withColumn("_delivery", F.lit(0)).unionByName(
        incoming.withColumn("_delivery", F.lit(1))
    )
    keyed = both.withColumns({"_key": F.struct(*keys), "_hash": values.row_hash(*payload)})
    order = [*newest, "_delivery", "update_date", "_hash"]
    rows = latest_by(keyed, ["_key"], order).select("_key", *payload)
    seen = keyed.groupBy("_key").agg(
        F.min("insert_date").alias("insert_date"), F.max("update_date").alias("update_date")
    )
    return rows.join(seen, "_key").select("_key.*", *payload, *stamps)


def classify_changes(
    previous: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    newest: Sequence[str] = (),
) -> DataFrame:
    """insert, update, unchanged or missing for every key, by md5 of the compared columns.

    Of a key's repeated rows on one side the newest counts, with ties to the greater hash.
    NULL keys are compared like any other.
    """

    def hashed(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(
            F.struct(*keys).alias("_key"), *newest, values.row_hash(*compare).alias(name)
        )
        return latest_by(rows, ["_key"], [*newest, name]).select("_key", name)

    both = hashed(previous, "previous_hash").join(
        hashed(current, "current_hash"), "_key", "full_outer"
    )
    kind = (
        F.when(F.col("previous_hash").isNull(), "insert")
        .when(F.col("current_hash").isNull(), "missing")
        .when(F.col("previous_hash") != F.col("current_hash"), "update")
        .otherwise("unchanged")
    )
    return both.select("_key.*", "previous_hash", "current_hash", kind.alias("change_type"))
