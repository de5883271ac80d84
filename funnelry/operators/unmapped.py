"""Records whose code is missing from a mapping table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def unmapped(records: DataFrame, mapping: DataFrame, on: Sequence[str]) -> DataFrame:
    """Records without a match; a NULL code has none and is kept.

    No broadcast hint: the mapping's size is known to the optimizer, which broadcasts it
    below its threshold and shuffles it above.
    """
    return records.join(mapping.select(*on).distinct(), list(on), "left_anti")


def drift_profile(records: DataFrame, by: Sequence[str], *counts) -> DataFrame:
    """How often, in how many leads and between which dates each unmapped code occurs."""
    return records.groupBy(*by).agg(
        *counts,
        F.countDistinct("lead_id").alias("distinct_lead_count"),
        F.min("activity_at").alias("first_seen_at"),
        F.max("activity_at").alias("latest_seen_at"),
    )
