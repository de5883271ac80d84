"""Codes and fields the reference tables do not know yet. Expected to be empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelry.functions import values
from funnelry.operators import fields
from funnelry.operators.unmapped import drift_profile, unmapped


def unmapped_activity_types(events: DataFrame, type_map: DataFrame) -> DataFrame:
    known = type_map.where(values.is_true("is_active"))
    return drift_profile(
        unmapped(events, known, ["custom_activity_type_id"]),
        ["custom_activity_type_id"],
        F.count("*").alias("event_count"),
    )


def unmapped_fields(events: DataFrame, field_map: DataFrame) -> DataFrame:
    present = fields.explode_keys(events, "activity", ["lead_id", "activity_id", "activity_at"])
    known = field_map.where(values.is_true("is_active"))
    return drift_profile(
        unmapped(present, known, ["custom_field_id"]),
        ["custom_field_id", "raw_activity_key"],
        F.count("*").alias("field_occurrence_count"),
        F.countDistinct("activity_id").alias("distinct_activity_count"),
    )


def observed_outcomes(
    events: DataFrame, field_map: DataFrame, max_rows: int = fields.LITERAL_ROWS
) -> DataFrame:
    """One row per filled outcome field of an event, read in place from the document.

    A mapping too large for a projection is joined by key, with the same rows.
    """
    known = values.is_true("is_active") & (F.col("field_role") == "outcome")
    outcomes = field_map.where(known & F.col("custom_field_id").isNotNull()).select(
        "custom_field_id", F.col("custom_field_name").alias("name")
    )
    keep = ["custom_activity_type_id", "lead_id", "activity_id", "activity_at"]
    rows = fields.mapping_rows(outcomes.orderBy("custom_field_id"), max_rows)
    if rows is None:
        numbered, found = fields.join_fields(events, "activity", keep, outcomes)
        return numbered.join(found.where("text <> ''"), "_row").select(
            *keep, F.col("name").alias("field_name"), F.col("text").alias("raw_value")
        )
    pairs = [
        F.struct(
            F.lit(row.name).alias("field_name"),
            fields.mapped_text("activity", [row.custom_field_id]).alias("raw_value"),
        )
        for row in rows
    ]
    if not pairs:
        pairs = [F.lit(None).cast("struct<field_name:string,raw_value:string>")]
    filled = F.filter(F.array(*pairs), lambda p: p["raw_value"] != "")
    return events.select(*keep, F.inline(filled))


def unmapped_outcomes(
    events: DataFrame, field_map: DataFrame, outcome_map: DataFrame
) -> DataFrame:
    on = ["field_name", "raw_value"]
    return drift_profile(
        unmapped(observed_outcomes(events, field_map), outcome_map, on),
        on,
        F.count("*").alias("outcome_occurrence_count"),
        F.countDistinct("activity_id").alias("distinct_activity_count"),
    )
