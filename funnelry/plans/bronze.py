"""Typed staging views over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelry.functions import documents, values
from funnelry.schema import LINEAGE


def stage_leads(raw: DataFrame) -> DataFrame:
    def text(key: str):
        return documents.text("raw_data", key)

    return raw.select(
        text("id").alias("lead_id"),
        text("name").alias("lead_name"),
        text("display_name").alias("display_name"),
        text("status_id").alias("status_id"),
        text("status_label").alias("status_label"),
        values.timestamp(text("date_created")).alias("lead_created_at"),
        values.timestamp(text("date_updated")).alias("lead_updated_at"),
        text("created_by").alias("created_by_user_id"),
        text("updated_by").alias("updated_by_user_id"),
        "raw_data",
        *LINEAGE,
    )


def stage_lead_activities(raw: DataFrame) -> DataFrame:
    """Wrapper rows with their activity array exposed."""
    data = documents.part("raw_data", "data")
    return raw.select("raw_data", data.alias("activity_data"), *LINEAGE)


def _stage_object_text(raw: DataFrame) -> DataFrame:
    return raw.select(
        "raw_data", documents.text("raw_data", "JSON_OBJECT").alias("json_object_text"), *LINEAGE
    )


def stage_custom_activities(raw: DataFrame) -> DataFrame:
    """Activity metadata; the object is text that is not valid JSON."""
    return _stage_object_text(raw)


def stage_users(raw: DataFrame) -> DataFrame:
    """User metadata; the object is text that is not valid JSON."""
    return _stage_object_text(raw)
