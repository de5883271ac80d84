"""Activities as rows, and their latest versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.functions import documents, values
from funnelry.operators.latest import RANK, latest_by
from funnelry.schema import LINEAGE

#: Newest first; the lineage columns settle what the two timestamps leave open.
NEWEST = ["activity_updated_at", "activity_at"]
TIES = ["load_date", "source_file_name", "source_row_number", "activity_array_index"]

#: Fields that belong to one activity type only.
TYPE_FIELDS = {
    "Call": ["status", "note"],
    "SMS": ["status", "sequence_name"],
    "Meeting": ["status", "title", "note"],
    "Note": ["note"],
}
#: Fields stored as typed columns beside the document, so that readers need not open it and
#: row-group statistics hold for them.
SHREDDED = sorted({f for names in TYPE_FIELDS.values() for f in names})


def flatten_array(rows: DataFrame, array: str, index: str, item: str) -> DataFrame:
    """One row per array element with its 0-based index; no rows for anything else."""
    keep = [c for c in rows.columns if c != array]
    return rows.select(*keep, F.posexplode(documents.items(array)).alias(index, item))


def silver_activities(staged: DataFrame) -> DataFrame:
    """One row per delivered activity, repeated deliveries included."""
    wrappers = staged.select("activity_data", *LINEAGE)
    flat = flatten_array(wrappers, "activity_data", "activity_array_index", "activity")

    def text(key: str):
        return documents.text("activity", key)

    return flat.select(
        text("id").alias("activity_id"),
        text("lead_id").alias("lead_id"),
        text("_type").alias("activity_type"),
        text("custom_activity_type_id").alias("custom_activity_type_id"),
        values.timestamp(text("activity_at")).alias("activity_at"),
        values.timestamp(text("date_created")).alias("activity_created_at"),
        values.timestamp(text("date_updated")).alias("activity_updated_at"),
        text("user_id").alias("user_id"),
        "activity",
        "activity_array_index",
        *LINEAGE,
    )


def shred(activities: DataFrame) -> DataFrame:
    """Adds the shredded fields as text columns, for tables that are written."""
    return activities.select("*", *[documents.text("activity", f).alias(f) for f in SHREDDED])


def shredded(activities: DataFrame, field: str) -> Column:
    """A shredded field: its own column where there is one, else out of the document."""
    return F.col(field) if field in activities.columns else documents.text("activity", field)


def custom_activity_events(activities: DataFrame) -> DataFrame:
    """Latest version of every custom activity, by lead and activity."""
    custom = activities.where(F.col("activity_type") == "CustomActivity")
    return latest_by(custom, ["lead_id", "activity_id"], NEWEST + TIES)


def other_events(activities: DataFrame) -> DataFrame:
    """Latest versions of calls, messages, meetings and notes, in one pass.

    Each row has the fields of its own type; those of other types are NULL.
    """
    columns = ["activity_id", "lead_id", "activity_at", "activity_updated_at", "user_id"]
    kind = F.col("activity_type")
    found = []
    for name in SHREDDED:
        owners = [t for t, names in TYPE_FIELDS.items() if name in names]
        found.append(F.when(kind.isin(owners), shredded(activities, name)).alias(name))
    rows = activities.where(kind.isin(list(TYPE_FIELDS))).select(
        "activity_type", *columns, *TIES, *found
    )
    latest = latest_by(rows, ["activity_type", "lead_id", "activity_id"], NEWEST + TIES)
    return latest.drop(RANK, *TIES)


def events_by_type(events: DataFrame, activity_type: str) -> DataFrame:
    """One type's table out of :func:`other_events`."""
    columns = ["activity_id", "lead_id", "activity_at", "activity_updated_at", "user_id"]
    one = events.where(F.col("activity_type") == activity_type)
    return one.select(*columns, *TYPE_FIELDS[activity_type])

