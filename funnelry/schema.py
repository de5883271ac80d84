"""Column layout of the raw and reference tables."""

from __future__ import annotations

from pyspark.sql import types as T

#: The four source feeds, by the folder name they land under.
FEEDS = {
    "leads_raw": "leads_raw",
    "lead_activities_raw": "lead_activites_raw",
    "custom_activities_raw": "custom_activites_raw",
    "close_crm_users_raw": "close_crm_users_raw",
}

RAW = T.StructType(
    [
        T.StructField("raw_data", T.VariantType()),
        T.StructField("source_file_name", T.StringType()),
        T.StructField("source_row_number", T.LongType()),
        T.StructField("load_date", T.DateType()),
        T.StructField("insert_date", T.TimestampNTZType()),
        T.StructField("bronze_loaded_at", T.TimestampNTZType()),
    ]
)

#: Where a record came from; carried through every layer up to the dimensions.
LINEAGE = ["source_file_name", "source_row_number", "load_date", "insert_date", "bronze_loaded_at"]


def _table(text: list[str], flags: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in text]
        + [T.StructField(c, T.BooleanType()) for c in flags]
    )


SEEDS = {
    "custom_activity_type_map": _table(
        ["custom_activity_type_id", "custom_activity_type_name", "funnel_source", "funnel_stage"],
        ["is_revenue_event", "is_active"],
    ),
    "custom_field_map": _table(
        [
            "custom_field_id",
            "custom_field_name",
            "custom_field_type",
            "canonical_field_name",
            "field_role",
        ],
        ["is_active"],
    ),
    "funnel_outcome_map": _table(
        [
            "canonical_field_name",
            "field_name",
            "raw_value",
            "normalized_value",
            "outcome_category",
            "outcome_subcategory",
        ],
        # The last header is spelt this way in the delivered file.
        [
            "is_taken",
            "is_set",
            "is_sale",
            "is_cancel",
            "is_no_show",
            "is_follow_up",
            "is_unqualifie",
        ],
    ),
    "objection_category_map": _table(
        ["source_objection_value", "normalized_objection_category"], ["is_active"]
    ),
}
