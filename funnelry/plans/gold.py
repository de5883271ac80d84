"""Dimensions and funnel facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.functions import values
from funnelry.operators import fields
from funnelry.operators.asof import first_at_or_after
from funnelry.operators.latest import RANK, latest_by
from funnelry.operators.skew import HEAVY_ROWS
from funnelry.plans.silver import NEWEST, SHREDDED, TIES, shred
from funnelry.schema import LINEAGE
from funnelry.sources.tables import stored

FUNNEL_STAGES = ["initial_contact", "strategy", "sale"]
TEXT_FIELDS = [
    "triage_outcome",
    "prospecting_outcome",
    "strategy_outcome",
    "offer_presented",
    "objections_faced",
]
MONEY_FIELDS = ["contract_value", "cash_collected"]
ROLE_FIELDS = ["setter_user_id", "closer_user_id"]

#: Settles versions of leads and users with the same update time, latest delivery first.
LOAD_ORDER = ["insert_date", "load_date", "source_file_name", "source_row_number"]

# Fixed patterns: how user metadata is written in the delivered object text.
USER_OBJECT = r"\{[^{}]*'id': 'user_[^']+'[^{}]*\}"
USER_ID = r"'id': '([^']+)'"
USER_FIELD = "'{name}': '([^']*)'"


# --- dimensions ---------------------------------------------------------------------


def dim_lead(staged: DataFrame) -> DataFrame:
    known = staged.where(F.col("lead_id").isNotNull())
    return latest_by(known, ["lead_id"], ["lead_updated_at", *LOAD_ORDER]).drop(RANK)


def parse_users(staged: DataFrame) -> DataFrame:
    """One row per user object found in the metadata text."""
    objects = staged.select(
        F.explode(values.all_matches("json_object_text", USER_OBJECT)).alias("user_object_text"),
        *LINEAGE,
    )

    def field(name: str) -> Column:
        return values.capture("user_object_text", USER_FIELD.format(name=name))

    return objects.select(
        values.capture("user_object_text", USER_ID).alias("user_id"),
        *[field(n).alias(n) for n in ("email", "first_name", "last_name", "last_used_timezone")],
        values.timestamp(field("date_created")).alias("user_created_at"),
        values.timestamp(field("date_updated")).alias("user_updated_at"),
        "user_object_text",
        *LINEAGE,
    )


NEWEST_USER = ["user_updated_at", *LOAD_ORDER, "user_object_text"]


def dim_user(staged: DataFrame) -> DataFrame:
    users = parse_users(staged).where(F.col("user_id").isNotNull())
    return named_users(latest_by(users, ["user_id"], NEWEST_USER))


def named_users(latest: DataFrame) -> DataFrame:
    return latest.select(
        "user_id",
        "email",
        "first_name",
        "last_name",
        values.full_name("first_name", "last_name").alias("full_name"),
        "last_used_timezone",
        "user_created_at",
        "user_updated_at",
        "user_object_text",
        "source_file_name",
        "source_row_number",
        "insert_date",
        "bronze_loaded_at",
    )


def dim_date(rows: DataFrame, date: str) -> DataFrame:
    """Every calendar day between the first and last date of a table."""
    span = rows.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    days = span.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last")).alias("date_day")
    )
    return days.select(
        "date_day",
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"),
        F.dayofmonth("date_day").alias("day_of_month"),
        F.weekday("date_day").alias("day_of_week"),
        F.weekofyear("date_day").alias("week_of_year"),
        F.to_date(F.date_trunc("month", "date_day")).alias("month_start"),
    )


def dim_activity_type(type_map: DataFrame) -> DataFrame:
    return type_map.where(values.is_true("is_active")).drop("is_active")


def dim_outcome(outcome_map: DataFrame) -> DataFrame:
    key = values.joined_key(F.col("canonical_field_name"), F.col("raw_value"))
    return outcome_map.withColumn("outcome_id", key)


# --- funnel events and facts --------------------------------------------------------


def active_types(type_map: DataFrame, stages: list[str]) -> DataFrame:
    return type_map.where(
        values.is_true("is_active") & F.col("funnel_stage").isin(stages)
    ).select("custom_activity_type_id", "funnel_source", "funnel_stage")


EVENT_COLUMNS = [
    "lead_id",
    "activity_id",
    "custom_activity_type_id",
    "activity_at",
    "activity_updated_at",
    "user_id",
]


def business_fields(events: DataFrame, field_map: DataFrame, keep: list[str]) -> DataFrame:
    """Events reduced to ``keep`` and the text of their mapped business fields.

    With a mapping of usual size the fields are read in a projection: each event is one row
    already, so a long form and a pivot back would only shuffle the same rows again.
    """
    names = TEXT_FIELDS + MONEY_FIELDS + ROLE_FIELDS
    return fields.read_fields(
        events, "activity", keep, field_map, names, as_json=["objections_faced"]
    )


def typed_events(wide: DataFrame, type_map: DataFrame, stages: list[str]) -> DataFrame:
    """Events of active types in some stages, with amounts as money and roles filled in."""
    mapped = wide.join(active_types(type_map, stages), "custom_activity_type_id")
    return mapped.select(
        *EVENT_COLUMNS,
        "funnel_source",
        "funnel_stage",
        *TEXT_FIELDS,
        *[values.money(m).alias(m) for m in MONEY_FIELDS],
        *[F.coalesce(F.col(r), F.col("user_id")).alias(r) for r in ROLE_FIELDS],
    )


def funnel_events(
    events: DataFrame,
    type_map: DataFrame,
    field_map: DataFrame,
    stages: list[str] = FUNNEL_STAGES,
) -> DataFrame:
    """Mapped events with their business fields, from deduplicated custom activities."""
    return typed_events(business_fields(events, field_map, EVENT_COLUMNS), type_map, stages)


def latest_funnel_events(
    activities: DataFrame,
    type_map: DataFrame,
    field_map: DataFrame,
    stages: list[str] = FUNNEL_STAGES,
) -> DataFrame:
    """The same from delivered activities, where no deduplicated table is stored.

    The documents are reduced to their business fields first, so the deduplication
    shuffles a few short columns instead of whole documents.
    """
    custom = activities.where(F.col("activity_type") == "CustomActivity")
    narrow = business_fields(custom, field_map, EVENT_COLUMNS + TIES)
    return typed_events(latest_by(narrow, ["lead_id", "activity_id"], NEWEST + TIES), type_map, stages)


def activity_fields(activities: DataFrame, field_map: DataFrame) -> DataFrame:
    """Every activity as a narrow row: its columns, shredded and business fields.

    For readers of several kinds: written once, documents are opened once for all of them.
    """
    rows = activities if set(SHREDDED) <= set(activities.columns) else shred(activities)
    keep = [*EVENT_COLUMNS, *TIES, "activity_type", *SHREDDED]
    return business_fields(rows, field_map, keep)


def latest_of_fields(
    rows: DataFrame, type_map: DataFrame, stages: list[str] = FUNNEL_STAGES
) -> DataFrame:
    """Funnel events out of stored :func:`activity_fields`."""
    custom = rows.where(F.col("activity_type") == "CustomActivity")
    latest = latest_by(custom, ["lead_id", "activity_id"], NEWEST + TIES)
    return typed_events(latest, type_map, stages)


def pivot_fields(long: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Long field rows (``canonical_field_name``, ``field_value``) to one column per name."""
    return long.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("canonical_field_name") == n, F.col("field_value"))).alias(n)
            for n in names
        ]
    )


UNIT = "unit"


def unit_of(lead: str, activity: str) -> Column:
    """What is matched on its own: a lead, or an activity without lead (which never matches).

    A key to store events by: activities without lead are spread, not gathered as one lead.
    """
    return F.coalesce(
        F.concat(F.lit("lead "), F.col(lead)), F.concat(F.lit("activity "), F.col(activity)), F.lit("")
    )


def path_category(strategy_id: Column, sale_id: Column) -> Column:
    return (
        F.when(strategy_id.isNotNull() & sale_id.isNotNull(), "initial_to_strategy_to_sale")
        .when(strategy_id.isNotNull(), "initial_to_strategy_no_sale")
        .otherwise("initial_no_strategy")
    )


def funnel_paths(
    events: DataFrame, max_rows: int = HEAVY_ROWS, key: str = "lead_id"
) -> DataFrame:
    """One row per initial contact with its first later strategy call and that call's sale.

    The sale is found for every strategy call first and travels with it, so both steps
    share one shuffle and one sort by lead. ``events`` must be a stored table. With one that
    is bucketed by its :func:`unit_of`, give that column as ``key``: nothing is shuffled then.
    """
    stage = F.col("funnel_stage")
    matched = first_at_or_after(
        events,
        key=key,
        at="activity_at",
        event_id="activity_id",
        steps=[
            (
                "sale",
                stage == "sale",
                ["custom_activity_type_id", "contract_value", "cash_collected"],
            ),
            (
                "strategy",
                stage == "strategy",
                [
                    "custom_activity_type_id",
                    "closer_user_id",
                    "strategy_outcome",
                    "offer_presented",
                    "objections_faced",
                    "sale",
                ],
            ),
        ],
        max_rows=max_rows,
    )
    call = F.col("strategy")
    sale = call["sale"]
    strategy_id, sale_id = call["activity_id"], sale["activity_id"]
    initial = matched.where(stage == "initial_contact")
    return initial.select(
        values.joined_key(
            F.col("lead_id"),
            F.col("activity_id"),
            F.coalesce(strategy_id, F.lit("")),
            F.coalesce(sale_id, F.lit("")),
        ).alias("lead_funnel_id"),
        "lead_id",
        "funnel_source",
        F.col("activity_id").alias("initial_activity_id"),
        F.col("custom_activity_type_id").alias("initial_activity_type_id"),
        F.col("activity_at").alias("initial_at"),
        "setter_user_id",
        F.coalesce("triage_outcome", "prospecting_outcome").alias("initial_outcome"),
        strategy_id.alias("strategy_activity_id"),
        call["custom_activity_type_id"].alias("strategy_activity_type_id"),
        call["activity_at"].alias("strategy_at"),
        call["closer_user_id"].alias("closer_user_id"),
        call["strategy_outcome"].alias("strategy_outcome"),
        call["offer_presented"].alias("offer_presented"),
        call["objections_faced"].alias("objections_faced"),
        sale_id.alias("sale_activity_id"),
        sale["custom_activity_type_id"].alias("sale_activity_type_id"),
        sale["activity_at"].alias("sale_at"),
        sale["contract_value"].alias("contract_value"),
        sale["cash_collected"].alias("cash_collected"),
        path_category(strategy_id, sale_id).alias("path_category"),
    )


def fact_lead_funnel(
    activities: DataFrame, type_map: DataFrame, field_map: DataFrame, max_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Funnel paths straight from delivered activities."""
    events = latest_funnel_events(activities, type_map, field_map)
    return funnel_paths(stored(events, "funnel_events"), max_rows)


# Which events each stage fact holds: stage and, for initial contacts, source.
STAGE_FACTS = {
    "fact_triage_call": ("initial_contact", "inbound"),
    "fact_outbound_prospecting": ("initial_contact", "outbound"),
    "fact_strategy_call": ("strategy", None),
    "fact_sale": ("sale", None),
}


def stage_fact(events: DataFrame, name: str) -> DataFrame:
    """Events of one stage; sales carry flags for missing and zero revenue."""
    stage, source = STAGE_FACTS[name]
    rows = events.where(F.col("funnel_stage") == stage)
    if source:
        rows = rows.where(F.col("funnel_source") == source)
    if name == "fact_sale":
        rows = rows.withColumns(
            {
                "is_contract_value_missing": F.col("contract_value").isNull(),
                "is_contract_value_zero": values.is_true(F.col("contract_value") == 0),
                "is_cash_collected_missing": F.col("cash_collected").isNull(),
                "is_cash_collected_zero": values.is_true(F.col("cash_collected") == 0),
            }
        )
    return rows


def fact_objection(
    paths: DataFrame, category_map: DataFrame, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per objection named in a path's strategy call, with its category."""
    calls = paths.where(
        F.col("strategy_activity_id").isNotNull() & F.col("objections_faced").isNotNull()
    )
    labels = F.from_json("objections_faced", "array<string>")
    is_list = F.startswith(F.ltrim("objections_faced"), F.lit("["))
    named = calls.select(
        "lead_funnel_id",
        "lead_id",
        "strategy_activity_id",
        values.utc_date("strategy_at").alias("report_date"),
        "strategy_at",
        "closer_user_id",
        *keep,
        F.explode(F.when(is_list, labels)).alias("label"),
    ).select("*", F.trim("label").alias("source_objection_value"))
    categories = category_map.where(values.is_true("is_active")).select(
        F.lower("source_objection_value").alias("match_value"), "normalized_objection_category"
    )
    filled = named.where(values.not_blank("source_objection_value"))
    matched = filled.withColumn("match_value", F.lower("source_objection_value")).join(
        categories, "match_value", "left"
    )
    category = F.coalesce("normalized_objection_category", "source_objection_value")
    return matched.withColumn("objection_category", category).drop(
        "label", "match_value", "normalized_objection_category"
    )
