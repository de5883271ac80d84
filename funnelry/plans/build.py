"""All layers from raw tables to reports, in dependency order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from funnelry.plans import audit, bronze, gold, quality, reports, silver
from funnelry.sources.tables import materialise

#: Audits that must be empty before reports are trusted; unknown fields only warn.
GATES = ["audit_unmapped_custom_activity_types", "audit_unmapped_funnel_outcomes"]


def build(
    raw: Mapping[str, DataFrame],
    seeds: Mapping[str, DataFrame],
    environment: str = "",
    strict: bool = False,
    buckets: int = 200,
) -> dict[str, DataFrame]:
    """Creates every model and returns them by name.

    Tables read by several models are stored once and read back with only the columns
    each model needs. With ``strict``, unmapped types or outcomes stop the build. Funnel
    events are stored in ``buckets`` by lead, so matching them shuffles nothing.
    """
    models: dict[str, DataFrame] = {}

    def make(layer: str, name: str, df: DataFrame, *layout) -> DataFrame:
        models[name] = materialise(df, layer, name, environment, *layout)
        return models[name]

    seeds = {name: make("reference", name, seed) for name, seed in seeds.items()}
    types, known_fields = seeds["custom_activity_type_map"], seeds["custom_field_map"]
    outcomes, categories = seeds["funnel_outcome_map"], seeds["objection_category_map"]

    leads = make("bronze", "stg_bronze__leads_raw", bronze.stage_leads(raw["leads_raw"]))
    wrappers = make(
        "bronze",
        "stg_bronze__lead_activities_raw",
        bronze.stage_lead_activities(raw["lead_activities_raw"]),
    )
    make(
        "bronze",
        "stg_bronze__custom_activities_raw",
        bronze.stage_custom_activities(raw["custom_activities_raw"]),
    )
    staged_users = make(
        "bronze",
        "stg_bronze__close_crm_users_raw",
        bronze.stage_users(raw["close_crm_users_raw"]),
    )

    activities = make(
        "silver",
        "silver_activities",
        silver.shred(silver.silver_activities(wrappers)),
        "load_date",
    )
    events = make(
        "silver", "silver_custom_activity_events", silver.custom_activity_events(activities)
    )

    others = make("silver", "other_events", silver.other_events(activities))
    for kind in silver.TYPE_FIELDS:
        make("silver", f"{kind.lower()}_events", silver.events_by_type(others, kind))

    make(
        "audit",
        "audit_unmapped_custom_activity_types",
        audit.unmapped_activity_types(events, types),
    )
    make("audit", "audit_unmapped_custom_fields", audit.unmapped_fields(events, known_fields))
    make(
        "audit",
        "audit_unmapped_funnel_outcomes",
        audit.unmapped_outcomes(events, known_fields, outcomes),
    )
    if strict:
        for gate in GATES:
            quality.require_empty(models[gate], gate)

    make("gold", "dim_lead", gold.dim_lead(leads))
    users = make("gold", "dim_user", gold.dim_user(staged_users))
    make("gold", "dim_activity_type", gold.dim_activity_type(types))
    make("gold", "dim_outcome", gold.dim_outcome(outcomes))
    narrow = gold.funnel_events(events, types, known_fields)
    by_unit = narrow.withColumn(gold.UNIT, gold.unit_of("lead_id", "activity_id"))
    narrow = make("gold", "funnel_events", by_unit, None, (gold.UNIT, buckets))
    for name in gold.STAGE_FACTS:
        make("gold", name, gold.stage_fact(narrow.drop(gold.UNIT), name))
    paths = make("gold", "fact_lead_funnel", gold.funnel_paths(narrow, key=gold.UNIT))
    make("gold", "fact_objection", gold.fact_objection(paths, categories))

    inbound = reports.rpt_inbound_setter(paths, activities, users, outcomes)
    make("gold", "rpt_inbound_setter", inbound)
    make("gold", "rpt_outbound_setter", reports.rpt_outbound_setter(paths, users, outcomes))
    make("gold", "rpt_closer", reports.rpt_closer(paths, users, outcomes))
    make("gold", "rpt_objections_faced", reports.rpt_objections_faced(paths, categories))
    make("gold", "dim_date", gold.dim_date(models["rpt_inbound_setter"], "report_date"))
    return models
