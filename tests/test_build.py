"""The whole build, and the plans it runs."""

import pytest
from pyspark.sql import functions as F

from checks import crm
from checks.queries import QUERIES, Crm
from funnelry.plans import build, profile, quality
from funnelry.sources import seeds
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models(spark):
    return build.build(crm.raw_tables(spark, SF), seeds.load_seeds(spark), environment="dev", buckets=6)


def test_layers_become_tables_of_their_environment(spark, models):
    names = {r.table_name for r in profile.table_inventory(spark, "dev_gold").collect()}
    assert {"dim_user", "fact_lead_funnel", "rpt_closer", "fact_sale"} <= names
    assert spark.table("dev_silver.silver_activities").count() == models["silver_activities"].count()
    assert spark.table("dev_audit_audit_unmapped_custom_fields").count() == 2


def test_build_equals_the_direct_queries(spark, models):
    for model, query in (("fact_lead_funnel", "fact_lead_funnel"), ("rpt_closer", "rpt_closer")):
        direct = QUERIES[query](spark, SF)
        built = models[model].select(
            *[F.col(c).cast(t) for c, t in direct.dtypes]
        )
        assert sorted(map(str, built.collect())) == sorted(map(str, direct.collect()))


def test_rebuild_changes_nothing(spark, models):
    before = sorted(map(str, models["rpt_inbound_setter"].collect()))
    again = build.build(crm.raw_tables(spark, SF), seeds.load_seeds(spark), environment="again", buckets=3)
    assert sorted(map(str, again["rpt_inbound_setter"].collect())) == before


def test_strict_build_stops_at_unmapped_codes(spark):
    with pytest.raises(quality.CheckFailed, match="audit_unmapped_custom_activity_types"):
        build.build(crm.raw_tables(spark, SF), seeds.load_seeds(spark), "strict", strict=True)


def test_one_row_per_contact_and_ordered_stages(models):
    paths = models["fact_lead_funnel"]
    contacts = models["funnel_events"].where("funnel_stage = 'initial_contact'").count()
    assert paths.count() == contacts == paths.select("initial_activity_id").distinct().count()
    assert paths.where("strategy_at < initial_at OR sale_at < strategy_at").isEmpty()
    assert paths.where("sale_activity_id IS NOT NULL AND strategy_activity_id IS NULL").isEmpty()


def test_constraints_of_the_built_models(models):
    failed = quality.check_tables(models).where("failures > 0").collect()
    # The derived records contain activities without type and events without user on purpose.
    assert {(r.table_name, r.column_name) for r in failed} <= {
        ("silver_custom_activity_events", "custom_activity_type_id"),
        ("audit_unmapped_custom_activity_types", "custom_activity_type_id"),
        ("rpt_inbound_setter", "setter_user_id"),
        ("rpt_outbound_setter", "setter_user_id"),
        ("rpt_closer", "closer_user_id"),
    }


def test_deduplication_moves_fields_not_documents(spark):
    """What the funnel shuffles is short columns; the documents stay with the scan."""
    c = Crm(spark, SF)
    from funnelry.plans import gold

    events = gold.latest_funnel_events(c.activities, c.types, c.field_map)
    plan = plan_of(events)
    exchange = plan.index("Exchange hashpartitioning")
    assert "try_variant_get(activity" not in plan[:exchange]
    assert plan.index("Partial", exchange) > exchange  # copies reduced below the exchange


def test_projection_reaches_the_scan(spark):
    plan = plan_of(QUERIES["multi_distinct"](spark, SF))
    schema = plan[plan.index("ReadSchema") :]
    assert "l_orderkey" in schema and "l_extendedprice" not in schema


def test_evidence_of_built_tables_leaves_documents_closed(spark, models):
    from funnelry.plans import reports

    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = plan_of(reports.booking_evidence(models["silver_activities"]))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = plan[plan.index("ReadSchema") :]
    assert "title" in schema and "sequence_name" in schema
    assert "activity:variant" not in plan and "variant_get" not in plan


def test_constraints_of_a_table_take_one_scan(spark, models):
    rules = quality.Constraints(
        not_null=("user_id", "email"), unique=("user_id", "email", "last_name"), accepted={"first_name": ("x",)}
    )
    checked = quality.check_columns(models["dim_user"], "dim_user", rules)
    assert plan_of(checked).count("FileScan") == 1
    by_hand = {}
    users = [r.asDict() for r in models["dim_user"].collect()]
    for c in rules.unique:
        seen = [u[c] for u in users if u[c] is not None]
        by_hand[c, "unique"] = sum(seen.count(x) > 1 for x in set(seen))
    for c in rules.not_null:
        by_hand[c, "not_null"] = sum(u[c] is None for u in users)
    by_hand["first_name", "accepted_values"] = sum(u["first_name"] is not None for u in users)
    assert {(r.column_name, r.test_name): r.failures for r in checked.collect()} == by_hand


def test_matching_stored_events_shuffles_nothing(models):
    from funnelry.plans import gold

    events = models["funnel_events"]
    paths = gold.funnel_paths(events, key=gold.UNIT)
    assert "Exchange" not in plan_of(paths) and "Window" in plan_of(paths)
    by_lead = gold.funnel_paths(events.drop(gold.UNIT))
    assert sorted(map(str, paths.collect())) == sorted(map(str, by_lead.collect()))
    # Heavy leads are split from stored events as well.
    heavy = gold.funnel_paths(events, max_rows=3, key=gold.UNIT)
    assert sorted(map(str, heavy.collect())) == sorted(map(str, by_lead.collect()))
