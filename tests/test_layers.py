"""Deduplication, field extraction, audits and dimensions on hand-made records."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from funnelry.operators import changes, fields
from funnelry.operators.latest import latest_by
from funnelry.operators.skew import join_key_totals, split_heavy
from funnelry.plans import audit, bronze, gold, profile, quality, silver
from funnelry.sources import seeds
from tests.conftest import hours, plan_of

LOADED = dt.datetime(2026, 5, 16, 7, 30)


def raw(spark, payloads, file="f1", load=LOADED):
    rows = [(json.dumps(p), file, n, load.date(), load) for n, p in enumerate(payloads, 1)]
    df = spark.createDataFrame(
        rows,
        "j string, source_file_name string, source_row_number bigint, load_date date, "
        "insert_date timestamp_ntz",
    )
    return df.select(
        F.parse_json("j").alias("raw_data"),
        "source_file_name",
        "source_row_number",
        "load_date",
        "insert_date",
        F.col("insert_date").alias("bronze_loaded_at"),
    )


def activity(id, lead="lead_1", type_id="t1", at="2026-01-01 10:00:00", updated=None, **custom):
    return {
        "id": id,
        "lead_id": lead,
        "_type": "CustomActivity",
        "custom_activity_type_id": type_id,
        "activity_at": at,
        "date_updated": updated,
        "user_id": "user_0",
        **{f"custom.{k}": v for k, v in custom.items()},
    }


def silver_of(spark, *wrappers):
    return silver.silver_activities(
        bronze.stage_lead_activities(raw(spark, [{"data": w} for w in wrappers]))
    )


@pytest.fixture(scope="module")
def maps(spark):
    types = spark.createDataFrame(
        [
            ("t1", "Call", "inbound", "initial_contact", False, True),
            ("t2", "Strategy", None, "strategy", False, True),
            ("old", "Old", "inbound", "initial_contact", False, False),
        ],
        seeds.SEEDS["custom_activity_type_map"],
    )
    known = spark.createDataFrame(
        [
            ("cf_a", "Setter", "user", "setter_user_id", "user_assignment", True),
            ("cf_b", "Setter", "user", "setter_user_id", "user_assignment", True),
            ("cf_o", "Outcome", "choices", "triage_outcome", "outcome", True),
            ("cf_m", "Value", "number", "contract_value", "revenue", True),
            ("cf_old", "Gone", "choices", "strategy_outcome", "outcome", False),
        ],
        seeds.SEEDS["custom_field_map"],
    )
    return types, known


def test_flatten_keeps_order_and_skips_non_arrays(spark):
    flat = silver_of(spark, [activity("a"), activity("b")], [], None, "text", {"id": "x"})
    rows = flat.select("activity_id", "activity_array_index", "source_row_number").collect()
    assert sorted(tuple(r) for r in rows) == [("a", 0, 1), ("b", 1, 1)]


def test_latest_version_rules(spark):
    df = spark.createDataFrame(
        [
            ("k1", hours(1), hours(1), 1),
            ("k1", hours(2), hours(0), 2),
            ("k1", None, hours(9), 3),
            ("k2", None, hours(1), 4),
            ("k2", None, hours(2), 5),
            ("k3", hours(1), hours(1), 6),
            ("k3", hours(1), hours(1), 7),
            (None, hours(1), hours(1), 8),
            (None, hours(2), hours(1), 9),
        ],
        "k string, updated timestamp_ntz, at timestamp_ntz, row int",
    )
    latest = latest_by(df, ["k"], ["updated", "at", "row"])
    assert {r.k: r.row for r in latest.collect()} == {"k1": 2, "k2": 5, "k3": 7, None: 9}


def test_copies_are_reduced_before_the_shuffle(spark):
    plan = plan_of(latest_by(spark.range(10).selectExpr("id % 2 k", "id"), ["k"], ["id"]))
    final, partial = plan.index("Exchange"), plan.rindex("WindowGroupLimit")
    assert "Partial" in plan[partial : partial + 200] and final < partial


def test_deduplication_prefers_update_time_over_activity_time(spark):
    older = activity("a", at="2026-02-01 00:00:00", updated="2026-01-01 00:00:00", cf_o="old")
    newer = activity("a", at="2026-01-01 00:00:00", updated="2026-01-02 00:00:00", cf_o="new")
    events = silver.custom_activity_events(silver_of(spark, [newer], [older]))
    assert [fields_of(r) for r in with_field(events, "cf_o").collect()] == [("a", "new")]


def with_field(events, field_id):
    return events.select("activity_id", fields.mapped_text("activity", [field_id]).alias("v"))


def fields_of(row):
    return row.activity_id, row.v


def test_field_collision_takes_the_greatest(spark, maps):
    types, known = maps
    activities = silver_of(
        spark,
        [
            activity("a", cf_a="user_1", cf_b="user_2"),
            activity("b", cf_b="user_9"),
            activity("c"),
            activity("d", cf_a=None, cf_m="$1,000.50"),
        ],
    )
    stored = silver.custom_activity_events(activities)
    for found in (
        gold.funnel_events(stored, types, known),
        gold.latest_funnel_events(activities, types, known),
    ):
        rows = {r.activity_id: r for r in found.collect()}
        setters = {i: r.setter_user_id for i, r in rows.items()}
        assert setters == {"a": "user_2", "b": "user_9", "c": "user_0", "d": "user_0"}
        assert str(rows["d"].contract_value) == "1000.50"


def test_projection_equals_long_form_and_pivot(spark, maps):
    _, known = maps
    events = silver.custom_activity_events(
        silver_of(spark, [activity("a", cf_a="x", cf_b="y", cf_zz="?"), activity("b"), activity("c", cf_o="")])
    )
    names = ["setter_user_id", "triage_outcome"]
    long = fields.explode_mapped_fields(events, "activity", ["activity_id"], known)
    assert sorted((r.activity_id, r.canonical_field_name or "") for r in long.collect()) == [
        ("a", "setter_user_id"),
        ("a", "setter_user_id"),
        ("b", ""),
        ("c", "triage_outcome"),
    ]
    pivoted = gold.pivot_fields(long, ["activity_id"], names)
    projected = fields.read_fields(events, "activity", ["activity_id"], known, names)
    assert sorted(pivoted.collect()) == sorted(projected.select(pivoted.columns).collect())
    joined = fields.read_fields(events, "activity", ["activity_id"], known, names, max_rows=0)
    assert sorted(pivoted.collect()) == sorted(joined.select(pivoted.columns).collect())
    joined = fields.explode_mapped_fields(events, "activity", ["activity_id"], known, max_rows=0)
    assert sorted(joined.collect(), key=str) == sorted(long.collect(), key=str)


def test_outcomes_of_any_mapping_size(spark, maps):
    _, known = maps
    staged = [activity("a", cf_o="ok"), activity("b", cf_o=""), activity("c", cf_o=None)]
    events = silver.custom_activity_events(silver_of(spark, staged))
    small, large = (audit.observed_outcomes(events, known, n).collect() for n in (1000, 0))
    assert small == large and [r.raw_value for r in small] == ["ok"]


def test_audits(spark, maps):
    types, known = maps
    outcomes = spark.createDataFrame([("Outcome", "ok")], "field_name string, raw_value string")
    events = silver.custom_activity_events(
        silver_of(
            spark,
            [
                activity("a", cf_o="ok", cf_new="1"),
                activity("b", type_id="old", cf_o="odd", cfX="1"),
                activity("c", type_id=None, cf_o="", cf_old="seen"),
                activity("d", type_id="t9", lead="lead_2", cf_o=None),
            ],
        )
    )
    found = audit.unmapped_activity_types(events, types).collect()
    assert {r.custom_activity_type_id: r.event_count for r in found} == {"old": 1, None: 1, "t9": 1}
    # The wildcard in the prefix also matches cfX; inactive fields count as unmapped.
    found = audit.unmapped_fields(events, known).collect()
    assert {r.custom_field_id for r in found} == {"cf_new", "cfX", "cf_old"}
    found = audit.unmapped_outcomes(events, known, outcomes).collect()
    assert [(r.field_name, r.raw_value, r.distinct_activity_count) for r in found] == [("Outcome", "odd", 1)]


def test_users_from_malformed_text(spark):
    texts = [
        "{'data': [{'id': 'user_1', 'email': 'a@b', 'first_name': 'Ann', 'date_updated': '2026-01-01 00:00:00'}, "
        "{'id': 'user_2', 'email': '', 'last_name': 'Roe'}]}",
        "{'data': [{'id': 'user_1', 'email': 'new@b', 'first_name': 'Ann', 'last_name': 'Doe', "
        "'date_updated': '2026-02-01 00:00:00'}, {'id': 'user_3', 'org': {'a': 1}}, {'id': 'lead_1'}]}",
        "nothing here",
    ]
    staged = bronze.stage_users(raw(spark, [{"JSON_OBJECT": t} for t in texts]))
    users = {r.user_id: r for r in gold.dim_user(staged).collect()}
    assert set(users) == {"user_1", "user_2"}
    assert (users["user_1"].email, users["user_1"].full_name) == ("new@b", "Ann Doe")
    assert (users["user_2"].email, users["user_2"].first_name, users["user_2"].full_name) == ("", None, "Roe")


def test_leads_keep_newest_and_drop_missing_ids(spark):
    leads = [
        {"id": "l1", "name": "old", "date_updated": "2026-01-01 00:00:00"},
        {"id": "l1", "name": "new", "date_updated": "2026-01-02 00:00:00"},
        {"id": "l1", "name": "undated"},
        {"name": "no id"},
    ]
    found = gold.dim_lead(bronze.stage_leads(raw(spark, leads))).collect()
    assert [(r.lead_id, r.lead_name) for r in found] == [("l1", "new")]


def test_metadata_patterns(spark):
    text = (
        "{'data': [{'id': 'actitype_1', 'x': 'y', 'name': 'Call', 'fields': [{'id': 'cf_1', 'name': 'Out', "
        "'req': False, 'type': 'choices'}]}, {'id': 'actitype_2', 'name': ''}]}"
    )
    staged = bronze.stage_custom_activities(raw(spark, [{"JSON_OBJECT": text}, {"JSON_OBJECT": text}]))
    assert sorted(map(tuple, profile.type_names(staged).collect())) == [("actitype_1", "Call"), ("actitype_2", "")]
    assert list(map(tuple, profile.field_names(staged).collect())) == [("cf_1", "Out", "choices")]


def test_upsert_keeps_first_insert_and_last_update(spark):
    schema = "k string, v string, at timestamp_ntz, insert_date timestamp_ntz, update_date timestamp_ntz"
    old = spark.createDataFrame(
        [("a", "1", hours(5), hours(0), hours(0)), ("b", "1", None, hours(0), hours(0))], schema
    )
    new = spark.createDataFrame(
        [("a", "0", hours(4), hours(9), hours(9)), ("b", "2", hours(1), hours(9), hours(9)), ("c", "3", None, hours(9), hours(9))],
        schema,
    )
    found = {r.k: (r.v, r.insert_date, r.update_date) for r in changes.upsert_latest(old, new, ["k"], ["at"]).collect()}
    assert found == {
        "a": ("1", hours(0), hours(9)),
        "b": ("2", hours(0), hours(9)),
        "c": ("3", hours(9), hours(9)),
    }


def test_change_classes(spark):
    before = spark.createDataFrame([("a", "1"), ("b", None), ("c", "1")], "k string, v string")
    after = spark.createDataFrame([("a", "1"), ("b", ""), ("d", "1")], "k string, v string")
    found = changes.classify_changes(before, after, ["k"], ["v"])
    assert {r.k: r.change_type for r in found.collect()} == {
        "a": "unchanged",
        "b": "update",
        "c": "missing",
        "d": "insert",
    }


def test_upsert_ties_and_null_keys(spark):
    schema = "k string, v string, at timestamp_ntz, insert_date timestamp_ntz, update_date timestamp_ntz"
    old = spark.createDataFrame(
        [("a", "9", hours(5), hours(0), hours(0)), (None, "1", hours(1), hours(0), hours(0))], schema
    )
    new = spark.createDataFrame(
        [
            ("a", "1", hours(5), hours(9), hours(9)),
            ("a", "1", hours(5), hours(8), hours(8)),
            (None, "2", hours(2), hours(9), hours(9)),
        ],
        schema,
    )
    merged = changes.upsert_latest(old, new, ["k"], ["at"])
    assert {tuple(r) for r in merged.select("k", "v", "insert_date", "update_date").collect()} == {
        ("a", "1", hours(0), hours(9)),
        (None, "2", hours(0), hours(9)),
    }
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_change_classes_of_repeated_and_null_keys(spark):
    schema = "k string, v string, n int"
    before = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), (None, "1", 1)], schema)
    after = spark.createDataFrame([("a", "2", 1), ("a", "2", 1), (None, "3", 1)], schema)
    found = changes.classify_changes(before, after, ["k"], ["v"], newest=["n"]).collect()
    assert sorted((r.k or "", r.change_type) for r in found) == [("", "update"), ("a", "unchanged")]


def test_heavy_keys_are_split_off_and_rejoined(spark):
    rows = spark.range(300).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 20)) AS k", "id")
    rows = rows.unionByName(spark.createDataFrame([(None, 1)], "k string, id long"))
    ordinary, heavy = split_heavy(rows, "k", max_rows=50)
    assert {r.k for r in heavy.select("k").distinct().collect()} == {"hot"}
    assert ordinary.count() + heavy.count() == 301 and ordinary.where("k IS NULL").count() == 1
    totals = rows.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
    split = join_key_totals(rows, totals, "k", max_rows=50)
    whole = rows.join(totals, "k", "left")
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_constraints_are_counted_as_failures(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), ("b", None), ("b", "q"), ("b", "q")], "k string, s string")
    rules = quality.Constraints(not_null=("k", "s"), unique=("k",), accepted={"s": ("x", "y", "z")})
    found = {(r.column_name, r.test_name): r.failures for r in quality.check_columns(df, "t", rules).collect()}
    assert found == {
        ("k", "not_null"): 1,
        ("s", "not_null"): 1,
        ("k", "unique"): 2,
        ("s", "accepted_values"): 2,
    }
    with pytest.raises(quality.CheckFailed):
        quality.require_empty(df, "t")
    quality.require_empty(df.limit(0), "t")


def test_packaged_seeds_meet_their_constraints(spark):
    tables = seeds.load_seeds(spark)
    assert {n: t.count() for n, t in tables.items()} == {
        "custom_activity_type_map": 25,
        "custom_field_map": 19,
        "funnel_outcome_map": 25,
        "objection_category_map": 15,
    }
    failures = quality.check_tables(tables).where("failures > 0").collect()
    assert failures == []


def test_seed_from_a_csv_path_equals_the_packaged_one(spark, tmp_path):
    from importlib import resources

    for name in seeds.SEEDS:
        text = resources.files("funnelry").joinpath("seeds", f"{name}.csv").read_text()
        (tmp_path / f"{name}.csv").write_text(text)
        loaded = seeds.load_seed(spark, name, str(tmp_path / f"{name}.csv"))
        assert loaded.schema == seeds.SEEDS[name]
        assert sorted(map(str, loaded.collect())) == sorted(map(str, seeds.load_seed(spark, name).collect()))


def test_sale_sources_count_pairs_without_making_them(spark):
    rows = [activity("s1", cf_out="6. Sale", type_id="st"), activity("s2", cf_out="6. Sale", type_id="st")]
    rows += [activity(f"n{i}", type_id="sale", cf_v="10") for i in range(3)]
    rows += [activity("n9", lead="lead_2", type_id="sale", cf_v="5"), activity("s9", lead="lead_3", type_id="st", cf_out="6. Sale")]
    rows += [activity("s8", lead=None, type_id="st", cf_out="6. Sale"), activity("n8", lead=None, type_id="sale", cf_v="1")]
    events = silver.custom_activity_events(silver_of(spark, rows))
    found = profile.sale_source_compare(events, "st", "cf_out", "6. Sale", ["sale"], "cf_v", "cf_c")
    by_category = {r.sale_match_category: (r.lead_count, float(r.total_contract_value or 0)) for r in found.collect()}
    # 2 calls x 3 sales x 10; rows without a lead share one group but never pair up.
    assert by_category == {
        "strategy_sale_and_new_sale": (2, 61.0),
        "new_sale_only": (1, 5.0),
        "strategy_sale_only": (1, 0.0),
    }


def test_catalog_leaves_out_views_of_the_session(spark):
    spark.range(3).createOrReplaceTempView("view_of_the_session")
    database = "catalogued_beside_views"
    spark.sql(f"CREATE DATABASE {database}")
    spark.range(5).write.saveAsTable(f"{database}.numbers")
    rows = profile.catalog_profile(spark, database).collect()
    assert [(r["table_name"], r["row_count"]) for r in rows] == [("numbers", 5)]
    spark.catalog.dropTempView("view_of_the_session")
