"""Ordered matching: ties, missing times, fan-out, heavy leads, partitioning."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from funnelry.operators.asof import first_at_or_after, with_lane, with_shares
from funnelry.plans.gold import funnel_paths
from tests.conftest import hours, plan_of

SCHEMA = (
    "lead_id string, activity_id string, custom_activity_type_id string, activity_at timestamp_ntz, "
    "activity_updated_at timestamp_ntz, user_id string, funnel_source string, funnel_stage string, "
    "triage_outcome string, prospecting_outcome string, strategy_outcome string, offer_presented string, "
    "objections_faced string, contract_value decimal(18,2), cash_collected decimal(18,2), "
    "setter_user_id string, closer_user_id string"
)
STAGES = {"i": "initial_contact", "s": "strategy", "n": "sale"}


def events(spark, rows):
    """Rows of (lead, id, stage letter, time)."""
    full = [
        (lead, i, "t", at, at, "u", "inbound" if s == "i" else None, STAGES[s], *[None] * 9)
        for lead, i, s, at in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


def paths(spark, rows, **options):
    found = funnel_paths(events(spark, rows), **options).collect()
    return {r.initial_activity_id: (r.strategy_activity_id, r.sale_activity_id) for r in found}


def expected(rows):
    """Brute force over all pairs."""

    def first(lead, at, stage):
        later = [
            (t, i) for x, i, s, t in rows if x == lead and s == stage and t is not None and t >= at
        ]
        return min(later, default=(None, None))

    found = {}
    for lead, i, s, at in rows:
        if s != "i":
            continue
        call_at, call = first(lead, at, "s") if lead is not None and at is not None else (None, None)
        sale = first(lead, call_at, "n")[1] if call is not None else None
        found[i] = (call, sale)
    return found


#: The whole-lead form, the split form for all, and a mix of both.
FORMS = [2_000_000, 0, 6]


@pytest.mark.parametrize("max_rows", FORMS)
def test_same_instant_and_id_order(spark, max_rows):
    rows = [
        ("a", "i1", "i", hours(1)),
        ("a", "s2", "s", hours(1)),
        ("a", "s1", "s", hours(1)),
        ("a", "n1", "n", hours(1)),
    ]
    assert paths(spark, rows, max_rows=max_rows) == {"i1": ("s1", "n1")}


@pytest.mark.parametrize("max_rows", FORMS)
def test_missing_times_and_leads_never_match(spark, max_rows):
    rows = [
        ("a", "i1", "i", None),
        ("a", "s1", "s", hours(1)),
        ("a", "n1", "n", hours(2)),
        ("b", "i2", "i", hours(0)),
        ("b", "s2", "s", None),
        (None, "i3", "i", hours(0)),
        (None, "s3", "s", hours(1)),
        ("c", "i4", "i", hours(0)),
    ]
    assert paths(spark, rows, max_rows=max_rows) == {
        "i1": (None, None),
        "i2": (None, None),
        "i3": (None, None),
        "i4": (None, None),
    }


@pytest.mark.parametrize("max_rows", FORMS)
def test_contacts_share_a_sale(spark, max_rows):
    rows = [
        ("a", "i1", "i", hours(0)),
        ("a", "i2", "i", hours(1)),
        ("a", "s1", "s", hours(2)),
        ("a", "n0", "n", hours(1)),
        ("a", "n1", "n", hours(3)),
    ]
    assert paths(spark, rows, max_rows=max_rows) == {"i1": ("s1", "n1"), "i2": ("s1", "n1")}


@pytest.mark.parametrize("max_rows", FORMS)
def test_agrees_with_brute_force_when_one_lead_holds_a_third(spark, max_rows):
    rng = random.Random(7)
    rows = []
    for n in range(600):
        lead = "hot" if n % 3 == 0 else f"lead_{rng.randrange(40)}"
        lead = None if rng.random() < 0.03 else lead
        at = hours(rng.randrange(60)) + dt.timedelta(seconds=rng.choice([0, 0, 1, 59, 61]))
        at = None if rng.random() < 0.05 else at
        rows.append((lead, f"e{n:04d}", rng.choice("iisn"), at))
    assert paths(spark, rows, max_rows=max_rows) == expected(rows)


def test_rows_of_one_crowded_instant_are_shared_out(spark):
    """A bulk import: most rows of the heavy lead carry the same time."""
    rows = [("hot", f"i{n:03d}", "i", hours(0)) for n in range(200)]
    rows += [("hot", "s1", "s", hours(0)), ("hot", "s2", "s", hours(1)), ("hot", "n1", "n", hours(5))]
    rows += [("cold", "i900", "i", hours(0)), (None, "i901", "i", hours(0)), ("hot", "i902", "i", None)]
    assert paths(spark, rows, max_rows=20) == expected(rows)
    lanes = with_lane(events(spark, rows), "lead_id", "activity_at", "activity_id")
    shared = with_shares(lanes, "lead_id", "activity_at", "activity_id", 20)
    crowd = shared.where("lead_id = 'hot' AND activity_at IS NOT NULL")
    largest = crowd.groupBy("activity_at", "_share").count().agg({"count": "max"}).first()[0]
    assert crowd.select("_share").distinct().count() == 11 and largest < 60


def test_shuffle_partitions_do_not_matter(spark):
    rng = random.Random(3)
    rows = [
        (f"l{rng.randrange(9)}", f"e{n}", rng.choice("isn"), hours(rng.randrange(20)))
        for n in range(200)
    ]
    results = []
    for partitions in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append(paths(spark, rows))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1] == expected(rows)


def test_both_steps_share_one_shuffle(spark):
    rows = [("a", "i1", "i", hours(0)), ("a", "s1", "s", hours(1))]
    plan = plan_of(funnel_paths(events(spark, rows)))
    assert plan.count("Exchange") == 1
    assert plan.count("Sort ") == 1
    assert "Join" not in plan


def test_invariants_hold_on_driver_events(spark):
    source = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    step = ("found", F.col("event_type") == "click", [])
    matched = first_at_or_after(source, "user_id", "ts", "event_id", [step], max_rows=70)
    assert matched.count() == source.count()
    assert matched.where("found.ts < ts").isEmpty()


def test_one_heavy_lead_is_linear(spark):
    """100,000 rows of one lead: the mirrored window frame would need hours here."""
    rows = spark.range(100_000).select(
        F.lit(1).alias("k"),
        F.col("id"),
        F.timestamp_seconds(F.col("id") * 7).cast("timestamp_ntz").alias("at"),
    )
    step = ("found", F.col("id") % 1000 == 0, [])
    matched = first_at_or_after(rows, "k", "at", "id", [step])
    expected_id = F.ceil(F.col("id") / 1000) * 1000
    wrong = matched.where(F.col("found.id") != expected_id)
    assert wrong.isEmpty()
    assert matched.where("found is null").count() == 999


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_heavy_form_across_a_clock_change(spark, kind):
    """Minutes stay in time order where New York clocks go back and forth."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for start in (1_762_060_000, 1_772_950_000):  # around November and March changes
            rows = spark.range(0, 400).select(
                F.lit("k").alias("k"),
                "id",
                F.timestamp_seconds(F.lit(start) + F.col("id") * 53).cast(kind).alias("at"),
            )
            step = ("found", F.col("id") % 7 == 0, [])
            split = first_at_or_after(rows, "k", "at", "id", [step], max_rows=0)
            whole = first_at_or_after(rows, "k", "at", "id", [step])
            columns = ["id", "found.id"]
            assert sorted(map(str, split.select(columns).collect())) == sorted(
                map(str, whole.select(columns).collect())
            )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
