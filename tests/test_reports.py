"""Report rules that the derived driver data may not reach."""

import datetime as dt
from decimal import Decimal

from funnelry.plans import dashboard, gold, reports
from funnelry.sources import seeds
from tests.conftest import hours
from tests.test_layers import raw
from funnelry.plans import bronze, silver

PATH = (
    "lead_funnel_id string, lead_id string, funnel_source string, initial_activity_id string, initial_at timestamp_ntz, "
    "setter_user_id string, initial_outcome string, strategy_activity_id string, strategy_at timestamp_ntz, "
    "closer_user_id string, strategy_outcome string, offer_presented string, objections_faced string, "
    "sale_activity_id string, contract_value decimal(18,2), cash_collected decimal(18,2)"
)
USERS = [("user_1", "Ann Doe", "a@b")]


def paths(spark, *rows):
    names = [f.strip().split(" ")[0] for f in PATH.replace("decimal(18,2)", "decimal").split(",")]
    full = [tuple({"lead_funnel_id": f"p{n}", **r}.get(c) for c in names) for n, r in enumerate(rows)]
    return spark.createDataFrame(full, PATH)


def users(spark):
    return spark.createDataFrame(USERS, "user_id string, full_name string, email string")


def activities(spark, *items):
    return silver.silver_activities(bronze.stage_lead_activities(raw(spark, [{"data": list(items)}])))


def meeting(id, lead, user, at, **more):
    return {"id": id, "lead_id": lead, "_type": "Meeting", "activity_at": at, "user_id": user, **more}


def test_objections_flatten_normalise_and_share(spark):
    def call(n, objections, at=hours(0), lead="l1"):
        return {"lead_id": lead, "strategy_activity_id": f"s{n}", "strategy_at": at, "objections_faced": objections}

    found = reports.rpt_objections_faced(
        paths(
            spark,
            call(1, '["Logistical","Money"]'),
            call(1, '["Logistical","Money"]', lead="l2"),
            call(2, "[]"),
            call(3, None),
            call(4, '"Money"'),
            call(5, '[" fear ",""]'),
            call(6, '["financial"]'),
            call(7, '["Alien"]', at=hours(24)),
            {"lead_id": "l9", "objections_faced": '["Money"]'},
        ),
        seeds.load_seed(spark, "objection_category_map"),
    ).collect()
    day, next_day = dt.date(2026, 3, 1), dt.date(2026, 3, 2)
    rows = {(r.report_date, r.objection_category): r for r in found}
    assert set(rows) == {(day, "Logistical"), (day, "Money"), (day, "Fear"), (next_day, "Alien")}
    money = rows[day, "Money"]
    # s1 twice and s6; evaluated calls are s1, s2 (empty list), s4 (plain text), s5, s6.
    assert (money.objection_count, money.distinct_strategy_call_count, money.distinct_lead_count) == (3, 2, 2)
    assert money.strategy_calls_evaluated == 5 and money.strategy_call_percentage == 0.4
    assert rows[next_day, "Alien"].strategy_calls_evaluated == 1


def test_inbound_joins_evidence_and_conclusions(spark):
    found = reports.rpt_inbound_setter(
        paths(
            spark,
            # Same date in New York as the meeting, though the UTC date differs.
            {"lead_id": "l1", "funnel_source": "inbound", "initial_at": dt.datetime(2026, 3, 2, 3, 30), "setter_user_id": "user_1", "initial_outcome": "6. No Show"},
            {"lead_id": "l2", "funnel_source": "inbound", "initial_at": hours(0), "setter_user_id": None, "initial_outcome": " "},
            {"lead_id": "l3", "funnel_source": "outbound", "initial_at": hours(0), "setter_user_id": "user_9"},
        ),
        activities(
            spark,
            meeting("m1", "l1", "user_1", "2026-03-01 20:00:00", title="x DATA engineer academy"),
            meeting("m2", "l4", "user_1", "2026-03-01 20:00:00", title="other"),
            meeting("m3", "l2", None, "2026-03-01 20:00:00", note="Data Engineer Academy"),
        ),
        users(spark),
        seeds.load_seed(spark, "funnel_outcome_map"),
    ).collect()
    day = dt.date(2026, 3, 1)
    ann = next(r for r in found if r.setter_user_id == "user_1")
    # A no-show is a conclusion, so the call counts as taken; the lead counts once.
    assert (ann.report_date, ann.setter_name, ann.inbound_booked, ann.inbound_taken, ann.show_rate) == (day, "Ann Doe", 1, 1, 1.0)
    nobody = [r for r in found if r.setter_user_id is None]
    # NULL setters do not meet in the join; their two rows fall in one NULL group after it.
    assert [(r.inbound_booked, r.inbound_taken) for r in nobody] == [(1, 0)]
    assert len(found) == 2


def test_missing_setters_stay_apart_in_the_join(spark):
    evidence = reports.booking_evidence(
        activities(spark, meeting("m1", "l1", None, "2026-03-01 20:00:00", title="Data Engineer Academy"))
    )
    conclusions = reports.triage_conclusions(
        paths(spark, {"lead_id": "l1", "funnel_source": "inbound", "initial_at": hours(0), "initial_outcome": "2. Unqualified"}),
        seeds.load_seed(spark, "funnel_outcome_map"),
    )
    rows = reports.combine_evidence(evidence, conclusions).collect()
    assert sorted((r.has_calendar_booking, r.has_triage_conclusion) for r in rows) == [(0, 1), (1, 0)]


def test_closer_counts_every_path_of_a_shared_sale(spark):
    one = {
        "lead_id": "l1",
        "strategy_activity_id": "s1",
        "strategy_at": hours(0),
        "closer_user_id": "user_1",
        "strategy_outcome": "6. Sale",
        "sale_activity_id": "n1",
        "contract_value": Decimal(100),
    }
    found = reports.rpt_closer(
        paths(spark, one, one, {**one, "strategy_outcome": "8. Cancel- Nurture", "sale_activity_id": None, "contract_value": None}),
        users(spark),
        seeds.load_seed(spark, "funnel_outcome_map"),
    ).collect()
    assert len(found) == 1
    row = found[0]
    assert (row.calls_booked, row.shows, row.sales, row.nurture_cancellations) == (3, 2, 2, 1)
    assert float(row.total_contract_value) == 200.0 and float(row.average_contract_value) == 100.0
    assert row.show_rate == 0.6667 and row.closer_name == "Ann Doe"


def test_outbound_ratios_without_divisor(spark):
    found = reports.rpt_outbound_setter(
        paths(spark, {"lead_id": "l1", "funnel_source": "outbound", "initial_at": hours(0), "setter_user_id": "u", "initial_outcome": "3. Follow Up"}),
        users(spark),
        seeds.load_seed(spark, "funnel_outcome_map"),
    ).first()
    assert (found.total_outbound_calls, found.outbound_set, found.dial_to_set_rate) == (1, 0, 0.0)
    assert found.set_to_show_rate is None and found.average_order_value is None
    assert found.total_contract_value is None


def test_no_selection_keeps_all_names(spark):
    report = spark.createDataFrame([(dt.date(2026, 1, d), n) for d, n in ((1, "a"), (2, None), (3, "b"))], "report_date date, setter_name string")
    assert dashboard.filter_report(report, name_column="setter_name").count() == 3
    assert dashboard.filter_report(report, dt.date(2026, 1, 2), dt.date(2026, 1, 3)).count() == 2
    assert dashboard.filter_report(report, name_column="setter_name", names=["a"]).count() == 1
    assert [r.setter_name for r in dashboard.selector_values(report, "setter_name").collect()] == ["a", "b"]


def test_kpis_of_empty_reports_are_zero(spark):
    seed = seeds.load_seed(spark, "funnel_outcome_map")
    none = paths(spark)
    inbound = reports.rpt_inbound_setter(none, activities(spark), users(spark), seed)
    outbound = reports.rpt_outbound_setter(none, users(spark), seed)
    closer = reports.rpt_closer(none, users(spark), seed)
    row = dashboard.executive_kpis(inbound, outbound, closer).first()
    assert set(row.asDict().values()) == {0}
    assert dashboard.date_bounds(inbound, outbound, closer).first().min_date is None


def test_display_format(spark):
    report = spark.createDataFrame([(0.1234, 1234.5, None)], "show_rate double, total_cash_collected double, sale_rate double")
    row = dashboard.formatted(report).first()
    assert (row.show_rate, row.total_cash_collected, row.sale_rate) == ("12.3%", "$1,234", None)


def test_date_dimension_covers_the_range(spark):
    rows = spark.createDataFrame([(dt.date(2026, 1, 31),), (dt.date(2026, 2, 2),), (None,)], "d date")
    days = [r.date_day for r in gold.dim_date(rows, "d").orderBy("date_day").collect()]
    assert days == [dt.date(2026, 1, 31), dt.date(2026, 2, 1), dt.date(2026, 2, 2)]
    assert gold.dim_date(rows.limit(0), "d").count() == 0
