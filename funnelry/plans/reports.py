"""KPI reports by date and person or objection category.

Inbound report dates are New York calendar dates, the other reports use UTC dates.
Ratios divide in double precision or decimal and are NULL where the divisor is zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.functions import values
from funnelry.operators.latest import latest_by
from funnelry.plans.gold import fact_objection
from funnelry.plans.silver import NEWEST, TIES, shredded

INBOUND_ZONE = "America/New_York"
# How a booked triage call shows in meetings and text messages.
BOOKING_TITLE = "%Data Engineer Academy%"
BOOKING_SEQUENCE = "001-Triage Booked // Setter Confirmation"

MONEY = {"contract_value": "total_contract_value", "cash_collected": "total_cash_collected"}
MONEY_TOTALS = list(MONEY.values())


def with_outcome(
    paths: DataFrame, outcome_map: DataFrame, field: str, column: str, flags: dict[str, str]
) -> DataFrame:
    """Adds flags of the outcome map, matched on one field's raw values."""
    known = outcome_map.where(F.col("canonical_field_name") == field).select(
        F.col("raw_value").alias(column), *[F.col(k).alias(v) for k, v in flags.items()]
    )
    return paths.join(known, column, "left")


def with_person(report: DataFrame, users: DataFrame, role: str) -> DataFrame:
    """Adds name and email after aggregation, when the report is small."""
    people = users.select(
        F.col("user_id").alias(f"{role}_user_id"),
        F.col("full_name").alias(f"{role}_name"),
        F.col("email").alias(f"{role}_email"),
    )
    return report.join(people, f"{role}_user_id", "left")


# --- what one row adds to a report ----------------------------------------------------
#
# Every function below gives the grouping columns of a report and, for each row, 0 or 1 for
# everything the report counts. Full reports sum them, increments add and subtract them.


def booking_flags(
    activities: DataFrame, title: str = BOOKING_TITLE, sequence: str = BOOKING_SEQUENCE
) -> list[Column]:
    """``is_calendar`` and ``is_sms``: whether an activity shows a booked call.

    Shredded fields are read from their columns, so documents stay closed.
    """
    named = [shredded(activities, x).ilike(title) for x in ("title", "note")]
    kind, sent = F.col("activity_type"), shredded(activities, "sequence_name")
    return [
        values.flag((kind == "Meeting") & (named[0] | named[1])).alias("is_calendar"),
        values.flag((kind == "SMS") & (sent == sequence)).alias("is_sms"),
    ]


def evidence_date() -> Column:
    return values.local_date("activity_at", INBOUND_ZONE).alias("report_date")


def _setter_rows(
    paths: DataFrame, outcomes: DataFrame, source: str, field: str, date: Column, keep: Sequence[str]
) -> DataFrame:
    """Paths of one source with what their contact and their strategy call came to."""
    rows = paths.where(F.col("funnel_source") == source)
    rows = with_outcome(rows, outcomes, field, "initial_outcome", {"is_set": "_set"})
    rows = with_outcome(
        rows, outcomes, "strategy_outcome", "strategy_outcome", {"is_taken": "_taken"}
    )
    call, sale = F.col("strategy_activity_id").isNotNull(), F.col("sale_activity_id").isNotNull()
    taken = call & values.is_true("_taken")
    return rows.select(
        date.alias("report_date"),
        "setter_user_id",
        "lead_id",
        values.flag(values.not_blank("initial_outcome")).alias("concluded"),
        values.flag(values.is_true("_set")).alias("was_set"),
        values.flag(call).alias("call_booked"),
        values.flag(taken).alias("call_taken"),
        values.flag(taken & values.is_true(F.col("offer_presented") != "")).alias("offered"),
        values.flag(sale).alias("sold"),
        *MONEY,
        *keep,
    )


def inbound_rows(paths: DataFrame, outcomes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    date = values.local_date("initial_at", INBOUND_ZONE)
    return _setter_rows(paths, outcomes, "inbound", "triage_outcome", date, keep)


def outbound_rows(paths: DataFrame, outcomes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    date = values.utc_date("initial_at")
    return _setter_rows(paths, outcomes, "outbound", "prospecting_outcome", date, keep)


def closer_rows(paths: DataFrame, outcomes: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    rows = with_outcome(
        paths.where(F.col("strategy_activity_id").isNotNull()),
        outcomes,
        "strategy_outcome",
        "strategy_outcome",
        {"outcome_category": "_category", "outcome_subcategory": "_kind", "is_taken": "_taken"},
    )

    def kind(name: str) -> Column:
        return values.flag(F.col("_kind") == name)

    return rows.select(
        values.utc_date("strategy_at").alias("report_date"),
        "closer_user_id",
        kind("admin_cancel").alias("admin_cancellations"),
        kind("nurture_cancel").alias("nurture_cancellations"),
        kind("not_interested_cancel").alias("not_interested_cancellations"),
        kind("no_show").alias("no_shows"),
        values.flag(values.is_true("_taken")).alias("shows"),
        values.flag(F.col("_category") == "lost").alias("lost_deals"),
        values.flag(F.col("sale_activity_id").isNotNull()).alias("sales"),
        *MONEY,
        *keep,
    )


CLOSER_COUNTS = [
    "admin_cancellations",
    "nurture_cancellations",
    "not_interested_cancellations",
    "no_shows",
    "shows",
    "lost_deals",
    "sales",
]


def _sums(columns: dict[str, str]) -> list[Column]:
    return [F.sum(column).cast("bigint").alias(name) for column, name in columns.items()]


def _money_sums() -> list[Column]:
    return [F.sum(column).alias(name) for column, name in MONEY.items()]


# --- inbound setters ------------------------------------------------------------------


def booking_evidence(activities: DataFrame) -> DataFrame:
    """Per date, setter and lead: whether a meeting or message shows a booked call.

    Every activity counts, so setters without bookings appear too. The documents are
    reduced to two flags before the rows are shuffled.
    """
    narrow = activities.select(
        "activity_id",
        "lead_id",
        F.col("user_id").alias("setter_user_id"),
        *NEWEST,
        *TIES,
        *booking_flags(activities),
    )
    latest = latest_by(narrow, ["activity_id"], NEWEST + TIES)
    return latest.groupBy(evidence_date(), "setter_user_id", "lead_id").agg(
        F.max("is_calendar").alias("has_calendar_booking"),
        F.max("is_sms").alias("has_sms_booking"),
    )


def triage_conclusions(paths: DataFrame, outcome_map: DataFrame) -> DataFrame:
    rows = inbound_rows(paths, outcome_map)
    return rows.groupBy("report_date", "setter_user_id", "lead_id").agg(
        F.max("concluded").alias("has_triage_conclusion"),
        F.max("was_set").alias("has_triage_set"),
        *_sums(
            {
                "call_booked": "strategy_calls_booked",
                "call_taken": "strategy_calls_taken",
                "offered": "offers_presented",
                "sold": "total_sales",
            }
        ),
        *_money_sums(),
    )


def combine_evidence(evidence: DataFrame, conclusions: DataFrame) -> DataFrame:
    """Full outer join on date, setter and lead; NULL keys stay apart on both sides.

    Both sides come aggregated by the join keys, so the join adds no shuffle.
    """
    keys = ["report_date", "setter_user_id", "lead_id"]
    left, right = evidence.alias("e"), conclusions.alias("c")
    on = [F.col(f"e.{k}") == F.col(f"c.{k}") for k in keys]
    counts = [c for c in evidence.columns + conclusions.columns if c not in keys]
    return left.join(right, on, "full_outer").select(
        *[F.coalesce(f"e.{k}", f"c.{k}").alias(k) for k in keys],
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in counts],
    )


INBOUND_SUMS = [
    "strategy_calls_booked",
    "strategy_calls_taken",
    "offers_presented",
    "total_sales",
    *MONEY_TOTALS,
]


def rpt_inbound_setter(
    paths: DataFrame, activities: DataFrame, users: DataFrame, outcome_map: DataFrame
) -> DataFrame:
    leads = combine_evidence(booking_evidence(activities), triage_conclusions(paths, outcome_map))
    concluded = F.col("has_triage_conclusion") == 1
    booked = (F.col("has_calendar_booking") == 1) | (F.col("has_sms_booking") == 1) | concluded
    rollup = leads.groupBy("report_date", "setter_user_id").agg(
        F.count_if(booked).alias("inbound_booked"),
        F.count_if(concluded).alias("inbound_taken"),
        F.count_if(F.col("has_triage_set") == 1).alias("triage_set"),
        *[F.sum(c).alias(c) for c in INBOUND_SUMS],
    )
    return inbound_report(rollup, users)


def inbound_report(rollup: DataFrame, users: DataFrame) -> DataFrame:
    """Names and ratios of counts by date and setter."""
    return with_person(rollup, users, "setter").select(
        "report_date",
        "setter_user_id",
        "setter_name",
        "setter_email",
        "inbound_booked",
        "inbound_taken",
        "triage_set",
        *INBOUND_SUMS,
        values.ratio("inbound_taken", "inbound_booked", 4).alias("show_rate"),
        values.ratio("triage_set", "inbound_taken", 4).alias("triage_set_rate"),
        values.ratio("offers_presented", "strategy_calls_taken", 4).alias("offer_rate"),
        values.ratio("total_sales", "strategy_calls_taken", 4).alias("sale_rate"),
        values.ratio("total_contract_value", "total_sales", 2).alias("average_order_value"),
    )


# --- outbound setters and closers -----------------------------------------------------

OUTBOUND_COUNTS = {
    "was_set": "outbound_set",
    "call_booked": "strategy_calls_booked",
    "call_taken": "total_closer_show",
    "sold": "total_sales",
}


def rpt_outbound_setter(paths: DataFrame, users: DataFrame, outcome_map: DataFrame) -> DataFrame:
    rows = outbound_rows(paths, outcome_map)
    rollup = rows.groupBy("report_date", "setter_user_id").agg(
        F.count("*").alias("total_outbound_calls"),
        F.countDistinct("lead_id").alias("unique_leads_touched"),
        *_sums(OUTBOUND_COUNTS),
        *_money_sums(),
    )
    return outbound_report(rollup, users)


def outbound_report(rollup: DataFrame, users: DataFrame) -> DataFrame:
    return with_person(rollup, users, "setter").select(
        "report_date",
        "setter_user_id",
        "setter_name",
        "setter_email",
        "total_outbound_calls",
        "unique_leads_touched",
        *OUTBOUND_COUNTS.values(),
        *MONEY_TOTALS,
        values.ratio("outbound_set", "total_outbound_calls", 4).alias("dial_to_set_rate"),
        values.ratio("total_closer_show", "outbound_set", 4).alias("set_to_show_rate"),
        values.ratio("total_sales", "total_closer_show", 4).alias("show_to_sale_rate"),
        values.ratio("total_contract_value", "total_sales", 2).alias("average_order_value"),
    )


def rpt_closer(paths: DataFrame, users: DataFrame, outcome_map: DataFrame) -> DataFrame:
    rows = closer_rows(paths, outcome_map)
    rollup = rows.groupBy("report_date", "closer_user_id").agg(
        F.count("*").alias("calls_booked"),
        *_sums({c: c for c in CLOSER_COUNTS}),
        *_money_sums(),
    )
    return closer_report(rollup, users)


def closer_report(rollup: DataFrame, users: DataFrame) -> DataFrame:
    return with_person(rollup, users, "closer").select(
        "report_date",
        "closer_user_id",
        "closer_name",
        "closer_email",
        "calls_booked",
        *CLOSER_COUNTS,
        *MONEY_TOTALS,
        values.ratio("shows", "calls_booked", 4).alias("show_rate"),
        values.ratio("sales", "shows", 4).alias("show_to_sale_rate"),
        values.ratio("total_contract_value", "sales", 2).alias("average_contract_value"),
    )


# --- objections -----------------------------------------------------------------------


def evaluated_calls(paths: DataFrame) -> DataFrame:
    """Paths whose strategy call has an answer to the objections question."""
    return paths.where(
        F.col("strategy_activity_id").isNotNull() & F.col("objections_faced").isNotNull()
    )


def rpt_objections_faced(paths: DataFrame, category_map: DataFrame) -> DataFrame:
    """Share of a date's evaluated strategy calls that named each category."""
    calls = (
        evaluated_calls(paths)
        .groupBy(values.utc_date("strategy_at").alias("report_date"))
        .agg(F.countDistinct("strategy_activity_id").alias("strategy_calls_evaluated"))
    )
    categories = (
        fact_objection(paths, category_map)
        .groupBy("report_date", "objection_category")
        .agg(
            F.count("*").alias("objection_count"),
            F.countDistinct("strategy_activity_id").alias("distinct_strategy_call_count"),
            F.countDistinct("lead_id").alias("distinct_lead_count"),
        )
    )
    return objections_report(categories, calls)


def objections_report(categories: DataFrame, calls: DataFrame) -> DataFrame:
    share = values.ratio("distinct_strategy_call_count", "strategy_calls_evaluated", 4)
    return categories.join(calls, "report_date", "left").select(
        *categories.columns, "strategy_calls_evaluated", share.alias("strategy_call_percentage")
    )
