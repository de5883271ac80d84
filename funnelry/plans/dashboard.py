"""Figures behind the dashboard, computed over the report tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.functions import values


def date_bounds(*reports: DataFrame) -> DataFrame:
    """First and last report date over all reports."""
    dates = None
    for report in reports:
        bounds = report.agg(F.min("report_date").alias("lo"), F.max("report_date").alias("hi"))
        dates = bounds if dates is None else dates.unionByName(bounds)
    return dates.agg(F.min("lo").alias("min_date"), F.max("hi").alias("max_date"))


def filter_report(
    report: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    name_column: str | None = None,
    names: Sequence[str] = (),
) -> DataFrame:
    """Rows in a date range and of the chosen names; no range or no names keeps all."""
    if start is not None and end is not None:
        report = report.where(F.col("report_date").between(F.lit(start), F.lit(end)))
    if name_column and names:
        report = report.where(F.col(name_column).isin(list(names)))
    return report


def selector_values(report: DataFrame, column: str) -> DataFrame:
    return report.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).alias(column)


def executive_kpis(inbound: DataFrame, outbound: DataFrame, closer: DataFrame) -> DataFrame:
    """Headline totals and rates; rates divide totals and are 0 without a divisor."""
    money = ["total_sales", "total_contract_value", "total_cash_collected"]
    left = inbound.agg(*map(_total, ["inbound_booked", "inbound_taken", "triage_set", *money]))
    right = outbound.agg(
        *map(_total, ["total_outbound_calls", "outbound_set", "total_closer_show"]),
        *[_total(m).alias(f"out_{m}") for m in money],
    )
    calls = closer.agg(*map(_total, ["calls_booked", "shows", "no_shows", "sales"]))
    wide = left.crossJoin(right).crossJoin(calls)  # one row each
    totals = {m: F.col(m) + F.col(f"out_{m}") for m in money}

    def rate(part: str, whole: str) -> Column:
        return values.ratio_or_zero(F.col(part), F.col(whole))

    return wide.select(
        *[total.alias(m) for m, total in totals.items()],
        values.ratio_or_zero(totals["total_cash_collected"], totals["total_contract_value"]).alias(
            "cash_collection_rate"
        ),
        "inbound_booked",
        "inbound_taken",
        "triage_set",
        "total_outbound_calls",
        "outbound_set",
        "total_closer_show",
        "calls_booked",
        "shows",
        "no_shows",
        "sales",
        rate("inbound_taken", "inbound_booked").alias("inbound_show_rate"),
        rate("triage_set", "inbound_taken").alias("inbound_triage_set_rate"),
        rate("outbound_set", "total_outbound_calls").alias("outbound_dial_to_set_rate"),
        rate("total_closer_show", "outbound_set").alias("outbound_set_to_show_rate"),
        rate("out_total_sales", "total_closer_show").alias("outbound_show_to_sale_rate"),
        rate("shows", "calls_booked").alias("closer_show_rate"),
        rate("sales", "shows").alias("closer_close_rate"),
    )


def top_objections(objections: DataFrame, rows: int = 10) -> DataFrame:
    """Largest date and category rows; dates are not merged."""
    return objections.orderBy(
        F.desc("objection_count"), F.desc_nulls_last("report_date"), F.asc("objection_category")
    ).limit(rows)


def top_objection(objections: DataFrame) -> DataFrame:
    """The category with most mentions over all dates."""
    totals = objections.groupBy("objection_category").agg(
        F.sum("objection_count").alias("objection_count")
    )
    return totals.orderBy(F.desc("objection_count"), F.asc("objection_category")).limit(1)


def objection_totals(objections: DataFrame) -> DataFrame:
    return objections.agg(
        _total("objection_count"),
        _total("distinct_strategy_call_count"),
        _total("distinct_lead_count"),
    )


# --- tiles --------------------------------------------------------------------------


def tile_scorecard(inbound: DataFrame) -> DataFrame:
    return inbound.agg(
        F.sum("inbound_booked").alias("inbound_booked"),
        F.sum("triage_set").alias("inbound_strategy_calls_set"),
        F.sum("total_sales").alias("inbound_sales"),
        F.sum("total_cash_collected").alias("inbound_cash_collected"),
    )


def _label(role: str) -> Column:
    return F.coalesce(f"{role}_name", f"{role}_user_id")


def tile_inbound(inbound: DataFrame) -> DataFrame:
    return inbound.select(
        _label("setter").alias("setter"),
        "inbound_booked",
        "inbound_taken",
        "triage_set",
        "strategy_calls_taken",
        "total_sales",
        "sale_rate",
        "total_cash_collected",
    ).orderBy(F.desc("inbound_booked"))


def tile_outbound(outbound: DataFrame) -> DataFrame:
    return outbound.select(
        _label("setter").alias("setter"),
        "total_outbound_calls",
        "unique_leads_touched",
        "outbound_set",
        "total_closer_show",
        "total_sales",
        "dial_to_set_rate",
        "show_to_sale_rate",
    ).orderBy(F.desc("total_outbound_calls"))


def tile_closer(closer: DataFrame) -> DataFrame:
    return closer.select(
        _label("closer").alias("closer"),
        "calls_booked",
        "shows",
        "no_shows",
        "lost_deals",
        "sales",
        "show_rate",
        "show_to_sale_rate",
        "total_cash_collected",
    ).orderBy(F.desc("calls_booked"))


def tile_objections(objections: DataFrame) -> DataFrame:
    return objections.select(
        "objection_category",
        "objection_count",
        "distinct_strategy_call_count",
        "strategy_call_percentage",
    ).orderBy(F.desc("objection_count"))


def tile_funnel(paths: DataFrame) -> DataFrame:
    return paths.groupBy("funnel_source", "path_category").agg(
        F.count("*").alias("path_count"),
        F.countDistinct("lead_id").alias("lead_count"),
        F.sum("contract_value").alias("total_contract_value"),
        F.sum("cash_collected").alias("total_cash_collected"),
    )


# --- presentation -------------------------------------------------------------------

# Report columns shown as percentages and as amounts.
RATES = {
    "show_rate",
    "triage_set_rate",
    "offer_rate",
    "sale_rate",
    "dial_to_set_rate",
    "set_to_show_rate",
    "show_to_sale_rate",
    "strategy_call_percentage",
}
AMOUNTS = {
    "total_contract_value",
    "total_cash_collected",
    "average_order_value",
    "average_contract_value",
}


def formatted(report: DataFrame) -> DataFrame:
    """Rates as ``12.3%`` and amounts as ``$1,234``, for display."""
    shown = {}
    for column in report.columns:
        if column in RATES:
            percent = F.format_number(F.col(column).cast("decimal(20,6)") * 100, 1)
            shown[column] = F.concat(percent, F.lit("%"))
        elif column in AMOUNTS:
            shown[column] = F.concat(F.lit("$"), F.format_number(F.col(column), 0))
    return report.withColumns(shown) if shown else report
