"""Column constraints, zero-row checks and reconciliation of reports against the fact."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelry.functions import values


@dataclass(frozen=True)
class Constraints:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


_RAW = ("source_file_name", "source_row_number", "raw_data")

CONSTRAINTS = {
    "stg_bronze__leads_raw": Constraints(not_null=("lead_id", *_RAW)),
    "stg_bronze__lead_activities_raw": Constraints(not_null=("activity_data", *_RAW)),
    "stg_bronze__custom_activities_raw": Constraints(not_null=_RAW),
    "stg_bronze__close_crm_users_raw": Constraints(not_null=_RAW),
    "silver_activities": Constraints(
        not_null=("activity_id", "lead_id", "activity_type", "activity")
    ),
    "silver_custom_activity_events": Constraints(
        not_null=(
            "activity_id",
            "lead_id",
            "custom_activity_type_id",
            "row_number_latest",
            "activity",
        )
    ),
    "dim_user": Constraints(not_null=("user_id",), unique=("user_id",)),
    "dim_lead": Constraints(not_null=("lead_id",), unique=("lead_id",)),
    "fact_lead_funnel": Constraints(
        not_null=("lead_funnel_id", "lead_id", "initial_activity_id"), unique=("lead_funnel_id",)
    ),
    "rpt_inbound_setter": Constraints(not_null=("setter_user_id",)),
    "rpt_outbound_setter": Constraints(not_null=("setter_user_id",)),
    "rpt_closer": Constraints(not_null=("closer_user_id",)),
    "rpt_objections_faced": Constraints(not_null=("objection_category",)),
    "audit_unmapped_custom_activity_types": Constraints(
        not_null=("custom_activity_type_id",), unique=("custom_activity_type_id",)
    ),
    "audit_unmapped_custom_fields": Constraints(
        not_null=("custom_field_id",), unique=("custom_field_id",)
    ),
    "audit_unmapped_funnel_outcomes": Constraints(not_null=("field_name", "raw_value")),
    "custom_activity_type_map": Constraints(
        not_null=("custom_activity_type_id", "custom_activity_type_name", "is_active"),
        unique=("custom_activity_type_id",),
        # The stages an activity type may be mapped to.
        accepted={
            "funnel_stage": (
                "initial_contact",
                "strategy",
                "sale",
                "backend_sale",
                "additional_cash",
                "post_sale",
                "onboarding",
                "deposit",
                "refund",
                "non_funnel",
            )
        },
    ),
    "custom_field_map": Constraints(
        not_null=("custom_field_id", "canonical_field_name", "field_role", "is_active"),
        unique=("custom_field_id",),
    ),
    "funnel_outcome_map": Constraints(
        not_null=(
            "canonical_field_name",
            "field_name",
            "raw_value",
            "normalized_value",
            "outcome_category",
            "outcome_subcategory",
        )
    ),
    "objection_category_map": Constraints(
        not_null=("source_objection_value", "normalized_objection_category", "is_active"),
        unique=("source_objection_value",),
    ),
}


def check_columns(df: DataFrame, table: str, constraints: Constraints) -> DataFrame:
    """Failures per constraint: NULL rows, values held by several rows, foreign values.

    One scan and one shuffle, whatever the number of constraints. Each row gives an entry for
    every unique column and one for the table; entries are counted by column and value,
    combined on the map side, and the table's entry sums up NULL and foreign values.
    """
    flags = {f"not_null:{c}": F.col(c).isNull() for c in constraints.not_null}
    for column, allowed in constraints.accepted.items():
        foreign = F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
        flags[f"accepted_values:{column}"] = foreign
    tests = {name: F.sum(name) for name in flags}
    marked = df.select(*[values.flag(is_bad).alias(n) for n, is_bad in flags.items()], *constraints.unique)
    if constraints.unique:
        entries = [
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in constraints.unique
        ]
        of_table = F.struct(F.lit(None).cast("string").alias("column"), F.lit("").alias("value"))
        rows = marked.select(*flags, F.explode(F.array(*entries, of_table)).alias("entry"))
        whole = F.col("entry.column").isNull()
        marked = (
            rows.where(F.col("entry.value").isNotNull())
            .groupBy("entry.column", "entry.value")
            .agg(F.count("*").alias("rows"), *[F.sum(F.when(whole, F.col(n))).alias(n) for n in flags])
        )
        for c in constraints.unique:
            tests[f"unique:{c}"] = F.count_if((F.col("column") == c) & (F.col("rows") > 1))
    wide = marked.agg(*[F.coalesce(x, F.lit(0)).cast("bigint").alias(n) for n, x in tests.items()])
    found = wide.unpivot([], list(tests), "test", "failures")
    parts = F.split("test", ":")
    return found.select(
        F.lit(table).alias("table_name"),
        parts[1].alias("column_name"),
        parts[0].alias("test_name"),
        "failures",
    )


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Constraint failures of every given table that has constraints."""
    results = None
    for name, df in tables.items():
        if name in CONSTRAINTS:
            checked = check_columns(df, name, CONSTRAINTS[name])
            results = checked if results is None else results.unionByName(checked)
    return results


class CheckFailed(AssertionError):
    """A table that must be empty has rows."""


def require_empty(df: DataFrame, name: str) -> None:
    """Stops a build on the first row; reads no more than it needs to find one."""
    if not df.isEmpty():
        raise CheckFailed(f"{name} must be empty")


def gate_results(gates: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of every table that must be empty, and whether it passes."""
    counted = row_counts(gates, "gate")
    return counted.withColumn("passed", F.col("row_count") == 0)


def row_counts(tables: Mapping[str, DataFrame], label: str = "model_name") -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias(label), F.count("*").alias("row_count"))
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


# --- reconciliation -----------------------------------------------------------------


def _compare(
    report: DataFrame, fact: DataFrame, counted: list[str], money: list[str], head: list[str]
) -> DataFrame:
    """One row: report totals, fact totals and their differences (1 x 1 cross join)."""
    right = fact.select([F.col(c).alias(f"fact_{c}") for c in fact.columns])
    columns = [F.col(c) for c in head]
    for c in counted:
        difference = F.col(c) - F.col(f"fact_{c}")
        columns += [F.col(c), F.col(f"fact_{c}"), difference.alias(f"{c}_diff")]
    for c in money:
        columns += [F.col(c), F.col(f"fact_{c}")]
    return report.crossJoin(right).select(*columns)


_MONEY = ["total_contract_value", "total_cash_collected"]


def _sums(df: DataFrame, rows: str, columns: list[str]) -> DataFrame:
    return df.agg(F.count("*").alias(rows), *[F.sum(c).alias(c) for c in columns])


def _fact_money() -> list:
    return [
        F.sum("contract_value").alias("total_contract_value"),
        F.sum("cash_collected").alias("total_cash_collected"),
    ]


def reconcile_closer(report: DataFrame, paths: DataFrame) -> DataFrame:
    fact = paths.where(F.col("strategy_activity_id").isNotNull()).agg(
        F.count("*").alias("calls_booked"),
        F.count("sale_activity_id").alias("sales"),
        *_fact_money(),
    )
    counted = ["calls_booked", "sales"]
    totals = _sums(report, "closer_count", [*counted, "shows", *_MONEY])
    return _compare(totals, fact, counted, _MONEY, ["closer_count"])


def reconcile_inbound(report: DataFrame, paths: DataFrame) -> DataFrame:
    """Path counts against evidence counts: a booked difference is expected here."""
    fact = paths.where(F.col("funnel_source") == "inbound").agg(
        F.count("*").alias("inbound_booked"),
        F.count("strategy_activity_id").alias("strategy_calls_booked"),
        F.count("sale_activity_id").alias("total_sales"),
        *_fact_money(),
    )
    counted = ["inbound_booked", "strategy_calls_booked", "total_sales"]
    return _compare(
        _sums(report, "setter_count", counted + _MONEY), fact, counted, _MONEY, ["setter_count"]
    )


def reconcile_outbound(report: DataFrame, paths: DataFrame) -> DataFrame:
    fact = paths.where(F.col("funnel_source") == "outbound").agg(
        F.count("*").alias("total_outbound_calls"),
        F.countDistinct("lead_id").alias("distinct_leads_touched"),
        F.count("strategy_activity_id").alias("strategy_calls_booked"),
        F.count("sale_activity_id").alias("total_sales"),
        *_fact_money(),
    )
    counted = ["total_outbound_calls", "strategy_calls_booked", "total_sales"]
    totals = _sums(report, "setter_count", [*counted, "unique_leads_touched", *_MONEY])
    totals = totals.withColumnRenamed("unique_leads_touched", "summed_unique_leads_touched")
    head = ["setter_count", "summed_unique_leads_touched", "fact_distinct_leads_touched"]
    return _compare(totals, fact, counted, _MONEY, head)


def reconcile_objections(report: DataFrame, paths: DataFrame) -> DataFrame:
    """Report mentions against mentions flattened again from the paths.

    The call difference takes the report's largest per-date count, as the check is
    defined; ``evaluated_per_date_diff`` compares sums over dates, which must be 0.
    """
    calls = paths.where(
        F.col("strategy_activity_id").isNotNull() & F.col("objections_faced").isNotNull()
    )
    is_list = F.startswith(F.ltrim("objections_faced"), F.lit("["))
    labels = F.when(is_list, F.from_json("objections_faced", "array<string>"))
    flat = (
        calls.select("strategy_activity_id", F.explode(labels).alias("label"))
        .where(F.trim("label") != "")
        .agg(
            F.count("*").alias("flattened_objection_count"),
            F.countDistinct("strategy_activity_id").alias(
                "distinct_strategy_calls_with_objections"
            ),
        )
    )
    by_date = report.groupBy("report_date").agg(
        F.sum("objection_count").alias("objection_count"),
        F.max("strategy_calls_evaluated").alias("evaluated"),
    )
    totals = by_date.agg(
        F.sum("objection_count").alias("report_objection_count"),
        F.max("evaluated").alias("strategy_calls_evaluated"),
        F.sum("evaluated").alias("evaluated_per_date"),
    )
    dates = report.select("report_date").distinct()
    fact_per_date = (
        calls.withColumn("report_date", F.to_date("strategy_at"))
        .join(dates, "report_date", "left_semi")
        .groupBy("report_date")
        .agg(F.countDistinct("strategy_activity_id").alias("n"))
        .agg(F.sum("n").alias("fact_evaluated"))
    )
    mentions = F.col("report_objection_count") - F.col("flattened_objection_count")
    evaluated = F.col("strategy_calls_evaluated") - F.col("distinct_strategy_calls_with_objections")
    per_date = F.col("evaluated_per_date") - F.col("fact_evaluated")
    return (
        flat.crossJoin(totals)
        .crossJoin(fact_per_date)
        .select(
            "flattened_objection_count",
            "distinct_strategy_calls_with_objections",
            "report_objection_count",
            "strategy_calls_evaluated",
            mentions.alias("objection_count_diff"),
            evaluated.alias("strategy_calls_evaluated_diff"),
            per_date.alias("evaluated_per_date_diff"),
        )
    )


# --- summaries read by people -------------------------------------------------------


def duplicate_keys(df: DataFrame, keys: list[str], rows: int = 50) -> DataFrame:
    """The most repeated keys, with a full ordering so that the cut is repeatable."""
    copies = df.groupBy(*keys).agg(F.count("*").alias("duplicate_count"))
    order = [F.desc("duplicate_count"), *[F.col(k).asc_nulls_last() for k in keys]]
    return copies.where("duplicate_count > 1").orderBy(*order).limit(rows)


def lead_profile(leads: DataFrame) -> DataFrame:
    unnamed = F.col("lead_name").isNull() & F.col("display_name").isNull()
    return leads.agg(
        F.count("*").alias("dim_lead_row_count"),
        F.countDistinct("lead_id").alias("distinct_lead_count"),
        (F.count("*") - F.countDistinct("lead_id")).alias("duplicate_lead_id_count"),
        F.count_if(unnamed).alias("missing_name_count"),
        F.count_if(F.col("status_label").isNull()).alias("missing_status_label_count"),
        F.min("lead_created_at").alias("min_lead_created_at"),
        F.max("lead_created_at").alias("max_lead_created_at"),
        F.min("lead_updated_at").alias("min_lead_updated_at"),
        F.max("lead_updated_at").alias("max_lead_updated_at"),
    )


def funnel_summary(paths: DataFrame) -> DataFrame:
    return paths.groupBy("funnel_source", "path_category").agg(
        F.count("*").alias("path_count"),
        F.countDistinct("lead_id").alias("lead_count"),
        F.countDistinct("initial_activity_id").alias("initial_event_count"),
        F.countDistinct("strategy_activity_id").alias("strategy_event_count"),
        F.countDistinct("sale_activity_id").alias("sale_event_count"),
        *_fact_money(),
        (F.count("*") - F.countDistinct("lead_funnel_id")).alias("duplicate_funnel_id_count"),
    )


def unpivot_roles(
    rows: DataFrame, roles: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per role assignment that names a user, from a single scan."""
    pairs = F.array(
        *[
            F.struct(F.lit(role).alias("role_name"), F.col(column).alias("user_id"))
            for role, column in roles.items()
        ]
    )
    long = rows.select(*keep, F.inline(pairs))
    return long.where(F.col("user_id").like("user_%"))


def role_coverage(paths: DataFrame, users: DataFrame) -> DataFrame:
    """Whether setters and closers of the fact exist as users, below a user summary.

    Assignments are counted per role and user before the join, so a user holding most
    rows is one row there.
    """
    assignments = (
        unpivot_roles(paths, {"setter": "setter_user_id", "closer": "closer_user_id"})
        .groupBy("role_name", "user_id")
        .agg(F.count("*").alias("n"))
    )
    known = users.select("user_id", F.lit(True).alias("is_known"))
    coverage = (
        assignments.join(known, "user_id", "left")
        .groupBy("role_name")
        .agg(
            F.sum("n").alias("populated_user_id_count"),
            F.count("*").alias("distinct_user_id_count"),
            F.sum(F.when(F.col("is_known").isNull(), F.col("n")).otherwise(0)).alias(
                "unmatched_user_id_count"
            ),
        )
        .withColumn("result_type", F.lit("fact_lead_funnel_role_coverage"))
    )
    summary = users.agg(
        F.lit("dim_user_summary").alias("result_type"),
        F.count("*").alias("populated_user_id_count"),
        F.countDistinct("user_id").alias("distinct_user_id_count"),
        F.lit(0).cast("bigint").alias("unmatched_user_id_count"),
    )
    columns = [
        "result_type",
        "role_name",
        "populated_user_id_count",
        "distinct_user_id_count",
        "unmatched_user_id_count",
    ]
    return summary.unionByName(coverage, allowMissingColumns=True).select(*columns)
