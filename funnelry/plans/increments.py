"""The funnel kept up to date load by load, instead of rebuilt.

A load of activities is merged into the stored events; the funnel paths of the leads it
touches are matched anew, and the difference between a lead's old and new paths is added to
the reports. Reports are stored as counts, so they take differences: what is not a sum is kept
as counters per member (leads of a setter and day, calls of an objection) and only says when a
member appears or goes. Work is in proportion to the touched buckets, not to the history.

All tables of a load become visible in one commit. Loads may come in any order and more than
once; after the same loads the tables are those of a full build.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.functions import values
from funnelry.operators.counters import (
    SIGN,
    add_counts,
    apply_counts,
    difference,
    merge_latest,
    moved_latest,
)
from funnelry.plans import bronze, gold, reports, silver
from funnelry.plans.gold import UNIT, unit_of
from funnelry.plans.silver import NEWEST, TIES
from funnelry.sources.tables import stored
from funnelry.sources.versions import Change, Store

ACTIVITIES, USERS, REFERENCE = "lead_activities_raw", "close_crm_users_raw", "reference"
#: What the reports read of a path; paths that differ in nothing else move none of them.
REPORTED = [
    "lead_id",
    "funnel_source",
    "initial_at",
    "setter_user_id",
    "initial_outcome",
    "strategy_activity_id",
    "strategy_at",
    "closer_user_id",
    "strategy_outcome",
    "offer_presented",
    "objections_faced",
    "sale_activity_id",
    *reports.MONEY,
]
#: Counts by day and person, or day and objection, are small and rewritten as a whole.
REPORT_BUCKETS = 1
#: Sums of money are kept with as many digits as a full build gives them.
MONEY = "decimal(38,2)"


class ReferenceChanged(RuntimeError):
    """The mapping tables are not those of the stored loads; a full build is needed."""


def _reference_hash(seeds: Mapping[str, DataFrame]) -> int:
    """One number for the content of all mapping tables, whatever the order of their rows."""
    parts = None
    for name in sorted(seeds):
        rows = seeds[name].select(F.xxhash64(F.lit(name), *seeds[name].columns).alias("h"))
        parts = rows if parts is None else parts.unionByName(rows)
    found = parts.agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("h")).first()[0]
    return int(found or 0)


def _load_rows(raw: DataFrame, seeds: Mapping[str, DataFrame]) -> DataFrame:
    """A load's activities with their business fields and booking flags, documents read once."""
    activities = silver.silver_activities(bronze.stage_lead_activities(raw))
    fields = gold.activity_fields(activities, seeds["custom_field_map"])
    rows = fields.select("*", *reports.booking_flags(fields)).drop(*silver.SHREDDED)
    return stored(rows, "load")


# --- paths ----------------------------------------------------------------------------


def _merge_paths(
    change: Change, load: DataFrame, seeds: Mapping[str, DataFrame], buckets: int
) -> DataFrame:
    """Merges events, matches the touched leads anew; paths that went (-1) or came (1).

    Paths have the columns that reports read, and count how many of them moved.
    """
    events = load.where(F.col("activity_type") == "CustomActivity").drop(
        "activity_type", "is_calendar", "is_sms"
    )
    events = events.withColumn(UNIT, unit_of("lead_id", "activity_id"))
    change.create("events", events.schema, [UNIT], buckets)
    merged, touched = merge_latest(
        change, "events", events, ["lead_id", "activity_id"], NEWEST + TIES
    )
    # Stored, as its size tells whether it can be broadcast: the history then stays in place.
    units = stored(events.select(UNIT).distinct(), "units")
    mine = merged.join(units, UNIT, "left_semi")
    typed = gold.typed_events(mine, seeds["custom_activity_type_map"], gold.FUNNEL_STAGES)
    # Read again for key counts, of which its few columns are less work than storing it all.
    paths = gold.funnel_paths(typed)
    paths = paths.withColumn(UNIT, unit_of("lead_id", "initial_activity_id"))

    change.create("fact_lead_funnel", paths.schema, [UNIT], buckets)
    before = change.read("fact_lead_funnel", touched)
    others = before.join(units, UNIT, "left_anti")
    change.replace("fact_lead_funnel", others.unionByName(paths), touched)
    after = change.read("fact_lead_funnel", touched)

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        rows = rows.join(units, UNIT, "left_semi")
        return rows.select(*REPORTED, F.lit(sign).alias(SIGN))

    both = signed(after, 1).unionByName(signed(before, -1))
    moved = both.groupBy(*REPORTED).agg(F.sum(SIGN).cast("bigint").alias(SIGN))
    return stored(moved.where(F.col(SIGN) != 0), "moved")


def _merge_evidence(change: Change, load: DataFrame, buckets: int) -> DataFrame:
    """Merges the latest version of every activity; booking evidence that went or came."""
    heads = load.select(
        unit_of("activity_id", "activity_id").alias(UNIT),
        "activity_id",
        "lead_id",
        F.col("user_id").alias("setter_user_id"),
        *NEWEST,
        *TIES,
        "is_calendar",
        "is_sms",
    )
    change.create("activity_heads", heads.schema, [UNIT], buckets)
    moved = moved_latest(change, "activity_heads", heads, ["activity_id"], NEWEST + TIES)
    sign = F.col(SIGN)
    return moved.select(
        reports.evidence_date(),
        "setter_user_id",
        "lead_id",
        sign.alias("evidence"),
        (sign * F.col("is_calendar")).alias("calendar"),
        (sign * F.col("is_sms")).alias("sms"),
    )


# --- reports --------------------------------------------------------------------------

#: Counts of a setter's lead on a day: booking evidence, then what its paths came to.
_EVIDENCE = ["evidence", "calendar", "sms"]
_CONTACT = ["concluded", "was_set", "call_booked", "call_taken", "offered", "sold"]


def _signed(rows: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Rows of a report times their sign; amounts with how many there are, as NULL is none."""
    sign = F.col(SIGN)
    money = []
    for m in reports.MONEY:
        amount = F.coalesce(F.col(m), F.lit(0).cast("decimal(18,2)"))
        money.append((sign * amount).cast(MONEY).alias(m))
        money.append(F.when(F.col(m).isNotNull(), sign).otherwise(0).alias(f"{m}_rows"))
    return rows.select(
        *keys, sign.alias("paths"), *[(sign * F.col(c)).alias(c) for c in counts], *money
    )


def _counters(change: Change, name: str, sample: DataFrame, keys: list[str], buckets: int) -> None:
    """An empty table of counts of these columns, if there is none: counts as BIGINT."""
    schema = sample.select(
        *keys,
        *[
            F.col(c).cast(MONEY if c in reports.MONEY else "bigint")
            for c in sample.columns
            if c not in keys
        ],
    ).schema
    change.create(name, schema, keys, buckets)


_PERSON_MONEY = [x for m in reports.MONEY for x in (m, f"{m}_rows")]


def _inbound(
    change: Change, moved: DataFrame, evidence: DataFrame, outcomes: DataFrame, buckets: int
) -> None:
    lead, setter = ["report_date", "setter_user_id", "lead_id"], ["report_date", "setter_user_id"]
    contacts = _signed(reports.inbound_rows(moved, outcomes, [SIGN]), lead, _CONTACT)
    changes = evidence.unionByName(contacts, allowMissingColumns=True)
    changes = changes.select(
        *lead, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in changes.columns if c not in lead]
    )
    changes = changes.withColumn("n", F.col("evidence") + F.col("paths"))
    _counters(change, "inbound_leads", changes, lead, buckets)
    touched = apply_counts(change, "inbound_leads", changes)

    def any_of(*columns: str) -> Column:
        return values.flag(sum((F.col(c) for c in columns), F.lit(0)) > 0)

    # Evidence and conclusions without date, setter or lead are not brought together.
    apart = F.greatest(*[values.flag(F.col(k).isNull()) for k in lead]) == 1

    def rows(left: Column, right: Column, both: Column) -> Column:
        return F.when(apart, left + right).otherwise(both)

    counts = {
        "n": rows(any_of("evidence"), any_of("paths"), any_of("evidence", "paths")),
        "inbound_booked": rows(
            any_of("calendar", "sms"), any_of("concluded"), any_of("calendar", "sms", "concluded")
        ),
        "inbound_taken": any_of("concluded"),
        "triage_set": any_of("was_set"),
        **{c: F.col(c) for c in ["call_booked", "call_taken", "offered", "sold", *reports.MONEY]},
    }
    delta = difference(touched, setter, counts)
    _counters(change, "inbound_setters", delta, setter, REPORT_BUCKETS)
    add_counts(change, "inbound_setters", delta)


def _outbound(change: Change, moved: DataFrame, outcomes: DataFrame, buckets: int) -> None:
    lead, setter = ["report_date", "setter_user_id", "lead_id"], ["report_date", "setter_user_id"]
    names = list(reports.OUTBOUND_COUNTS)
    changes = _signed(reports.outbound_rows(moved, outcomes, [SIGN]), lead, names)
    _counters(change, "outbound_leads", changes, lead, buckets)
    touched = apply_counts(change, "outbound_leads", changes, rows="paths")
    is_lead = F.col("lead_id").isNotNull() & (F.col("paths") > 0)
    counts = {
        "unique_leads_touched": values.flag(is_lead),
        **{c: F.col(c) for c in ["paths", *names, *_PERSON_MONEY]},
    }
    delta = difference(touched, setter, counts)
    _counters(change, "outbound_setters", delta, setter, REPORT_BUCKETS)
    add_counts(change, "outbound_setters", delta, rows="paths")


def _closers(change: Change, moved: DataFrame, outcomes: DataFrame) -> None:
    closer = ["report_date", "closer_user_id"]
    rows = reports.closer_rows(moved, outcomes, [SIGN])
    changes = _signed(rows, closer, reports.CLOSER_COUNTS)
    _counters(change, "closers", changes, closer, REPORT_BUCKETS)
    add_counts(change, "closers", changes, rows="paths")


def _objections(change: Change, moved: DataFrame, categories: DataFrame, buckets: int) -> None:
    """Members of a date and category; a NULL category stands for all evaluated calls."""
    label, day = F.col("objection_category"), values.utc_date("strategy_at").alias("report_date")
    paths = moved.withColumn("lead_funnel_id", F.lit(None).cast("string"))
    named = gold.fact_objection(paths, categories, [SIGN]).select(
        "report_date",
        label,
        F.explode(
            F.array(
                F.struct(F.lit("call").alias("kind"), F.col("strategy_activity_id").alias("member")),
                F.struct(F.lit("lead").alias("kind"), F.col("lead_id").alias("member")),
            )
        ).alias("x"),
        SIGN,
    )
    evaluated = reports.evaluated_calls(moved).select(
        day,
        F.lit(None).cast("string").alias("objection_category"),
        F.lit("evaluated").alias("kind"),
        F.col("strategy_activity_id").alias("member"),
        F.col(SIGN).alias("n"),
    )
    changes = evaluated.unionByName(
        named.select("report_date", label, "x.kind", "x.member", F.col(SIGN).alias("n"))
    )
    member, group = ["report_date", "objection_category", "kind", "member"], ["report_date", "objection_category"]
    _counters(change, "objection_members", changes, member, buckets)
    touched = apply_counts(change, "objection_members", changes)
    there = (F.col("n") > 0) & F.col("member").isNotNull()

    def members(kind: str) -> Column:
        return values.flag(there & (F.col("kind") == kind))

    counts = {
        "n": F.when(F.col("kind") != "lead", F.col("n")).otherwise(0),
        "calls": members("call"),
        "leads": members("lead"),
        "evaluated": members("evaluated"),
    }
    delta = difference(touched, group, counts)
    _counters(change, "objection_categories", delta, group, REPORT_BUCKETS)
    add_counts(change, "objection_categories", delta)


# --- loads ----------------------------------------------------------------------------


def apply_activities(
    store: Store,
    raw: DataFrame,
    batch: int,
    seeds: Mapping[str, DataFrame],
    buckets: int = 256,
    source: str = ACTIVITIES,
) -> bool:
    """Takes a load of raw activities into the store; False if the batch is in already.

    ``batch`` numbers a source's loads in the order of their arrival, which need not be that
    of their dates. ``buckets`` is fixed by the first load. Other mapping tables than those
    of earlier loads raise :class:`ReferenceChanged`, as stored fields would not fit them.
    """
    change = store.begin()
    if change.base.applied.get(source, -1) >= batch:
        return False
    reference = _reference_hash(seeds)
    if change.base.applied.get(REFERENCE, reference) != reference:
        raise ReferenceChanged("mapping tables differ from those of the stored loads")
    outcomes = seeds["funnel_outcome_map"]
    load = _load_rows(raw, seeds)
    # The parts below write tables of their own; small loads are bound by jobs, not by rows.
    with ThreadPoolExecutor(4) as pool:
        evidence = pool.submit(_merge_evidence, change, load, buckets)
        moved = _merge_paths(change, load, seeds, buckets)
        parts = [
            pool.submit(_outbound, change, moved, outcomes, buckets),
            pool.submit(_closers, change, moved, outcomes),
            pool.submit(_objections, change, moved, seeds["objection_category_map"], buckets),
        ]
        _inbound(change, moved, evidence.result(), outcomes, buckets)
        for part in parts:
            part.result()
    change.commit({source: batch, REFERENCE: reference})
    return True


def apply_users(
    store: Store, raw: DataFrame, batch: int, buckets: int = 16, source: str = USERS
) -> bool:
    """Takes a load of raw users into the stored dimension; False if it is in already."""
    change = store.begin()
    if change.base.applied.get(source, -1) >= batch:
        return False
    users = gold.parse_users(bronze.stage_users(raw)).where(F.col("user_id").isNotNull())
    users = stored(users, "users")
    change.create("dim_user", users.schema, ["user_id"], buckets)
    merge_latest(change, "dim_user", users, ["user_id"], gold.NEWEST_USER)
    change.commit({source: batch})
    return True


def read_users(store: Store) -> DataFrame:
    """The stored dimension, empty before the first load."""
    if "dim_user" not in store.manifest().tables:
        schema = "user_id string, full_name string, email string"
        return store.spark.createDataFrame([], schema)
    return gold.named_users(store.read("dim_user"))


def _renamed(rows: DataFrame, keys: list[str], names: Mapping[str, str]) -> DataFrame:
    """Counts under their names in the report; amounts are NULL where there are none."""
    columns = []
    for column, name in names.items():
        value = F.col(column)
        if f"{column}_rows" in rows.columns:
            value = F.when(F.col(f"{column}_rows") > 0, value.cast("decimal(28,2)"))
        columns.append(value.alias(name))
    return rows.select(*keys, *columns)


def read_report(store: Store, name: str) -> DataFrame:
    """One of the four reports, as a full build gives it, from the stored counts."""
    setter = ["report_date", "setter_user_id"]
    if name == "rpt_inbound_setter":
        same = {c: c for c in ("inbound_booked", "inbound_taken", "triage_set")}
        sums = ["call_booked", "call_taken", "offered", "sold", *reports.MONEY]
        names = same | dict(zip(sums, reports.INBOUND_SUMS, strict=True))
        rollup = _renamed(store.read("inbound_setters"), setter, names)
        return reports.inbound_report(rollup, read_users(store))
    if name == "rpt_outbound_setter":
        names = {
            "paths": "total_outbound_calls",
            "unique_leads_touched": "unique_leads_touched",
            **reports.OUTBOUND_COUNTS,
            **reports.MONEY,
        }
        rollup = _renamed(store.read("outbound_setters"), setter, names)
        return reports.outbound_report(rollup, read_users(store))
    if name == "rpt_closer":
        names = {"paths": "calls_booked", **{c: c for c in reports.CLOSER_COUNTS}, **reports.MONEY}
        rollup = _renamed(store.read("closers"), ["report_date", "closer_user_id"], names)
        return reports.closer_report(rollup, read_users(store))
    if name == "rpt_objections_faced":
        rows = store.read("objection_categories")
        names = {
            "n": "objection_count",
            "calls": "distinct_strategy_call_count",
            "leads": "distinct_lead_count",
        }
        named = F.col("objection_category").isNotNull()
        categories = _renamed(rows.where(named), ["report_date", "objection_category"], names)
        calls = _renamed(rows.where(~named), ["report_date"], {"evaluated": "strategy_calls_evaluated"})
        return reports.objections_report(categories, calls)
    raise ValueError(f"unknown report {name!r}")


REPORTS = ["rpt_inbound_setter", "rpt_outbound_setter", "rpt_closer", "rpt_objections_faced"]
