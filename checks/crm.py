"""CRM records derived from the driver tables, as raw tables and as flat SQL.

``ACTIVITY`` and the other expression tables are plain SQL that Spark and DuckDB both
read. Spark packs them into JSON documents for the engine to take apart again; the
oracle queries use the same columns directly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelry.sources.seeds import packaged_rows

LOADS = [dt.datetime(2026, 5, 16, 7, 30), dt.datetime(2026, 5, 17, 7, 30)]

# Type and field ids of the packaged seeds. The activity names of the seeds.
TYPES = {r["custom_activity_type_name"]: r["custom_activity_type_id"] for r in packaged_rows("custom_activity_type_map")}
TRIAGE, TRIAGE_FOLLOW = TYPES["3) Triage Call"], TYPES["4) Triage Call Follow Up"]
PROSPECT, PROSPECT_FOLLOW = TYPES["1) Prospecting Activity"], TYPES["2) Prospecting Follow Up"]
STRATEGY, STRATEGY_FOLLOW = TYPES["5) Strategy Call"], TYPES["6) Strategy Call Follow Up"]
SALE, SALE_PLAN = TYPES["7) New Sale"], TYPES["8) New Sale [Custom Payment Plan]"]
BACKEND, EXTRA_CASH = TYPES["14) Backend Sale"], TYPES["9) Additional Cash Collected"]
REFUND = TYPES["15) Refund Request Initiated"]


def field_ids(canonical: str) -> list[str]:
    rows = packaged_rows("custom_field_map")
    return [r["custom_field_id"] for r in rows if r["canonical_field_name"] == canonical]


def outcome_labels(canonical: str) -> list[str]:
    rows = packaged_rows("funnel_outcome_map")
    return [r["raw_value"] for r in rows if r["canonical_field_name"] == canonical]


def _pick(number: str, options: list[str | None]) -> str:
    """The option at number % len(options); the options are SQL literals.

    ``@element`` and ``@[ @]`` stand for element access and array literals, which the
    engines spell differently.
    """
    literals = ", ".join(o or "NULL" for o in options)
    return f"@element(@[{literals}@], CAST(({number}) % {len(options)} AS INT) + 1)"


def _labels(number: str, canonical: str, *more: str) -> str:
    return _pick(number, [f"'{v}'" for v in outcome_labels(canonical)] + list(more))


def _when(kind: str, value: str) -> str:
    return f"CASE WHEN event_type = '{kind}' THEN {value} END"


CENTS = "CAST(round(value * 100) AS BIGINT)"
OBJECTIONS = [
    """'["Logistical","Money"]'""",
    "'[]'",
    None,
    """'"Money"'""",
    """'[" fear "]'""",
    """'["Financial","Uncertain About Us","Time"]'""",
    """'["Alien Invasion"]'""",
    """'["No Show",""]'""",
    """'["MONEY"]'""",
]

#: Activity columns from an event row and its version v (0 first delivery, 1 update).
ACTIVITY = {
    "activity_id": "'acti_' || CAST(event_id AS VARCHAR(20))",
    "lead_id": "'lead_' || CAST(user_id AS VARCHAR(20))",
    "activity_type": (
        "CASE WHEN event_type <> 'error' OR event_id % 8 >= 6 THEN 'CustomActivity' "
        "WHEN event_id % 8 = 0 THEN 'Call' WHEN event_id % 8 IN (1, 4) THEN 'SMS' "
        "WHEN event_id % 8 IN (2, 5) THEN 'Meeting' ELSE 'Note' END"
    ),
    "custom_activity_type_id": (
        f"CASE event_type WHEN 'view' THEN CASE WHEN event_id % 5 = 0 THEN '{TRIAGE_FOLLOW}' ELSE '{TRIAGE}' END "
        f"WHEN 'signup' THEN CASE WHEN event_id % 5 = 0 THEN '{PROSPECT_FOLLOW}' ELSE '{PROSPECT}' END "
        f"WHEN 'click' THEN CASE WHEN event_id % 5 = 0 THEN '{STRATEGY_FOLLOW}' ELSE '{STRATEGY}' END "
        f"WHEN 'purchase' THEN CASE event_id % 10 WHEN 0 THEN '{SALE_PLAN}' WHEN 1 THEN '{BACKEND}' "
        f"WHEN 2 THEN '{EXTRA_CASH}' ELSE '{SALE}' END "
        f"ELSE CASE WHEN event_id % 8 = 6 THEN 'actitype_unmapped' WHEN event_id % 16 = 15 THEN '{REFUND}' END END"
    ),
    "activity_at": (
        "CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 3 = 0 "
        "THEN CAST(date_trunc('hour', ts) AS {timestamp}) ELSE ts END"
    ),
    "activity_created_at": "ts",
    "activity_updated_at": (
        "CASE WHEN event_id % 41 = 0 THEN NULL WHEN v = 1 THEN ts + INTERVAL '1' DAY ELSE ts END"
    ),
    "user_id": "CASE WHEN event_id % 29 <> 0 THEN 'user_' || CAST(event_id % 40 AS VARCHAR(20)) END",
    "status": "CASE WHEN event_type = 'error' AND event_id % 8 IN (0, 1, 2, 4, 5) THEN 'completed' END",
    "title": _when(
        "error",
        "CASE event_id % 8 WHEN 5 THEN 'Intro with DATA engineer academy' WHEN 2 THEN 'Weekly sync' END",
    ),
    "note": _when(
        "error",
        "CASE WHEN event_id % 16 = 2 THEN 'Data Engineer Academy call' WHEN event_id % 8 IN (0, 2, 3) THEN 'n/a' END",
    ),
    "sequence_name": _when(
        "error",
        "CASE event_id % 8 WHEN 4 THEN '001-Triage Booked // Setter Confirmation' WHEN 1 THEN 'Nurture' END",
    ),
    "triage_outcome": _when("view", _labels("event_id + v", "triage_outcome", "''", "'11. Mystery'")),
    "prospecting_outcome": _when(
        "signup", _labels("event_id + v", "prospecting_outcome", "''", "'Unknown Outcome'")
    ),
    "strategy_outcome": _when("click", _labels("event_id + v", "strategy_outcome", "''", "NULL")),
    "offer_presented": _when("click", _pick("event_id", ["'Offer A'", "''", None, "'Offer B'"])),
    "objections": _when("click", _pick("event_id", OBJECTIONS)),
    "setter_a": (
        "CASE WHEN event_type IN ('view', 'signup') AND event_id % 6 <> 0 "
        "THEN 'user_' || CAST(event_id % 40 AS VARCHAR(20)) END"
    ),
    "setter_b": (
        "CASE WHEN event_type IN ('view', 'signup') AND event_id % 5 = 0 "
        "THEN 'user_' || CAST(event_id % 7 AS VARCHAR(20)) END"
    ),
    "closer_a": _when(
        "click",
        "CASE WHEN event_id % 31 = 0 THEN 'user_missing' WHEN event_id % 4 <> 0 "
        "THEN 'user_' || CAST(event_id % 200 AS VARCHAR(20)) END",
    ),
    "closer_b": _when(
        "click", "CASE WHEN event_id % 3 = 0 THEN 'user_' || CAST(event_id % 90 AS VARCHAR(20)) END"
    ),
    "contract_text": _when(
        "purchase",
        "CASE event_id % 17 WHEN 0 THEN '' WHEN 1 THEN 'n/a' WHEN 2 THEN '0' WHEN 3 THEN '-5.25' "
        "WHEN 4 THEN '1-2' ELSE 'amount' END",
    ),
    "cash_cents": _when(
        "purchase", f"CASE event_id % 13 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE {CENTS} END"
    ),
    "extra_cents": (
        f"CASE WHEN event_type = 'purchase' AND event_id % 10 = 2 THEN {CENTS} + 100 END"
    ),
    "contract_cents": f"{CENTS} * 10 + v",
    "unmapped_text": "CASE WHEN event_id % 6 = 1 THEN props END",
    "wildcard_text": "CASE WHEN event_id % 6 = 2 THEN 'x' END",
}

#: JSON key of each flat column that becomes a custom field.
CUSTOM_KEYS = {
    "triage_outcome": field_ids("triage_outcome")[0],
    "prospecting_outcome": field_ids("prospecting_outcome")[0],
    "strategy_outcome": field_ids("strategy_outcome")[0],
    "offer_presented": field_ids("offer_presented")[0],
    "setter_a": field_ids("setter_user_id")[0],
    "setter_b": field_ids("setter_user_id")[1],
    "closer_a": field_ids("closer_user_id")[0],
    "closer_b": field_ids("closer_user_id")[1],
    "unmapped_text": "cf_unmapped",
    "wildcard_text": "cfXwild",
}
CONTRACT_FIELD = field_ids("contract_value")[0]
CASH_FIELD = field_ids("cash_collected")[0]
EXTRA_FIELD = field_ids("additional_cash_collected")[0]
OBJECTIONS_FIELD = field_ids("objections_faced")[0]

#: User object text from a customer row and its version v.
USER = {
    "user_id": "'user_' || CAST(c_custkey AS VARCHAR(20))",
    "email": (
        "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' "
        "ELSE 'u' || CAST(c_custkey AS VARCHAR(20)) || '@example.com' END"
    ),
    "first_name": "CASE WHEN c_custkey % 11 <> 0 THEN substring(c_name, 1, 8) END",
    "last_name": "substring(c_name, 10, 9) || CASE WHEN v = 1 THEN ' Jr' ELSE '' END",
    "last_used_timezone": "CASE WHEN c_custkey % 2 = 0 THEN 'America/New_York' ELSE 'UTC' END",
    "date_created": "'2024-01-01 00:00:00'",
    "date_updated": (
        "CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN v = 1 THEN '2024-02-01 12:00:00' "
        "ELSE '2024-01-02 12:00:00' END"
    ),
}
USER_TEXT = (
    "'{''data'': [{' || "
    + " || ', ' || ".join(
        f"coalesce('''{key}'': ''' || {value} || '''', '''{key}_'': None')"
        for key, value in {"id": USER["user_id"], **{k: v for k, v in USER.items() if k != "user_id"}}.items()
    )
    + " || CASE WHEN c_custkey % 50 = 49 THEN ', ''org'': {''a'': 1}' ELSE '' END || '}]}'"
)

#: Lead columns from a customer row and its version v.
LEAD = {
    "lead_id": "'lead_' || CAST(c_custkey AS VARCHAR(20))",
    "lead_name": "CASE WHEN c_custkey % 7 <> 0 THEN c_name END",
    "display_name": "CASE WHEN c_custkey % 14 <> 0 THEN c_name END",
    "status_id": "'stat_' || CAST((c_nationkey + v) % 5 AS VARCHAR(20))",
    "status_label": "CASE WHEN c_custkey % 19 <> 0 THEN c_mktsegment END",
    "lead_created_at": "TIMESTAMP '2024-01-01 00:00:00'",
    "lead_updated_at": (
        "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN v = 1 THEN TIMESTAMP '2024-03-01 00:00:00' "
        "ELSE TIMESTAMP '2024-02-01 00:00:00' END"
    ),
}


def _metadata_text() -> str:
    types = packaged_rows("custom_activity_type_map")
    fields = packaged_rows("custom_field_map")
    a_type = _pick(
        "p_partkey",
        [
            f"'{{''id'': ''{r['custom_activity_type_id']}'', ''name'': ''{r['custom_activity_type_name']}'''"
            for r in types
        ],
    )
    a_field = _pick(
        "p_partkey",
        [
            f"'{{''id'': ''{r['custom_field_id']}'', ''name'': ''{r['custom_field_name']}'', "
            f"''type'': ''{r['custom_field_type']}'''"
            for r in fields
        ],
    )
    return f"'{{''data'': [' || {a_type} || '}}, ' || {a_field} || '}}]}}'"


METADATA_TEXT = _metadata_text()


def _spelled(expression: str, words: dict[str, str]) -> str:
    for word, spelling in words.items():
        expression = expression.replace(word, spelling)
    return expression


def spark_sql(expression: str) -> str:
    return _spelled(
        expression,
        {
            "@element": "element_at",
            "@[": "array(",
            "@]": ")",
            "{timestamp}": "TIMESTAMP_NTZ",
            "AS VARCHAR(20)": "AS STRING",
            "TIMESTAMP '": "TIMESTAMP_NTZ '",
        },
    )


def duckdb_sql(expression: str) -> str:
    words = {"@element": "list_extract", "@[": "[", "@]": "]", "{timestamp}": "TIMESTAMP"}
    return _spelled(expression, words)


def _expr(expression: str) -> Column:
    return F.expr(spark_sql(expression))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Shares a small table among all cores.

    The test tables are single splits. A scan with as many splits as cores, as any large
    one has, stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


# --- raw tables ---------------------------------------------------------------------


def _versions(df: DataFrame, has_update: str) -> DataFrame:
    """One row per delivery: all in the first load, some again in the second."""
    loads = F.when(F.expr(has_update), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", F.explode(loads).alias("v"))


def _lineage(feed: str, row: str) -> list[Column]:
    first, second = LOADS
    name = f"{feed}/load_date="
    return [
        F.concat(F.lit(name), F.when(F.col("v") == 0, "2026-05-16").otherwise("2026-05-17")).alias(
            "source_file_name"
        ),
        (F.col(row) + 1).alias("source_row_number"),
        F.when(F.col("v") == 0, F.lit(first.date())).otherwise(F.lit(second.date())).alias("load_date"),
        F.when(F.col("v") == 0, F.lit(first)).otherwise(F.lit(second)).cast("timestamp_ntz").alias(
            "insert_date"
        ),
        F.lit(second).cast("timestamp_ntz").alias("bronze_loaded_at"),
    ]


def _document(columns: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in columns.items()]))


def activity_document() -> Column:
    """Activity as the CRM delivers it: custom fields are top-level ``custom.*`` keys."""
    e = {name: _expr(x) for name, x in ACTIVITY.items()}

    def stamp(name: str) -> Column:
        return F.coalesce(e[name].cast("string"), F.lit("")) if name == "activity_at" else e[name].cast("string")

    amount = F.concat(
        F.lit("$"), F.format_number(e["contract_cents"].cast("decimal(20,2)") / 100, 2)
    )
    columns = {
        "id": e["activity_id"],
        "lead_id": e["lead_id"],
        "_type": e["activity_type"],
        "custom_activity_type_id": e["custom_activity_type_id"],
        "activity_at": stamp("activity_at"),
        "date_created": stamp("activity_created_at"),
        "date_updated": stamp("activity_updated_at"),
        "user_id": e["user_id"],
        **{k: e[k] for k in ("status", "title", "note", "sequence_name")},
        **{f"custom.{i}": e[name] for name, i in CUSTOM_KEYS.items()},
        f"custom.{CONTRACT_FIELD}": F.when(e["contract_text"] == "amount", amount).otherwise(
            e["contract_text"]
        ),
        f"custom.{CASH_FIELD}": e["cash_cents"].cast("decimal(20,2)") / 100,
        f"custom.{EXTRA_FIELD}": e["extra_cents"].cast("decimal(20,2)") / 100,
        f"custom.{OBJECTIONS_FIELD}": F.parse_json(e["objections"]),
    }
    return _document(columns)


def lead_activities_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrapper rows ``{"data": [...]}``; some hold the same activity twice, some nothing."""
    rows = _versions(spread(read(spark, sf_dir, "events")), "event_id % 10 = 0")
    item = activity_document()
    lost = "v = 0 AND event_id % 97 = 0"
    data = (
        F.when(F.expr(lost), F.lit("[]"))
        .when(F.expr("v = 0 AND event_id % 7 = 0"), F.concat(F.lit("["), item, F.lit(","), item, F.lit("]")))
        .otherwise(F.concat(F.lit("["), item, F.lit("]")))
    )
    raw = F.parse_json(F.concat(F.lit('{"data":'), data, F.lit("}")))
    return rows.select(raw.alias("raw_data"), *_lineage("lead_activites_raw", "event_id"))


def leads_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _versions(read(spark, sf_dir, "customer"), "c_custkey % 3 = 0")
    names = {"lead_id": "id", "lead_name": "name", "lead_created_at": "date_created", "lead_updated_at": "date_updated"}
    columns = {
        names.get(k, k): _expr(x).cast("string") if k.endswith("_at") else _expr(x)
        for k, x in LEAD.items()
    }
    columns["created_by"] = F.lit("user_1")
    raw = F.parse_json(_document(columns))
    return rows.select(raw.alias("raw_data"), *_lineage("leads_raw", "c_custkey"))


def users_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _versions(read(spark, sf_dir, "customer"), "c_custkey % 4 = 0")
    raw = F.parse_json(_document({"JSON_OBJECT": _expr(USER_TEXT)}))
    return rows.select(raw.alias("raw_data"), *_lineage("close_crm_users_raw", "c_custkey"))


def custom_activities_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part").withColumn("v", F.lit(0))
    raw = F.parse_json(_document({"JSON_OBJECT": _expr(METADATA_TEXT)}))
    return rows.select(raw.alias("raw_data"), *_lineage("custom_activites_raw", "p_partkey"))


RAW_TABLES = {
    "leads_raw": leads_raw,
    "lead_activities_raw": lead_activities_raw,
    "custom_activities_raw": custom_activities_raw,
    "close_crm_users_raw": users_raw,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_TABLES.items()}


def daily_loads(spark: SparkSession, sf_dir: str, days: int = 7) -> list[tuple[int, DataFrame]]:
    """The activity feed as so many loads: most rows in one, every fifth in two of them."""
    raw = lead_activities_raw(spark, sf_dir)
    row, later = F.col("source_row_number"), (F.col("load_date") == LOADS[1].date()).cast("int")
    day = (row + 3 * later) % days
    again = F.when(row % 5 == 0, (day + 2) % days)
    return [(d, raw.where((day == d) | (again == d))) for d in range(days)]
