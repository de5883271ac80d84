"""Registered queries: each runs library code over the driver tables.

``QUERIES`` maps a name to a function of (session, table folder); ``ORACLE`` maps it to
the SQL that must give the same rows. Money is compared as DOUBLE and dates as text.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import crm
from checks.oracle import CTES, NY, average, money, ratio, sql
from funnelry.functions import documents, repair, values
from funnelry.operators import changes, fields, snapshots
from funnelry.operators.latest import RANK, latest_by
from funnelry.plans import (
    audit,
    bronze,
    build,
    dashboard,
    gold,
    increments,
    profile,
    quality,
    reports,
    silver,
)
from funnelry.sources import landing, seeds
from funnelry.sources.tables import shared_folder, stored
from funnelry.sources.versions import Store
from funnelry.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
#: The same before the blocks they name are put in front.
RAW_ORACLE: dict[str, str] = {}
MODELS: dict[str, Callable[[Crm], DataFrame]] = {}

LOAD_TS = crm.LOADS[1]
ROLE_FIELDS = {
    "setter": crm.field_ids("setter_user_id")[0],
    "closer": crm.field_ids("closer_user_id")[0],
}


class Crm:
    """The layers a query needs, built from the driver tables on first use.

    ``landed`` gives raw tables that are stored already, by name.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, landed: dict[str, DataFrame] | None = None
    ):
        self.spark, self.sf_dir = spark, sf_dir
        self.landed = landed or {}

    def raw(self, name: str) -> DataFrame:
        found = self.landed.get(name)
        return crm.RAW_TABLES[name](self.spark, self.sf_dir) if found is None else found

    def table(self, name: str) -> DataFrame:
        return crm.read(self.spark, self.sf_dir, name)

    @cached_property
    def seeds(self) -> dict[str, DataFrame]:
        return seeds.load_seeds(self.spark)

    @property
    def types(self) -> DataFrame:
        return self.seeds["custom_activity_type_map"]

    @property
    def field_map(self) -> DataFrame:
        return self.seeds["custom_field_map"]

    @property
    def outcomes(self) -> DataFrame:
        return self.seeds["funnel_outcome_map"]

    @property
    def categories(self) -> DataFrame:
        return self.seeds["objection_category_map"]

    @cached_property
    def activities_raw(self) -> DataFrame:
        return self.raw("lead_activities_raw")

    @cached_property
    def wrappers(self) -> DataFrame:
        return bronze.stage_lead_activities(self.activities_raw)

    @cached_property
    def activities(self) -> DataFrame:
        return silver.silver_activities(self.wrappers)

    @cached_property
    def events(self) -> DataFrame:
        return silver.custom_activity_events(self.activities)

    @cached_property
    def stored_events(self) -> DataFrame:
        """For queries that read the events several times."""
        return stored(self.events, "custom_activity_events")

    @cached_property
    def narrow(self) -> DataFrame:
        found = gold.latest_funnel_events(self.activities, self.types, self.field_map)
        return stored(found, "funnel_events")

    @cached_property
    def paths(self) -> DataFrame:
        return gold.funnel_paths(self.narrow)

    @cached_property
    def stored_paths(self) -> DataFrame:
        """For queries that read the fact several times."""
        return stored(self.paths, "fact_lead_funnel")

    @cached_property
    def leads(self) -> DataFrame:
        return bronze.stage_leads(self.raw("leads_raw"))

    @cached_property
    def staged_users(self) -> DataFrame:
        return bronze.stage_users(self.raw("close_crm_users_raw"))

    @cached_property
    def users(self) -> DataFrame:
        return stored(gold.dim_user(self.staged_users), "dim_user")

    @cached_property
    def metadata(self) -> DataFrame:
        return bronze.stage_custom_activities(self.raw("custom_activities_raw"))

    @cached_property
    def activity_fields(self) -> DataFrame:
        """For queries that read fields of all kinds of activities."""
        return stored(gold.activity_fields(self.activities, self.field_map), "activity_fields")

    def inbound(self, paths: DataFrame | None = None) -> DataFrame:
        if paths is None:
            events = gold.latest_of_fields(self.activity_fields, self.types)
            paths = gold.funnel_paths(stored(events, "funnel_events"))
        return reports.rpt_inbound_setter(
            paths, self.activity_fields, self.users, self.outcomes
        )

    def outbound(self, paths: DataFrame | None = None) -> DataFrame:
        return reports.rpt_outbound_setter(paths or self.paths, self.users, self.outcomes)

    def closer(self, paths: DataFrame | None = None) -> DataFrame:
        return reports.rpt_closer(paths or self.paths, self.users, self.outcomes)

    def objections(self, paths: DataFrame | None = None) -> DataFrame:
        return reports.rpt_objections_faced(paths or self.paths, self.categories)


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that both engines print them alike."""
    cast = {}
    for field in df.schema:
        if isinstance(field.dataType, T.DecimalType):
            cast[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.DateType):
            cast[field.name] = F.col(field.name).cast("string")
    return df.withColumns(cast) if cast else df


def query(name: str, oracle: str | None = None):
    def register(function: Callable[[Crm], DataFrame]):
        MODELS[name] = function
        QUERIES[name] = lambda spark, sf_dir: portable(function(Crm(spark, sf_dir)))
        if oracle is not None:
            RAW_ORACLE[name] = oracle
            ORACLE[name] = sql(oracle)
        return function

    return register


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/funnelry/{name}-{uuid.uuid4().hex}"


def shown(*columns: str) -> str:
    """Select list with ``date:`` columns as text and ``money:`` columns as doubles."""
    out = []
    for column in columns:
        kind, _, name = column.rpartition(":")
        target = {"date": "VARCHAR", "money": "DOUBLE", "int": "BIGINT"}.get(kind)
        out.append(f"CAST({name} AS {target}) AS {name}" if target else name)
    return ", ".join(out)


# --- landing ------------------------------------------------------------------------


def landed_folder(c: Crm) -> str:
    """Activity wrapper rows exported as JSON lines, one folder per load date."""
    folder = scratch(c.spark, "landing")
    landing.export_lines(c.activities_raw, "load_date").write.partitionBy("load_date").text(folder)
    return folder


WRAPPERS = "(SELECT event_id, 0 AS v FROM events UNION ALL SELECT event_id, 1 FROM events WHERE event_id % 10 = 0) w"
STAMP = "CASE WHEN v = 0 THEN TIMESTAMP '2026-05-16 07:30:00' ELSE TIMESTAMP '2026-05-17 07:30:00' END"
STAMP_W = STAMP.replace("v =", "w.v =")


@query(
    "land_jsonl",
    """SELECT CAST(load_date AS VARCHAR) AS load_date, activity_id, lead_id, activity_type
       FROM act WHERE activity_array_index = 0""",
)
def land_jsonl(c: Crm) -> DataFrame:
    lines = landing.read_variant(c.spark, landed_folder(c))
    first = F.try_variant_get("document", "$.raw_data.data[0]", "variant")
    found = lines.select("load_date", first.alias("a")).where(F.col("a").isNotNull())
    return found.select(
        "load_date",
        documents.text("a", "id").alias("activity_id"),
        documents.text("a", "lead_id").alias("lead_id"),
        documents.text("a", "_type").alias("activity_type"),
    )


@query(
    "land_unwrap",
    "SELECT event_id, event_type, value FROM events",
)
def land_unwrap(c: Crm) -> DataFrame:
    payload = F.struct("event_id", "event_type", "value")
    wrapped = F.to_json(F.struct(payload.alias("raw_data"), F.lit("x").alias("insert_date")))
    line = F.when(F.col("event_id") % 2 == 0, wrapped).otherwise(F.to_json(payload))
    raw = c.table("events").select(landing.unwrap(F.parse_json(line)).alias("raw_data"))
    return raw.select(
        documents.text("raw_data", "event_id").cast("bigint").alias("event_id"),
        documents.text("raw_data", "event_type").alias("event_type"),
        documents.text("raw_data", "value").cast("double").alias("value"),
    )


@query(
    "land_lineage",
    f"""SELECT CAST(load_date AS VARCHAR) AS load_date, count(*) AS row_count, count(*) AS distinct_positions,
               TRUE AS numbers_are_complete
        FROM (SELECT CAST({STAMP} AS DATE) AS load_date FROM {WRAPPERS}) GROUP BY 1""",
)
def land_lineage(c: Crm) -> DataFrame:
    """Every file's rows are numbered 1..n without gaps or repeats."""
    raw = landing.read_landed(c.spark, landed_folder(c), LOAD_TS)
    files = raw.groupBy("source_file_name").agg(
        F.count("*").alias("n"),
        F.countDistinct("source_row_number").alias("d"),
        F.min("source_row_number").alias("lo"),
        F.max("source_row_number").alias("hi"),
    )
    load_date = F.regexp_extract("source_file_name", r"load_date=([0-9-]+)", 1)
    return files.groupBy(load_date.alias("load_date")).agg(
        F.sum("n").alias("row_count"),
        F.sum("d").alias("distinct_positions"),
        F.bool_and((F.col("lo") == 1) & (F.col("hi") == F.col("n"))).alias("numbers_are_complete"),
    )


@query(
    "land_stamps",
    """SELECT event_id, '2026-05-17' AS load_date, TIMESTAMP '2026-05-17 07:30:00' AS bronze_loaded_at,
              CASE event_id % 3 WHEN 0 THEN ts ELSE TIMESTAMP '2026-05-17 07:30:00' END AS insert_date
       FROM events""",
)
def land_stamps(c: Crm) -> DataFrame:
    """Insert date from the line where it is readable, else the load time."""
    stamp = F.expr("CASE event_id % 3 WHEN 0 THEN CAST(ts AS STRING) WHEN 1 THEN 'soon' END")
    line = F.to_json(F.struct("event_id", stamp.alias("insert_date")))
    numbered = c.table("events").select(
        line.alias("value"),
        F.lit("f").alias("source_file_name"),
        F.col("event_id").alias("source_row_number"),
    )
    raw = landing.to_raw(numbered, LOAD_TS)
    return raw.select(
        documents.text("raw_data", "event_id").cast("bigint").alias("event_id"),
        "load_date",
        "bronze_loaded_at",
        "insert_date",
    )


@query(
    "land_incremental",
    f"SELECT 1 AS load_number, count(*) AS row_count FROM {WRAPPERS} WHERE v = 0 "
    f"UNION ALL SELECT 2, count(*) FROM {WRAPPERS} WHERE v = 0 "
    f"UNION ALL SELECT 3, count(*) FROM {WRAPPERS}",
)
def land_incremental(c: Crm) -> DataFrame:
    """Row counts after the first load, a repeated run and a run with a new folder."""
    base = scratch(c.spark, "incremental")
    source, target, checkpoint = f"{base}/in", f"{base}/raw", f"{base}/checkpoint"
    counts = None
    for number, arriving in ((1, 0), (2, None), (3, 1)):
        if arriving is not None:
            day = crm.LOADS[arriving].date()
            part = c.activities_raw.where(F.col("load_date") == F.lit(day))
            landing.export_files(part, source, day)
        incremental.land_new_files(c.spark, source, target, checkpoint, LOAD_TS)
        n = incremental.read_raw_table(c.spark, target).agg(
            F.lit(number).alias("load_number"), F.count("*").alias("row_count")
        )
        n = stored(n, "counts")
        counts = n if counts is None else counts.unionByName(n)
    return counts


@query(
    "land_file_manifest",
    f"SELECT count(*) AS row_count, 2 AS load_dates FROM {WRAPPERS}",
)
def land_file_manifest(c: Crm) -> DataFrame:
    base = scratch(c.spark, "manifest")
    incremental.land_new_files(
        c.spark, landed_folder(c), f"{base}/raw", f"{base}/checkpoint", LOAD_TS
    )
    manifest = incremental.file_manifest(incremental.read_raw_table(c.spark, f"{base}/raw"))
    load_date = F.regexp_extract("source_file_name", r"load_date=([0-9-]+)", 1)
    return manifest.agg(
        F.sum("rows_loaded").alias("row_count"),
        F.countDistinct(load_date).cast("int").alias("load_dates"),
    )


@query(
    "land_content",
    f"""SELECT CAST(CAST({STAMP_W} AS DATE) AS VARCHAR) AS folder, w.event_id % 4 AS part,
               row_number() OVER (PARTITION BY w.v, w.event_id % 4 ORDER BY w.event_id) AS source_row_number,
               a.activity_id, a.lead_id, a.custom_activity_type_id, {STAMP_W} AS insert_date,
               TIMESTAMP '2026-05-17 07:30:00' AS bronze_loaded_at, w.v AS batch_id
        FROM {WRAPPERS} LEFT JOIN act a ON a.activity_array_index = 0 AND a.source_row_number = w.event_id + 1
             AND a.load_date = CAST({STAMP_W} AS DATE)""",
)
def land_content(c: Crm) -> DataFrame:
    """Documents, line numbers and stamps of two loads of new files, compacted afterwards."""
    base = scratch(c.spark, "content")
    source, target, checkpoint = f"{base}/in", f"{base}/raw", f"{base}/checkpoint"
    for load in crm.LOADS:
        day = c.activities_raw.where(F.col("load_date") == F.lit(load.date()))
        lines = landing.export_lines(day, "source_row_number").select(
            "value", "source_row_number", ((F.col("source_row_number") - 1) % 4).alias("part")
        )
        # One file for each part, with its lines in the order of their events.
        ordered = lines.repartition("part").sortWithinPartitions("part", "source_row_number")
        ordered.select("value", "part").write.partitionBy("part").text(
            f"{source}/load_date={load.date()}"
        )
        incremental.land_new_files(c.spark, source, target, checkpoint, LOAD_TS)
    incremental.compact_raw_table(c.spark, target)
    first = F.try_variant_get("raw_data", "$.data[0]", "variant")
    return incremental.read_raw_table(c.spark, target).select(
        F.regexp_extract("source_file_name", r"load_date=([0-9-]+)", 1).alias("folder"),
        F.regexp_extract("source_file_name", r"part=(\d)", 1).cast("bigint").alias("part"),
        "source_row_number",
        documents.text(first, "id").alias("activity_id"),
        documents.text(first, "lead_id").alias("lead_id"),
        documents.text(first, "custom_activity_type_id").alias("custom_activity_type_id"),
        "insert_date",
        "bronze_loaded_at",
        F.col("batch_id").cast("int").alias("batch_id"),
    )


@query(
    "land_partition_prune",
    f"SELECT '2026-05-17' AS load_date, count(*) AS row_count FROM {WRAPPERS} WHERE v = 1",
)
def land_partition_prune(c: Crm) -> DataFrame:
    lines = landing.read_partitioned(c.spark, landed_folder(c))
    day = lines.where(F.col("load_date") == F.lit(crm.LOADS[1].date()))
    return day.groupBy("load_date").agg(F.count("*").alias("row_count"))


@query(
    "land_preview",
    """SELECT event_id + 1 AS source_row_number, 'object' AS document_type FROM events ORDER BY event_id LIMIT 10""",
)
def land_preview(c: Crm) -> DataFrame:
    return landing.preview(c.activities_raw).select(
        "source_row_number", documents.type_name("raw_data").alias("document_type")
    )


@query(
    "file_load_profile",
    f"""SELECT 'lead_activites_raw/load_date=' || CAST(CAST({STAMP} AS DATE) AS VARCHAR) AS source_file_name,
               count(*) AS rows_loaded, min({STAMP}) AS min_insert_date, max({STAMP}) AS max_insert_date
        FROM {WRAPPERS} GROUP BY 1""",
)
def file_load_profile(c: Crm) -> DataFrame:
    return landing.file_load_profile(c.activities_raw)


@query(
    "export_jsonl",
    """SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS insert_date FROM orders""",
)
def export_jsonl(c: Crm) -> DataFrame:
    """Lines of a source table, written and read back."""
    folder = scratch(c.spark, "export")
    payload = F.struct("o_orderkey", "o_orderstatus", "o_totalprice")
    table = c.table("orders").select(
        payload.alias("raw_data"), F.col("o_orderdate").alias("insert_date")
    )
    landing.export_files(table, folder, dt.date(2026, 5, 16))
    doc = landing.read_variant(c.spark, folder)
    raw = doc.select(
        documents.part("document", "raw_data").alias("r"),
        documents.text("document", "insert_date").alias("t"),
    )
    return raw.select(
        documents.text("r", "o_orderkey").cast("bigint").alias("o_orderkey"),
        documents.text("r", "o_orderstatus").alias("o_orderstatus"),
        documents.text("r", "o_totalprice").cast("double").alias("o_totalprice"),
        values.timestamp("t").alias("insert_date"),
    )


@query(
    "seed_load",
    """SELECT t.custom_activity_type_id, t.custom_activity_type_name, t.funnel_source, t.funnel_stage,
              t.is_revenue_event, t.is_active, count(a.activity_id) AS delivered
       FROM types t LEFT JOIN act a ON a.custom_activity_type_id = t.custom_activity_type_id GROUP BY ALL""",
)
def seed_load(c: Crm) -> DataFrame:
    """Seed rows with their declared types, and how many records use each."""
    used = c.activities.groupBy("custom_activity_type_id").agg(F.count("*").alias("n"))
    joined = c.types.join(used, "custom_activity_type_id", "left")
    return joined.withColumn("delivered", F.coalesce("n", F.lit(0))).drop("n")


# --- staging ------------------------------------------------------------------------

LEAD_COLUMNS = "lead_id, lead_name, display_name, status_id, status_label, lead_created_at, lead_updated_at"


@query(
    "stage_leads",
    f"""SELECT {LEAD_COLUMNS}, 'user_1' AS created_by_user_id, CAST(NULL AS VARCHAR) AS updated_by_user_id,
               source_file_name, source_row_number, CAST(load_date AS VARCHAR) AS load_date, insert_date
        FROM lead_rows""",
)
def stage_leads(c: Crm) -> DataFrame:
    return c.leads.drop("raw_data", "bronze_loaded_at")


@query(
    "stage_subdocument",
    f"""SELECT 'lead_activities' AS feed, count(*) AS n FROM {WRAPPERS}
        UNION ALL SELECT 'users', count(*) FROM customer, (VALUES (0), (1)) u(v)
                  WHERE (v = 0 OR c_custkey % 4 = 0) AND c_custkey % 50 >= 0
        UNION ALL SELECT 'custom_activities', count(*) FROM part""",
)
def stage_subdocument(c: Crm) -> DataFrame:
    """Rows whose nested part is there, per feed."""
    parts = {
        "lead_activities": (c.wrappers, "activity_data"),
        "users": (c.staged_users, "json_object_text"),
        "custom_activities": (c.metadata, "json_object_text"),
    }
    counts = [df.agg(F.lit(f).alias("feed"), F.count(x).alias("n")) for f, (df, x) in parts.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


ACT = (
    "activity_id, lead_id, activity_type, custom_activity_type_id, activity_at, activity_created_at, "
    "activity_updated_at, user_id"
)
LINEAGE_SQL = "source_file_name, source_row_number, CAST(load_date AS VARCHAR) AS load_date, insert_date"


@query(
    "silver_activities",
    f"SELECT {ACT}, activity_array_index, {LINEAGE_SQL} FROM act",
)
def silver_activities(c: Crm) -> DataFrame:
    return c.activities.drop("activity", "bronze_loaded_at")


@query(
    "flatten_array",
    "SELECT event_id, i AS element_index, event_id * 10 + i AS element FROM events, (VALUES (0), (1), (2)) t(i) "
    "WHERE i < event_id % 4",
)
def flatten_array(c: Crm) -> DataFrame:
    """Arrays of 0 to 3 elements to rows; a scalar where the array should be gives none."""
    text = F.expr(
        "CASE event_id % 4 WHEN 0 THEN if(event_id % 8 = 0, '[]', '7') "
        "ELSE to_json(transform(sequence(0, cast(event_id % 4 as int) - 1), i -> event_id * 10 + i)) END"
    )
    rows = c.table("events").select("event_id", F.parse_json(text).alias("items"))
    flat = silver.flatten_array(rows, "items", "element_index", "element")
    return flat.withColumn("element", F.col("element").cast("bigint"))


CUSTOM_COLUMNS = "activity_id, lead_id, custom_activity_type_id, activity_at, activity_updated_at, user_id"


@query(
    "silver_custom_events",
    f"SELECT {CUSTOM_COLUMNS}, 1 AS row_number_latest, activity_array_index, {LINEAGE_SQL} FROM custom",
)
def silver_custom_events(c: Crm) -> DataFrame:
    return c.events.drop("activity", "bronze_loaded_at", "activity_type", "activity_created_at")


@query(
    "dedup_latest",
    """SELECT user_id, event_type, event_id, ts, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""",
)
def dedup_latest(c: Crm) -> DataFrame:
    rows = c.table("events").drop("props")
    return latest_by(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop(RANK)


@query(
    "events_by_type",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS activity_type, activity_id, lead_id, activity_at, activity_updated_at, user_id, "
        "status, title, note, sequence_name FROM (SELECT * FROM act WHERE activity_type = "
        f"'{t}' QUALIFY row_number() OVER (PARTITION BY lead_id, activity_id ORDER BY activity_updated_at DESC "
        "NULLS LAST, activity_at DESC NULLS LAST, load_date DESC, activity_array_index DESC) = 1)"
        for t in silver.TYPE_FIELDS
    ),
)
def events_by_type(c: Crm) -> DataFrame:
    """Call, message, meeting and note tables, stacked."""
    events = stored(silver.other_events(c.activities), "other_events")
    result = None
    for kind in silver.TYPE_FIELDS:
        rows = silver.events_by_type(events, kind).withColumn("activity_type", F.lit(kind))
        result = rows if result is None else result.unionByName(rows, allowMissingColumns=True)
    return result


# --- predicates and scalar functions ------------------------------------------------


@query(
    "mapping_active_filter",
    """SELECT canonical_field_name, custom_field_id, count(f.activity_id) AS filled
       FROM fields m LEFT JOIN field_rows f USING (custom_field_id)
       WHERE m.is_active AND canonical_field_name IN ('setter_user_id', 'closer_user_id') GROUP BY ALL""",
)
def mapping_active_filter(c: Crm) -> DataFrame:
    wanted = c.field_map.where(
        values.is_true("is_active")
        & F.col("canonical_field_name").isin("setter_user_id", "closer_user_id")
    )
    filled = fields.explode_keys(c.events, "activity", ["activity_id"])
    counts = filled.groupBy("custom_field_id").agg(F.count("*").alias("n"))
    return wanted.join(counts, "custom_field_id", "left").select(
        "canonical_field_name", "custom_field_id", F.coalesce("n", F.lit(0)).alias("filled")
    )


@query(
    "ilike_flag",
    "SELECT doc_id, CASE WHEN text ILIKE '%the%' THEN 1 ELSE 0 END AS has_word FROM documents",
)
def ilike_flag(c: Crm) -> DataFrame:
    found = values.flag(F.col("text").ilike("%the%"))
    return c.table("documents").select("doc_id", found.alias("has_word"))


@query(
    "like_prefix",
    "SELECT p_partkey, p_brand LIKE 'Brand_1%' AS is_match, p_type LIKE 'SMALL%' AS is_small FROM part",
)
def like_prefix(c: Crm) -> DataFrame:
    return c.table("part").select(
        "p_partkey",
        F.col("p_brand").like("Brand_1%").alias("is_match"),
        F.col("p_type").like("SMALL%").alias("is_small"),
    )


@query(
    "nonblank_filter",
    "SELECT event_type, count(*) AS n FROM (SELECT event_type, CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '  ' "
    "WHEN 2 THEN NULL ELSE props END AS t FROM events) WHERE t IS NOT NULL AND trim(t) <> '' GROUP BY 1",
)
def nonblank_filter(c: Crm) -> DataFrame:
    text = F.expr("CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN NULL ELSE props END")
    rows = c.table("events").select("event_type", text.alias("t"))
    return rows.where(values.not_blank("t")).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "path_category",
    """SELECT path_category, count(*) AS n FROM (SELECT CASE
         WHEN event_id % 2 = 0 AND event_id % 3 = 0 THEN 'initial_to_strategy_to_sale'
         WHEN event_id % 2 = 0 THEN 'initial_to_strategy_no_sale' ELSE 'initial_no_strategy' END AS path_category
       FROM events) GROUP BY 1""",
)
def path_category(c: Crm) -> DataFrame:
    ids = F.col("event_id")
    category = gold.path_category(F.when(ids % 2 == 0, ids), F.when(ids % 3 == 0, ids))
    return c.table("events").groupBy(category.alias("path_category")).agg(F.count("*").alias("n"))


@query(
    "try_timestamp",
    """SELECT event_id, CASE event_id % 4 WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN NULL
              WHEN 1 THEN NULL ELSE ts END AS parsed FROM events""",
)
def try_timestamp(c: Crm) -> DataFrame:
    text = F.expr(
        "CASE event_id % 4 WHEN 0 THEN cast(ts as string) WHEN 1 THEN 'not a time' "
        "WHEN 2 THEN concat(left(cast(ts as string), 19), '+05:00') ELSE '' END"
    )
    return c.table("events").select("event_id", values.timestamp(text).alias("parsed"))


@query(
    "strict_timestamp",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS parsed FROM events""",
)
def strict_timestamp(c: Crm) -> DataFrame:
    text = F.expr("CASE event_id % 3 WHEN 0 THEN '' ELSE cast(ts as string) END")
    parsed = values.strict_timestamp(text).cast("timestamp_ntz")
    return c.table("events").select("event_id", parsed.alias("parsed"))


ORDER_TIME = "o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24)"


def order_time() -> F.Column:
    return F.expr("o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int))")


@query(
    "local_report_date",
    f"SELECT o_orderkey, CAST({NY.format(ORDER_TIME)} AS VARCHAR) AS report_date FROM orders",
)
def local_report_date(c: Crm) -> DataFrame:
    day = values.local_date(order_time(), "America/New_York")
    return c.table("orders").select("o_orderkey", day.alias("report_date"))


@query(
    "utc_report_date",
    f"SELECT o_orderkey, CAST(CAST({ORDER_TIME} AS DATE) AS VARCHAR) AS report_date FROM orders",
)
def utc_report_date(c: Crm) -> DataFrame:
    return c.table("orders").select("o_orderkey", values.utc_date(order_time()).alias("report_date"))


MONEY_TEXT = (
    "CASE o_orderkey % 6 WHEN 0 THEN '$' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR(30)) || ' USD' "
    "WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN '1-2' WHEN 4 THEN '-5' ELSE '1,200.505' END"
)


@query(
    "money_clean",
    f"""SELECT o_orderkey, CAST(TRY_CAST(nullif(regexp_replace({MONEY_TEXT}, '[^0-9.-]', '', 'g'), '')
               AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM orders""",
)
def money_clean(c: Crm) -> DataFrame:
    text = F.expr(crm.spark_sql(MONEY_TEXT).replace("VARCHAR(30)", "STRING"))
    return c.table("orders").select("o_orderkey", values.money(text).alias("amount"))


USER_TEXTS = f"(SELECT c_custkey, 0 AS v, {crm.USER_TEXT.replace('v = 1', 'FALSE')} AS t FROM customer)"


@query(
    "regex_fields",
    f"""SELECT c_custkey,
          CASE WHEN regexp_matches(t, '''email'': ''([^'']*)''') THEN regexp_extract(t, '''email'': ''([^'']*)''', 1) END AS email,
          CASE WHEN regexp_matches(t, '''first_name'': ''([^'']*)''') THEN regexp_extract(t, '''first_name'': ''([^'']*)''', 1) END AS first_name
        FROM {USER_TEXTS}""",
)
def regex_fields(c: Crm) -> DataFrame:
    """A field that is absent is NULL, one that is there but empty stays empty."""
    text = F.expr(crm.spark_sql(crm.USER_TEXT.replace("v = 1", "FALSE")))
    rows = c.table("customer").select("c_custkey", text.alias("t"))
    found = {n: values.capture("t", gold.USER_FIELD.format(name=n)) for n in ("email", "first_name")}
    return rows.select("c_custkey", *[x.alias(n) for n, x in found.items()])


@query(
    "regex_objects",
    f"""SELECT c_custkey, unnest(regexp_extract_all(t, '\\{{[^{{}}]*''id'': ''user_[^'']+''[^{{}}]*\\}}')) AS user_object_text
        FROM {USER_TEXTS}""",
)
def regex_objects(c: Crm) -> DataFrame:
    text = F.expr(crm.spark_sql(crm.USER_TEXT.replace("v = 1", "FALSE")))
    rows = c.table("customer").select("c_custkey", text.alias("t"))
    objects = F.explode(values.all_matches("t", gold.USER_OBJECT))
    return rows.select("c_custkey", objects.alias("user_object_text"))


@query(
    "regex_metadata",
    "SELECT custom_field_id, custom_field_name, custom_field_type FROM field_names",
)
def regex_metadata(c: Crm) -> DataFrame:
    return profile.field_names(c.metadata)


@query(
    "distinct_metadata",
    "SELECT custom_activity_type_id, custom_activity_type_name FROM type_names",
)
def distinct_metadata(c: Crm) -> DataFrame:
    return profile.type_names(c.metadata)


LIST_TEXT = (
    "CASE p_partkey % 4 WHEN 0 THEN '[\"' || p_brand || '\", \"' || p_type || '\"]' "
    "WHEN 1 THEN p_brand || ' ,  ' || p_type WHEN 2 THEN p_type ELSE '[]' END"
)


@query(
    "objection_text_split",
    f"""SELECT p_partkey, label FROM (SELECT p_partkey, trim(unnest(regexp_split_to_array(
            trim(replace(regexp_replace({LIST_TEXT}, '^\\[|\\]$', '', 'g'), '"', '')), '\\s*,\\s*'))) AS label FROM part)
        WHERE label <> ''""",
)
def objection_text_split(c: Crm) -> DataFrame:
    rows = c.table("part").select("p_partkey", F.expr(LIST_TEXT).alias("t"))
    labels = rows.select("p_partkey", F.explode(values.split_list_text("t")).alias("label"))
    return labels.where("label <> ''")


@query(
    "surrogate_key",
    """SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus || '|'
              || coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END, '')) AS row_key FROM orders""",
)
def surrogate_key(c: Crm) -> DataFrame:
    optional = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
    key = values.joined_key(
        F.col("o_orderkey").cast("string"), F.col("o_orderstatus"), F.coalesce(optional, F.lit(""))
    )
    return c.table("orders").select("o_orderkey", key.alias("row_key"))


@query(
    "full_name",
    """SELECT c_custkey, trim(coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_name END, '') || ' '
              || coalesce(CASE WHEN c_custkey % 2 <> 0 THEN c_mktsegment END, '')) AS full_name FROM customer""",
)
def full_name(c: Crm) -> DataFrame:
    key = F.col("c_custkey")
    rows = c.table("customer").select(
        "c_custkey",
        F.when(key % 3 != 0, F.col("c_name")).alias("first"),
        F.when(key % 2 != 0, F.col("c_mktsegment")).alias("last"),
    )
    return rows.select("c_custkey", values.full_name("first", "last").alias("full_name"))


@query(
    "string_fns",
    """SELECT doc_id, md5(lower(text)) AS lowered_hash, left(text, 500) AS sample, replace(source, 'e', '') AS short_source,
              lang || '|' || source AS both_names, length(trim(text)) AS trimmed_length FROM documents""",
)
def string_fns(c: Crm) -> DataFrame:
    return c.table("documents").select(
        "doc_id",
        F.md5(F.lower("text")).alias("lowered_hash"),
        F.left("text", F.lit(500)).alias("sample"),
        F.replace("source", F.lit("e"), F.lit("")).alias("short_source"),
        F.concat("lang", F.lit("|"), "source").alias("both_names"),
        F.length(F.trim("text")).cast("bigint").alias("trimmed_length"),
    )


@query(
    "guarded_ratio",
    f"""SELECT l_suppkey, {ratio('returned', 'n')} AS return_rate, {ratio('n', 'returned')} AS inverse_rate
        FROM (SELECT l_suppkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R' AND l_suppkey % 5 <> 0) AS returned
              FROM lineitem GROUP BY 1)""",
)
def guarded_ratio(c: Crm) -> DataFrame:
    returned = (F.col("l_returnflag") == "R") & (F.col("l_suppkey") % 5 != 0)
    counts = c.table("lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.count_if(returned).alias("returned")
    )
    return counts.select(
        "l_suppkey",
        values.ratio("returned", "n", 4).alias("return_rate"),
        values.ratio("n", "returned", 4).alias("inverse_rate"),
    )


# --- documents ----------------------------------------------------------------------


@query(
    "object_keys",
    """SELECT event_id, unnest(CASE event_id % 3 WHEN 0 THEN ['a', 'event.type', 'k'] WHEN 1 THEN ['k'] END) AS document_key
       FROM events""",
)
def object_keys(c: Crm) -> DataFrame:
    text = F.expr(
        "CASE event_id % 3 WHEN 0 THEN concat('{\"k\":1,\"event.type\":\"', event_type, '\",\"a\":null}') "
        "WHEN 1 THEN props ELSE '[1]' END"
    )
    rows = c.table("events").select("event_id", F.parse_json(text).alias("d"))
    keys = F.explode(F.map_keys(documents.entries("d")))
    return rows.select("event_id", keys.alias("document_key"))


@query(
    "explode_object",
    """SELECT event_id, k.document_key, k.document_value FROM events,
       LATERAL (VALUES ('type.name', event_type), ('user', CAST(user_id AS VARCHAR))) k(document_key, document_value)""",
)
def explode_object(c: Crm) -> DataFrame:
    doc = F.parse_json(F.to_json(F.struct(F.col("event_type").alias("type.name"), F.col("user_id").alias("user"))))
    pairs = F.explode(documents.entries(doc)).alias("document_key", "v")
    rows = c.table("events").select("event_id", pairs)
    return rows.select("event_id", "document_key", F.col("v").cast("string").alias("document_value"))


@query(
    "flatten_multiselect",
    """SELECT activity_id, unnest(json_extract_string(objections, '$[*]')) AS label FROM custom
       WHERE json_type(objections) = 'ARRAY'""",
)
def flatten_multiselect(c: Crm) -> DataFrame:
    """List fields to rows; a plain string or an absent field gives none."""
    field = documents.part("activity", f"custom.{crm.OBJECTIONS_FIELD}")
    labels = c.events.select("activity_id", F.explode(documents.items(field)).alias("item"))
    return labels.select("activity_id", F.col("item").cast("string").alias("label"))


@query(
    "json_shape_profile",
    f"""SELECT 'lead_activities_raw' AS table_name, 'object' AS raw_data_type, 'data' AS nested_key,
               'array' AS nested_key_type, count(*) AS row_count FROM {WRAPPERS}
        UNION ALL SELECT 'close_crm_users_raw', 'object', 'JSON_OBJECT', 'string', count(*)
                  FROM customer, (VALUES (0), (1)) u(v) WHERE v = 0 OR c_custkey % 4 = 0
        UNION ALL SELECT 'custom_activities_raw', 'object', 'JSON_OBJECT', 'string', count(*) FROM part
        UNION ALL SELECT 'leads_raw', 'object', NULL, NULL, count(*) FROM lead_rows""",
)
def json_shape_profile(c: Crm) -> DataFrame:
    tables = {
        "lead_activities_raw": (c.activities_raw, "data"),
        "close_crm_users_raw": (c.raw("close_crm_users_raw"), "JSON_OBJECT"),
        "custom_activities_raw": (c.raw("custom_activities_raw"), "JSON_OBJECT"),
        "leads_raw": (c.raw("leads_raw"), None),
    }
    return profile.json_shape_profile(tables)


#: Key paths of activities by the flat column that fills them; the rest is text.
ACTIVITY_PATHS = {
    **{k: k for k in ("lead_id", "custom_activity_type_id", "user_id", "status", "title", "note", "sequence_name")},
    "id": "activity_id",
    "_type": "activity_type",
    "activity_at": "coalesce(CAST(activity_at AS VARCHAR), '')",
    "date_created": "activity_created_at",
    "date_updated": "activity_updated_at",
    **{f"custom.{i}": column for column, i in crm.CUSTOM_KEYS.items()},
    f"custom.{crm.CONTRACT_FIELD}": "contract_text",
}
LEAD_PATHS = {
    "id": "lead_id", "name": "lead_name", "display_name": "display_name", "status_id": "status_id",
    "status_label": "status_label", "date_created": "lead_created_at", "date_updated": "lead_updated_at",
    "created_by": "'user_1'",
}


def _path_counts(table: str, prefix: str, paths: dict[str, str], source: str, kind: str = "string") -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{prefix}{path}' AS key_path, '{kind}' AS type, count({column}) AS occurrences FROM {source}"
        for path, column in paths.items()
    ]


NUMBER_PATHS = {f"custom.{crm.CASH_FIELD}": "cash_cents", f"custom.{crm.EXTRA_FIELD}": "extra_cents"}
OBJECTION_ITEMS = "(SELECT len(CAST(json_extract(objections, '$[*]') AS VARCHAR[])) AS n FROM act WHERE objections LIKE '[%')"
SHAPES = [
    *_path_counts("leads_raw", "", LEAD_PATHS, "lead_rows"),
    *_path_counts("leads_raw", "", {"": "*"}, "lead_rows", "object"),
    *_path_counts("close_crm_users_raw", "", {"": "*"}, "user_texts", "object"),
    *_path_counts("close_crm_users_raw", "", {"JSON_OBJECT": "*"}, "user_texts"),
    *_path_counts("custom_activities_raw", "", {"": "*"}, "part", "object"),
    *_path_counts("custom_activities_raw", "", {"JSON_OBJECT": "*"}, "part"),
    *_path_counts("lead_activities_raw", "", {"": "*"}, WRAPPERS, "object"),
    *_path_counts("lead_activities_raw", "", {"data": "*"}, WRAPPERS, "array"),
    *_path_counts("lead_activities_raw", "", {"data[]": "*"}, "act", "object"),
    *_path_counts("lead_activities_raw", "data[].", ACTIVITY_PATHS, "act"),
    *_path_counts("lead_activities_raw", "data[].", NUMBER_PATHS, "act", "number"),
    *[
        part
        for kind, first in (("array", "["), ("string", '"'))
        for part in _path_counts(
            "lead_activities_raw",
            "data[].",
            {f"custom.{crm.OBJECTIONS_FIELD}": "*"},
            f"(SELECT * FROM act WHERE objections LIKE '{first}%')",
            kind,
        )
    ],
]


@query(
    "document_shapes",
    "WITH user_texts AS (SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_custkey % 4 = 0) "
    "SELECT * FROM (" + "\nUNION ALL\n".join(SHAPES) + ") WHERE occurrences > 0",
)
def document_shapes(c: Crm) -> DataFrame:
    """Key paths and types of all four feeds, nested keys included."""
    feeds = {name: c.raw(name) for name in crm.RAW_TABLES}
    return profile.document_shapes(feeds)


def _first_rows(table: str, source: str, load: str, row: str, keys: str, kind: str, size: str, sample: str) -> str:
    return (
        f"SELECT * FROM (SELECT '{table}' AS table_name, {load} AS insert_date, {row} AS source_row_number, "
        f"'object' AS raw_data_type, {keys} AS top_level_keys, {kind} AS data_key_type, {size} AS activity_count_in_row, "
        f"{sample} AS json_object_sample FROM {source} ORDER BY 2, 3 LIMIT 5)"
    )


USER_STAMP = "TIMESTAMP '2026-05-16 07:30:00'"


@query(
    "raw_samples",
    "\nUNION ALL\n".join(
        [
            _first_rows(
                "lead_activities_raw", WRAPPERS, STAMP, "event_id + 1", "'data'", "'array'",
                "CASE WHEN v = 0 AND event_id % 97 = 0 THEN 0 WHEN v = 0 AND event_id % 7 = 0 THEN 2 ELSE 1 END", "NULL",
            ),
            _first_rows(
                "close_crm_users_raw", f"(SELECT *, {crm.duckdb_sql(crm.USER_TEXT)} AS t FROM (SELECT *, 0 AS v FROM customer))",
                USER_STAMP, "c_custkey + 1", "'JSON_OBJECT'", "NULL", "NULL", "t[1:500]",
            ),
            _first_rows(
                "custom_activities_raw", "meta", USER_STAMP, "p_partkey + 1", "'JSON_OBJECT'", "NULL", "NULL", "t[1:500]"
            ),
        ]
    ),
)
def raw_samples(c: Crm) -> DataFrame:
    """First rows of the feeds that nest: keys, size of the nested part, a short sample."""
    nested = {"lead_activities_raw": "data", "close_crm_users_raw": "JSON_OBJECT", "custom_activities_raw": "JSON_OBJECT"}
    found = [profile.top_level_keys(c.raw(t), t, nested=n) for t, n in nested.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    return rows.withColumn("top_level_keys", F.array_join("top_level_keys", ","))


#: Spark's types of the driver tables as the other engine names them.
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "array<float>": "FLOAT[]",
}
CATALOGUED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]


@query(
    "table_catalog",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, 'EXTERNAL' AS table_type, CAST(row_number() OVER () AS INTEGER) AS ordinal_position, "
        f"column_name, replace(column_type, 'TIMESTAMP_NS', 'TIMESTAMP') AS data_type, (SELECT count(*) FROM {t}) AS row_count "
        f"FROM (DESCRIBE SELECT * FROM {t})"
        for t in CATALOGUED
    ),
)
def table_catalog(c: Crm) -> DataFrame:
    """Inventory, columns, types and row counts of tables in the catalog."""
    database = f"catalogued_{uuid.uuid4().hex}"
    c.spark.sql(f"CREATE DATABASE {database}")
    for t in CATALOGUED:
        c.spark.catalog.createTable(f"{database}.{t}", f"{c.sf_dir}/{t}.parquet", "parquet")
    found = profile.catalog_profile(c.spark, database)
    named = F.col("data_type")
    for spark_name, name in TYPE_NAMES.items():
        named = F.when(F.col("data_type") == spark_name, name).otherwise(named)
    return found.select(
        "table_name", "table_type", "ordinal_position", "column_name", named.alias("data_type"), "row_count"
    )


@query(
    "stage_listing",
    f"SELECT CAST(CAST({STAMP} AS DATE) AS VARCHAR) AS load_date, TRUE AS has_files, TRUE AS has_bytes FROM {WRAPPERS} GROUP BY 1",
)
def stage_listing(c: Crm) -> DataFrame:
    """Files waiting in the landing folder, by the load date of their folder."""
    files = landing.list_files(c.spark, landed_folder(c))
    load_date = F.regexp_extract("path", r"load_date=([0-9-]+)", 1).alias("load_date")
    return files.groupBy(load_date).agg(
        (F.count("*") > 0).alias("has_files"), (F.sum("length") > 0).alias("has_bytes")
    )


@query(
    "json_types",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'string' WHEN 1 THEN 'number' WHEN 2 THEN 'boolean'
              WHEN 3 THEN 'null' WHEN 4 THEN 'array' ELSE 'object' END AS json_type FROM events""",
)
def json_types(c: Crm) -> DataFrame:
    text = F.expr(
        "CASE event_id % 6 WHEN 0 THEN '\"x\"' WHEN 1 THEN cast(value as string) WHEN 2 THEN 'true' "
        "WHEN 3 THEN 'null' WHEN 4 THEN '[1,\"a\"]' ELSE props END"
    )
    kind = documents.type_name(F.parse_json(text))
    return c.table("events").select("event_id", kind.alias("json_type"))


@query(
    "top_level_keys",
    """SELECT 'leads_raw' AS table_name, insert_date, source_row_number, 'object' AS raw_data_type,
              array_to_string(list_sort([x FOR x IN [CASE WHEN lead_name IS NOT NULL THEN 'name' END,
                CASE WHEN display_name IS NOT NULL THEN 'display_name' END, 'id', 'status_id',
                CASE WHEN status_label IS NOT NULL THEN 'status_label' END, 'date_created', 'created_by',
                CASE WHEN lead_updated_at IS NOT NULL THEN 'date_updated' END] IF x IS NOT NULL]), ',') AS top_level_keys
       FROM lead_rows ORDER BY insert_date, source_file_name, source_row_number LIMIT 5""",
)
def top_level_keys(c: Crm) -> DataFrame:
    keys = profile.top_level_keys(c.raw("leads_raw"), "leads_raw")
    return keys.withColumn("top_level_keys", F.array_join("top_level_keys", ","))


REPAIR = {
    "user_id": "CASE WHEN c_custkey % 6 NOT IN (3, 5) THEN 'user_' || CAST(c_custkey AS VARCHAR) END",
    "note": (
        "CASE c_custkey % 6 WHEN 0 THEN 'it''s ' || c_name WHEN 1 THEN 'it''s ' || c_name "
        "WHEN 2 THEN 'O''Neil: \"' || c_name || '\", ok' WHEN 3 THEN 'None, True: {x}' END"
    ),
    "how": (
        "CASE c_custkey % 6 WHEN 0 THEN 'parsed' WHEN 4 THEN 'by_field' "
        "WHEN 5 THEN CASE WHEN c_custkey % 12 = 5 THEN 'blank' ELSE 'failed' END ELSE 'repaired' END"
    ),
}


def repair_input(c: Crm) -> DataFrame:
    """Object text as JSON, in two styles of another language, cut off, blank and no object."""
    name, key = F.col("c_name"), F.col("c_custkey").cast("string")
    user = F.concat(F.lit("{'id': 'user_"), key, F.lit("', "))
    kinds = [
        F.to_json(F.struct(F.concat(F.lit("user_"), key).alias("id"), F.concat(F.lit("it's "), name).alias("note"))),
        F.concat(user, F.lit("'note': \"it's "), name, F.lit("\", 'more': {'a': [None, True]}}")),
        F.concat(user, F.lit("'note': 'O'Neil: \""), name, F.lit("\", ok'}")),
        F.lit("{'id': None, 'note': 'None, True: {x}', 'even': False}"),
        F.concat(user, F.lit("'note': 'it's cut")),
        F.when(F.expr("c_custkey % 12 = 5"), F.lit(" ")).otherwise(F.lit("no object")),
    ]
    text = F.lit(None).cast("string")
    for i, kind in enumerate(kinds):
        text = F.when(F.col("c_custkey") % 6 == i, kind).otherwise(text)
    rows = c.table("customer").select("c_custkey", text.alias("t"))
    return repair.read_objects(rows, "t", ["id", "note"], "found")


@query(
    "json_repair_fields",
    f"SELECT c_custkey, {', '.join(f'{x} AS {n}' for n, x in REPAIR.items())} FROM customer",
)
def json_repair_fields(c: Crm) -> DataFrame:
    return repair_input(c).select(
        "c_custkey", F.col("found.id").alias("user_id"), "found.note", "found.how"
    )


@query(
    "json_repair_counts",
    "SELECT count(*) AS n_rows, "
    + ", ".join(
        f"count(*) FILTER (how = '{w}') AS n_{w}" for w in ("blank", "parsed", "repaired", "by_field", "failed")
    )
    + f" FROM (SELECT {REPAIR['how']} AS how FROM customer)",
)
def json_repair_counts(c: Crm) -> DataFrame:
    """The failure count of a feed, and how the rest was read."""
    return repair.repair_profile(repair_input(c), "found")


@query(
    "json_repair",
    """SELECT c_custkey, 'user_' || CAST(c_custkey AS VARCHAR) AS user_id,
              CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment, c_custkey % 2 = 0 AS is_even,
              c_custkey % 10 = 3 AS is_unreadable FROM customer
       WHERE c_custkey % 10 <> 3
       UNION ALL SELECT c_custkey, NULL, NULL, NULL, TRUE FROM customer WHERE c_custkey % 10 = 3""",
)
def json_repair(c: Crm) -> DataFrame:
    """Python-style object text parsed; text broken beyond repair is marked."""
    text = F.expr(
        "concat('{\\'id\\': \\'user_', c_custkey, '\\', \\'segment\\': ', "
        "if(c_custkey % 7 <> 0, concat('\\'', c_mktsegment, '\\''), 'None'), ', \\'even\\': ', "
        "if(c_custkey % 2 = 0, 'True', 'False'), if(c_custkey % 10 = 3, '', '}'))"
    )
    rows = c.table("customer").select("c_custkey", text.alias("t"))
    parsed = rows.select("c_custkey", repair.repair_json("t").alias("d"))
    return parsed.select(
        "c_custkey",
        documents.text("d", "id").alias("user_id"),
        documents.text("d", "segment").alias("segment"),
        F.try_variant_get("d", "$.even", "boolean").alias("is_even"),
        F.col("d").isNull().alias("is_unreadable"),
    )


# --- dynamic fields and joins -------------------------------------------------------


FIELD_TEXTS = """SELECT activity_id, lead_id, triage_outcome, prospecting_outcome, strategy_outcome, offer_presented,
              setter_field AS setter_user_id, closer_field AS closer_user_id FROM amounts"""


@query("dynamic_field_extract", FIELD_TEXTS)
def dynamic_field_extract(c: Crm) -> DataFrame:
    names = [*gold.TEXT_FIELDS[:4], *gold.ROLE_FIELDS]
    return fields.read_fields(c.events, "activity", ["activity_id", "lead_id"], c.field_map, names)


def padded(c: Crm) -> DataFrame:
    """The field mapping with so many more active rows that it is joined, not projected."""
    more = c.spark.range(20_000).selectExpr(
        "concat('cf_more_', id) AS custom_field_id", "'triage_outcome' AS canonical_field_name",
        "true AS is_active",
    )
    return c.field_map.unionByName(more, allowMissingColumns=True)


@query("large_mapping_extract", FIELD_TEXTS)
def large_mapping_extract(c: Crm) -> DataFrame:
    """The same fields through a mapping of 20,000 rows more."""
    names, keep = [*gold.TEXT_FIELDS[:4], *gold.ROLE_FIELDS], ["activity_id", "lead_id"]
    return fields.read_fields(c.events, "activity", keep, padded(c), names)


FIELDS_HELD = """SELECT activity_id, canonical_field_name, count(*) AS n FROM (
         SELECT a.activity_id, m.canonical_field_name FROM custom a
         LEFT JOIN (SELECT f.activity_id, f.lead_id, x.canonical_field_name FROM field_rows f
                    JOIN fields x ON x.custom_field_id = f.custom_field_id AND x.is_active) m
           ON a.activity_id = m.activity_id AND a.lead_id IS NOT DISTINCT FROM m.lead_id) GROUP BY ALL"""


@query("join_key_presence", FIELDS_HELD)
def join_key_presence(c: Crm) -> DataFrame:
    """Each event with every mapped field it holds; bare events stay, with NULL."""
    long = fields.explode_mapped_fields(c.events, "activity", ["activity_id"], c.field_map)
    return long.groupBy("activity_id", "canonical_field_name").agg(F.count("*").alias("n"))


@query("large_mapping_presence", FIELDS_HELD)
def large_mapping_presence(c: Crm) -> DataFrame:
    long = fields.explode_mapped_fields(c.events, "activity", ["activity_id"], padded(c))
    return long.groupBy("activity_id", "canonical_field_name").agg(F.count("*").alias("n"))


FUNNEL_TEXT = "triage_outcome, prospecting_outcome, strategy_outcome, offer_presented"


@query(
    "funnel_events_pivot",
    f"""SELECT lead_id, activity_id, {FUNNEL_TEXT}, coalesce(setter_field, user_id) AS setter_user_id,
               coalesce(closer_field, user_id) AS closer_user_id FROM amounts""",
)
def funnel_events_pivot(c: Crm) -> DataFrame:
    """Long field rows folded back to one column per name."""
    keys = ["lead_id", "activity_id", "user_id"]
    long = fields.explode_mapped_fields(c.events, "activity", keys, c.field_map)
    wide = gold.pivot_fields(long, keys, [*gold.TEXT_FIELDS[:4], *gold.ROLE_FIELDS])
    filled = {r: F.coalesce(r, "user_id") for r in gold.ROLE_FIELDS}
    return wide.withColumns(filled).drop("user_id")


@query(
    "funnel_events",
    f"""SELECT lead_id, activity_id, custom_activity_type_id, activity_at, activity_updated_at, user_id,
               funnel_source, funnel_stage, {FUNNEL_TEXT}, objections_faced,
               CAST(contract_value AS DOUBLE) AS contract_value, CAST(cash_collected AS DOUBLE) AS cash_collected,
               setter_user_id, closer_user_id FROM fe""",
)
def funnel_events(c: Crm) -> DataFrame:
    return gold.latest_funnel_events(c.activities, c.types, c.field_map)


@query(
    "join_type_map",
    """SELECT t.custom_activity_type_name, t.funnel_stage, count(*) AS n
       FROM custom a JOIN types t ON a.custom_activity_type_id = t.custom_activity_type_id GROUP BY ALL""",
)
def join_type_map(c: Crm) -> DataFrame:
    joined = c.events.join(c.types, "custom_activity_type_id")
    return joined.groupBy("custom_activity_type_name", "funnel_stage").agg(F.count("*").alias("n"))


ASOF_SQL = """
SELECT i.event_id, i.user_id, i.ts, s.event_id AS next_event_id, s.ts AS next_ts FROM
  (SELECT event_id, user_id, date_trunc('hour', ts) AS ts FROM events WHERE event_type = 'view') i
  LEFT JOIN (SELECT event_id, user_id, date_trunc('hour', ts) AS ts FROM events WHERE event_type = 'click') s
  ON s.user_id = i.user_id AND s.ts >= i.ts
QUALIFY row_number() OVER (PARTITION BY i.event_id ORDER BY s.ts NULLS LAST, s.event_id NULLS LAST) = 1"""


def _asof(c: Crm, **options) -> DataFrame:
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    rows = c.table("events").select("event_id", "user_id", "event_type", hour.alias("ts"))
    step = ("next", F.col("event_type") == "click", [])
    matched = gold.first_at_or_after(rows, "user_id", "ts", "event_id", [step], **options)
    return matched.where("event_type = 'view'").select(
        "event_id",
        "user_id",
        "ts",
        F.col("next.event_id").alias("next_event_id"),
        F.col("next.ts").alias("next_ts"),
    )


@query("asof_first_after", ASOF_SQL)
def asof_first_after(c: Crm) -> DataFrame:
    """First click at or after each view of a user; times cut to hours give many ties."""
    return _asof(c)


@query("asof_heavy_keys", ASOF_SQL)
def asof_heavy_keys(c: Crm) -> DataFrame:
    """The same with users above a low row limit taking the split form."""
    return _asof(c, max_rows=70)


FACT = (
    "lead_funnel_id, lead_id, funnel_source, initial_activity_id, initial_activity_type_id, initial_at, "
    "setter_user_id, initial_outcome, strategy_activity_id, strategy_activity_type_id, strategy_at, "
    "closer_user_id, strategy_outcome, offer_presented, objections_faced, sale_activity_id, "
    "sale_activity_type_id, sale_at, CAST(contract_value AS DOUBLE) AS contract_value, "
    "CAST(cash_collected AS DOUBLE) AS cash_collected, path_category"
)


@query("fact_lead_funnel", f"SELECT {FACT} FROM fact")
def fact_lead_funnel(c: Crm) -> DataFrame:
    return c.paths


@query("fact_lead_funnel_heavy", f"SELECT {FACT} FROM fact")
def fact_lead_funnel_heavy(c: Crm) -> DataFrame:
    """Funnel paths with every larger lead taking the split form."""
    return gold.funnel_paths(c.narrow, max_rows=40)


@query(
    "funnel_path",
    """SELECT lead_id, initial_activity_id, strategy_activity_id, sale_activity_id, path_category FROM fact""",
)
def funnel_path(c: Crm) -> DataFrame:
    return c.paths.select(
        "lead_id",
        "initial_activity_id",
        "strategy_activity_id",
        "sale_activity_id",
        "path_category",
    )


@query(
    "orphan_events",
    """SELECT 'strategy_without_prior_initial' AS orphan_type, count(*) AS event_count, count(DISTINCT lead_id) AS lead_count
       FROM fe s WHERE funnel_stage = 'strategy' AND NOT EXISTS (SELECT 1 FROM fe i
         WHERE i.funnel_stage = 'initial_contact' AND i.lead_id = s.lead_id AND i.activity_at <= s.activity_at)
       UNION ALL
       SELECT 'sale_without_prior_strategy', count(*), count(DISTINCT lead_id)
       FROM fe s WHERE funnel_stage = 'sale' AND NOT EXISTS (SELECT 1 FROM fe i
         WHERE i.funnel_stage = 'strategy' AND i.lead_id = s.lead_id AND i.activity_at <= s.activity_at)""",
)
def orphan_events(c: Crm) -> DataFrame:
    return profile.orphan_events(c.narrow)


@query(
    "join_dim_left",
    """SELECT o_custkey AS setter_user_id, n, c_name AS setter_name, c_mktsegment AS setter_email
       FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o
       LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON o.o_custkey = c.c_custkey""",
)
def join_dim_left(c: Crm) -> DataFrame:
    counts = c.table("orders").groupBy(F.col("o_custkey").alias("setter_user_id")).agg(
        F.count("*").alias("n")
    )
    people = c.table("customer").where("c_custkey % 3 <> 0").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("email"),
    )
    return reports.with_person(counts, people, "setter")


@query(
    "join_outcome_roles",
    """SELECT lead_funnel_id, initial_outcome, strategy_outcome, initial_is_set, strategy_is_taken FROM inbound_paths""",
)
def join_outcome_roles(c: Crm) -> DataFrame:
    paths = c.paths.where("funnel_source = 'inbound'")
    paths = reports.with_outcome(
        paths, c.outcomes, "triage_outcome", "initial_outcome", {"is_set": "initial_is_set"}
    )
    paths = reports.with_outcome(
        paths, c.outcomes, "strategy_outcome", "strategy_outcome", {"is_taken": "strategy_is_taken"}
    )
    return paths.select(
        "lead_funnel_id",
        "initial_outcome",
        "strategy_outcome",
        "initial_is_set",
        "strategy_is_taken",
    )


@query(
    "join_case_insensitive",
    "SELECT lead_funnel_id, source_objection_value, objection_category FROM objection_rows",
)
def join_case_insensitive(c: Crm) -> DataFrame:
    return gold.fact_objection(c.paths, c.categories).select(
        "lead_funnel_id", "source_objection_value", "objection_category"
    )


COMBINED = (
    "CAST(report_date AS VARCHAR) AS report_date, setter_user_id, lead_id, has_calendar_booking, has_sms_booking, "
    "has_triage_conclusion, has_triage_set, strategy_calls_booked, strategy_calls_taken, offers_presented, "
    "total_sales, CAST(total_contract_value AS DOUBLE) AS total_contract_value, "
    "CAST(total_cash_collected AS DOUBLE) AS total_cash_collected"
)


@query("full_outer_evidence", f"SELECT {COMBINED} FROM combined")
def full_outer_evidence(c: Crm) -> DataFrame:
    return reports.combine_evidence(
        reports.booking_evidence(c.activities), reports.triage_conclusions(c.paths, c.outcomes)
    )


@query(
    "evidence_flags",
    "SELECT CAST(report_date AS VARCHAR) AS report_date, setter_user_id, lead_id, has_calendar_booking, "
    "has_sms_booking FROM evidence",
)
def evidence_flags(c: Crm) -> DataFrame:
    return reports.booking_evidence(c.activities)


@query(
    "sale_source_compare",
    f"""WITH x AS (SELECT * FROM amounts),
        ss AS (SELECT lead_id, activity_id AS a FROM x WHERE custom_activity_type_id = '{crm.STRATEGY}' AND strategy_outcome = '6. Sale'),
        ns AS (SELECT lead_id, activity_id AS b, contract_value, cash_collected FROM x
               WHERE custom_activity_type_id IN ('{crm.SALE}', '{crm.SALE_PLAN}')),
        l AS (SELECT coalesce(ss.lead_id, ns.lead_id) AS lead_id, count(DISTINCT a) AS m, count(DISTINCT b) AS n,
                     sum(contract_value) AS cv, sum(cash_collected) AS cc
              FROM ss FULL OUTER JOIN ns ON ss.lead_id = ns.lead_id GROUP BY 1)
        SELECT CASE WHEN m > 0 AND n > 0 THEN 'strategy_sale_and_new_sale' WHEN m > 0 THEN 'strategy_sale_only'
                    WHEN n > 0 THEN 'new_sale_only' ELSE 'neither' END AS sale_match_category,
               count(*) AS lead_count, CAST(sum(m) AS BIGINT) AS strategy_sale_activity_count,
               CAST(sum(n) AS BIGINT) AS new_sale_activity_count,
               {money('cv')} AS total_contract_value, {money('cc')} AS total_cash_collected
        FROM l GROUP BY 1""",
)
def sale_source_compare(c: Crm) -> DataFrame:
    return profile.sale_source_compare(
        c.events,
        crm.STRATEGY,
        crm.field_ids("strategy_outcome")[0],
        "6. Sale",
        [crm.SALE, crm.SALE_PLAN],
        crm.CONTRACT_FIELD,
        crm.CASH_FIELD,
    )


DRIFT = "count(DISTINCT lead_id) AS distinct_lead_count, min(activity_at) AS first_seen_at, max(activity_at) AS latest_seen_at"


@query(
    "audit_types",
    f"""SELECT a.custom_activity_type_id, count(*) AS event_count, {DRIFT} FROM custom a
        LEFT JOIN types t ON t.custom_activity_type_id = a.custom_activity_type_id AND t.is_active
        WHERE t.custom_activity_type_id IS NULL GROUP BY 1""",
)
def audit_types(c: Crm) -> DataFrame:
    return audit.unmapped_activity_types(c.events, c.types)


@query(
    "audit_fields",
    f"""SELECT f.custom_field_id, 'custom.' || f.custom_field_id AS raw_activity_key, count(*) AS field_occurrence_count,
               count(DISTINCT activity_id) AS distinct_activity_count, {DRIFT}
        FROM field_rows f LEFT JOIN fields m ON m.custom_field_id = f.custom_field_id AND m.is_active
        WHERE m.custom_field_id IS NULL GROUP BY 1""",
)
def audit_fields(c: Crm) -> DataFrame:
    return audit.unmapped_fields(c.events, c.field_map)


OBSERVED = (
    "(SELECT m.custom_field_name AS field_name, f.field_value AS raw_value, f.lead_id, f.activity_id, f.activity_at "
    "FROM field_rows f JOIN fields m ON m.custom_field_id = f.custom_field_id "
    "WHERE m.is_active AND m.field_role = 'outcome' AND f.field_value <> '') o"
)


@query(
    "audit_outcomes",
    f"""SELECT o.field_name, o.raw_value, count(*) AS outcome_occurrence_count,
               count(DISTINCT activity_id) AS distinct_activity_count, {DRIFT}
        FROM {OBSERVED} LEFT JOIN outcomes x ON x.field_name = o.field_name AND x.raw_value = o.raw_value
        WHERE x.raw_value IS NULL GROUP BY 1, 2""",
)
def audit_outcomes(c: Crm) -> DataFrame:
    return audit.unmapped_outcomes(c.events, c.field_map, c.outcomes)


@query(
    "anti_unmapped_priorities",
    """SELECT o_orderpriority, count(*) AS n FROM orders
       WHERE o_orderpriority NOT IN (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority < '3') GROUP BY 1""",
)
def anti_unmapped_priorities(c: Crm) -> DataFrame:
    orders = c.table("orders")
    known = orders.where("o_orderpriority < '3'").select("o_orderpriority")
    left = audit.unmapped(orders, known, ["o_orderpriority"])
    return left.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


# --- dimensions and stage facts -----------------------------------------------------


@query(
    "dim_lead",
    f"SELECT {LEAD_COLUMNS}, source_file_name, source_row_number, insert_date FROM leads",
)
def dim_lead(c: Crm) -> DataFrame:
    return gold.dim_lead(c.leads).drop(
        "raw_data", "bronze_loaded_at", "load_date", "created_by_user_id", "updated_by_user_id"
    )


@query(
    "dim_user",
    """SELECT user_id, email, first_name, last_name, full_name, last_used_timezone, user_created_at,
              user_updated_at, source_file_name, source_row_number, insert_date FROM users""",
)
def dim_user(c: Crm) -> DataFrame:
    return c.users.drop("user_object_text", "bronze_loaded_at")


@query(
    "dim_date",
    """SELECT CAST(d AS VARCHAR) AS date_day, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
              day(d) AS day_of_month, isodow(d) - 1 AS day_of_week, weekofyear(d) AS week_of_year,
              CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start
       FROM (SELECT CAST(unnest(range(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) + INTERVAL 1 DAY,
                    INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
)
def dim_date(c: Crm) -> DataFrame:
    days = c.table("orders").select(F.to_date("o_orderdate").alias("day"))
    return gold.dim_date(days, "day")


@query(
    "dim_activity_type",
    """SELECT t.custom_activity_type_id, t.custom_activity_type_name, t.funnel_source, t.funnel_stage,
              t.is_revenue_event, count(a.activity_id) AS event_count FROM types t
       LEFT JOIN custom a ON a.custom_activity_type_id = t.custom_activity_type_id WHERE t.is_active GROUP BY ALL""",
)
def dim_activity_type(c: Crm) -> DataFrame:
    counts = profile.custom_type_counts(c.events)
    joined = gold.dim_activity_type(c.types).join(counts, "custom_activity_type_id", "left")
    return joined.withColumn("event_count", F.coalesce("event_count", F.lit(0)))


@query(
    "dim_outcome",
    """SELECT o.canonical_field_name, o.raw_value, o.outcome_category,
              md5(o.canonical_field_name || '|' || o.raw_value) AS outcome_id, count(f.lead_funnel_id) AS path_count
       FROM outcomes o LEFT JOIN fact f ON o.canonical_field_name = 'strategy_outcome' AND f.strategy_outcome = o.raw_value
       GROUP BY ALL""",
)
def dim_outcome(c: Crm) -> DataFrame:
    counts = c.paths.groupBy(F.col("strategy_outcome").alias("raw_value")).agg(
        F.lit("strategy_outcome").alias("canonical_field_name"), F.count("*").alias("n")
    )
    outcomes = gold.dim_outcome(c.outcomes)
    joined = outcomes.join(counts, ["canonical_field_name", "raw_value"], "left")
    return joined.select(
        "canonical_field_name",
        "raw_value",
        "outcome_category",
        "outcome_id",
        F.coalesce("n", F.lit(0)).alias("path_count"),
    )


STAGE_WHERE = {
    "fact_triage_call": "funnel_stage = 'initial_contact' AND funnel_source = 'inbound'",
    "fact_outbound_prospecting": "funnel_stage = 'initial_contact' AND funnel_source = 'outbound'",
    "fact_strategy_call": "funnel_stage = 'strategy'",
    "fact_sale": "funnel_stage = 'sale'",
}
SALE_FLAGS = (
    "contract_value IS NULL AS is_contract_value_missing, coalesce(contract_value = 0, FALSE) AS is_contract_value_zero, "
    "cash_collected IS NULL AS is_cash_collected_missing, coalesce(cash_collected = 0, FALSE) AS is_cash_collected_zero"
)
NO_FLAGS = (
    "CAST(NULL AS BOOLEAN) AS is_contract_value_missing, CAST(NULL AS BOOLEAN) AS is_contract_value_zero, "
    "CAST(NULL AS BOOLEAN) AS is_cash_collected_missing, CAST(NULL AS BOOLEAN) AS is_cash_collected_zero"
)


@query(
    "fact_by_stage",
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS fact_name, lead_id, activity_id, setter_user_id, closer_user_id, "
        f"{SALE_FLAGS if n == 'fact_sale' else NO_FLAGS} FROM fe WHERE {w}"
        for n, w in STAGE_WHERE.items()
    ),
)
def fact_by_stage(c: Crm) -> DataFrame:
    """The four stage facts, stacked."""
    result = None
    for name in gold.STAGE_FACTS:
        rows = gold.stage_fact(c.narrow, name).withColumn("fact_name", F.lit(name))
        result = rows if result is None else result.unionByName(rows, allowMissingColumns=True)
    flags = [x for x in result.columns if x.startswith("is_")]
    return result.select(
        "fact_name", "lead_id", "activity_id", "setter_user_id", "closer_user_id", *flags
    )


@query(
    "fact_objection",
    """SELECT lead_funnel_id, lead_id, strategy_activity_id, CAST(report_date AS VARCHAR) AS report_date, strategy_at,
              closer_user_id, source_objection_value, objection_category FROM objection_rows""",
)
def fact_objection(c: Crm) -> DataFrame:
    return gold.fact_objection(c.paths, c.categories)


# --- reports ------------------------------------------------------------------------

INBOUND = (
    "CAST(report_date AS VARCHAR) AS report_date, setter_user_id, setter_name, setter_email, inbound_booked, "
    "inbound_taken, triage_set, strategy_calls_booked, strategy_calls_taken, offers_presented, total_sales, "
    "CAST(total_contract_value AS DOUBLE) AS total_contract_value, "
    "CAST(total_cash_collected AS DOUBLE) AS total_cash_collected, show_rate, triage_set_rate, offer_rate, "
    "sale_rate, average_order_value"
)
OUTBOUND = (
    "CAST(report_date AS VARCHAR) AS report_date, setter_user_id, setter_name, setter_email, "
    "total_outbound_calls, unique_leads_touched, outbound_set, strategy_calls_booked, total_closer_show, "
    "total_sales, CAST(total_contract_value AS DOUBLE) AS total_contract_value, "
    "CAST(total_cash_collected AS DOUBLE) AS total_cash_collected, dial_to_set_rate, set_to_show_rate, "
    "show_to_sale_rate, average_order_value"
)
CLOSER = (
    "CAST(report_date AS VARCHAR) AS report_date, closer_user_id, closer_name, closer_email, calls_booked, "
    "admin_cancellations, nurture_cancellations, not_interested_cancellations, no_shows, shows, lost_deals, "
    "sales, CAST(total_contract_value AS DOUBLE) AS total_contract_value, "
    "CAST(total_cash_collected AS DOUBLE) AS total_cash_collected, show_rate, show_to_sale_rate, "
    "average_contract_value"
)
OBJECTIONS = (
    "CAST(report_date AS VARCHAR) AS report_date, objection_category, objection_count, "
    "distinct_strategy_call_count, distinct_lead_count, strategy_calls_evaluated, strategy_call_percentage"
)


@query("rpt_inbound", f"SELECT {INBOUND} FROM inbound")
def rpt_inbound(c: Crm) -> DataFrame:
    return c.inbound()


@query("rpt_outbound", f"SELECT {OUTBOUND} FROM outbound")
def rpt_outbound(c: Crm) -> DataFrame:
    return c.outbound()


@query("rpt_closer", f"SELECT {CLOSER} FROM closer")
def rpt_closer(c: Crm) -> DataFrame:
    return c.closer()


@query("rpt_objections", f"SELECT {OBJECTIONS} FROM objections_report")
def rpt_objections(c: Crm) -> DataFrame:
    return c.objections()


# --- quality and reconciliation -----------------------------------------------------


@query(
    "dq_column_tests",
    """SELECT * FROM (
         SELECT 'silver_custom_activity_events' AS table_name, 'activity_id' AS column_name, 'not_null' AS test_name,
                count(*) FILTER (WHERE activity_id IS NULL) AS failures FROM custom
         UNION ALL SELECT 'silver_custom_activity_events', 'lead_id', 'not_null', count(*) FILTER (WHERE lead_id IS NULL) FROM custom
         UNION ALL SELECT 'silver_custom_activity_events', 'custom_activity_type_id', 'not_null',
                          count(*) FILTER (WHERE custom_activity_type_id IS NULL) FROM custom
         UNION ALL SELECT 'silver_custom_activity_events', 'row_number_latest', 'not_null', 0
         UNION ALL SELECT 'silver_custom_activity_events', 'activity', 'not_null', 0
         UNION ALL SELECT 'dim_user', 'user_id', 'not_null', count(*) FILTER (WHERE user_id IS NULL) FROM users
         UNION ALL SELECT 'dim_user', 'user_id', 'unique', count(*) - count(DISTINCT user_id) FROM users
         UNION ALL SELECT 'stg_bronze__leads_raw', 'lead_id', 'not_null', count(*) FILTER (WHERE lead_id IS NULL) FROM lead_rows
         UNION ALL SELECT 'stg_bronze__leads_raw', 'source_file_name', 'not_null', 0
         UNION ALL SELECT 'stg_bronze__leads_raw', 'source_row_number', 'not_null', 0
         UNION ALL SELECT 'stg_bronze__leads_raw', 'raw_data', 'not_null', 0
         UNION ALL SELECT 'audit_unmapped_custom_activity_types', 'custom_activity_type_id', 'not_null',
                          count(DISTINCT 1) FROM custom WHERE custom_activity_type_id IS NULL
         UNION ALL SELECT 'audit_unmapped_custom_activity_types', 'custom_activity_type_id', 'unique', 0
         UNION ALL SELECT 'custom_activity_type_map', column_name, test_name, 0 FROM (VALUES
            ('custom_activity_type_id', 'not_null'), ('custom_activity_type_name', 'not_null'), ('is_active', 'not_null'),
            ('funnel_stage', 'accepted_values'), ('custom_activity_type_id', 'unique')) k(column_name, test_name))""",
)
def dq_column_tests(c: Crm) -> DataFrame:
    return quality.check_tables(
        {
            "silver_custom_activity_events": c.stored_events,
            "dim_user": c.users,
            "stg_bronze__leads_raw": c.leads,
            "audit_unmapped_custom_activity_types": audit.unmapped_activity_types(
                c.stored_events, c.types
            ),
            "custom_activity_type_map": c.types,
        }
    )


@query(
    "dq_fact_unique",
    """SELECT 'fact_lead_funnel' AS table_name, c AS column_name, t AS test_name, n AS failures FROM (
         SELECT 'lead_funnel_id' AS c, 'not_null' AS t, count(*) FILTER (WHERE lead_funnel_id IS NULL) AS n FROM fact
         UNION ALL SELECT 'lead_id', 'not_null', count(*) FILTER (WHERE lead_id IS NULL) FROM fact
         UNION ALL SELECT 'initial_activity_id', 'not_null', count(*) FILTER (WHERE initial_activity_id IS NULL) FROM fact
         UNION ALL SELECT 'lead_funnel_id', 'unique', count(*) FROM (SELECT lead_funnel_id FROM fact
                          WHERE lead_funnel_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1))""",
)
def dq_fact_unique(c: Crm) -> DataFrame:
    return quality.check_tables({"fact_lead_funnel": c.paths})


#: Oracle tables of the constrained models, and columns that are never NULL there but are
#: not part of the flat oracle tables.
CONSTRAINED = {
    "stg_bronze__leads_raw": "lead_rows",
    "stg_bronze__lead_activities_raw": WRAPPERS,
    "stg_bronze__custom_activities_raw": "part",
    "stg_bronze__close_crm_users_raw": "user_rows",
    "silver_activities": "act",
    "silver_custom_activity_events": "custom",
    "dim_user": "users",
    "dim_lead": "leads",
    "fact_lead_funnel": "fact",
    "rpt_inbound_setter": "inbound",
    "rpt_outbound_setter": "outbound",
    "rpt_closer": "closer",
    "rpt_objections_faced": "objections_report",
    "audit_unmapped_custom_activity_types": f"({RAW_ORACLE['audit_types']}) t",
    "audit_unmapped_custom_fields": f"({RAW_ORACLE['audit_fields']}) t",
    "audit_unmapped_funnel_outcomes": f"({RAW_ORACLE['audit_outcomes']}) t",
    "custom_activity_type_map": "types",
    "custom_field_map": "fields",
    "funnel_outcome_map": "outcomes",
    "objection_category_map": "objection_map",
}
ALWAYS = {"raw_data", "source_file_name", "source_row_number", "activity_data", "activity", "row_number_latest"}


def _constraint_sql(name: str, rules: quality.Constraints) -> list[str]:
    table, out = CONSTRAINED[name], []
    head = f"SELECT '{name}' AS table_name, "
    for c in rules.not_null:
        failing = "FALSE" if c in ALWAYS else f"{c} IS NULL"
        out.append(f"{head}'{c}' AS column_name, 'not_null' AS test_name, count(*) FILTER (WHERE {failing}) AS failures FROM {table}")
    for c, allowed in rules.accepted.items():
        listed = ", ".join(f"'{x}'" for x in allowed)
        out.append(f"{head}'{c}', 'accepted_values', count(*) FILTER (WHERE {c} NOT IN ({listed})) FROM {table}")
    for c in rules.unique:
        out.append(
            f"{head}'{c}', 'unique', count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL "
            f"GROUP BY {c} HAVING count(*) > 1)"
        )
    return out


def all_models(c: Crm) -> dict[str, DataFrame]:
    """The 20 tables with constraints."""
    paths, events = c.stored_paths, c.stored_events
    return {
        "stg_bronze__leads_raw": c.leads,
        "stg_bronze__lead_activities_raw": c.wrappers,
        "stg_bronze__custom_activities_raw": c.metadata,
        "stg_bronze__close_crm_users_raw": c.staged_users,
        "silver_activities": c.activities,
        "silver_custom_activity_events": events,
        "dim_user": c.users,
        "dim_lead": gold.dim_lead(c.leads),
        "fact_lead_funnel": paths,
        "rpt_inbound_setter": c.inbound(paths),
        "rpt_outbound_setter": c.outbound(paths),
        "rpt_closer": c.closer(paths),
        "rpt_objections_faced": c.objections(paths),
        **audits(c),
        **c.seeds,
    }


def audits(c: Crm) -> dict[str, DataFrame]:
    events = c.stored_events
    return {
        "audit_unmapped_custom_activity_types": audit.unmapped_activity_types(events, c.types),
        "audit_unmapped_custom_fields": audit.unmapped_fields(events, c.field_map),
        "audit_unmapped_funnel_outcomes": audit.unmapped_outcomes(events, c.field_map, c.outcomes),
    }


@query(
    "dq_all_tables",
    "\nUNION ALL\n".join(
        part for name, rules in quality.CONSTRAINTS.items() for part in _constraint_sql(name, rules)
    ),
)
def dq_all_tables(c: Crm) -> DataFrame:
    """Every constraint of all 20 tables."""
    return quality.check_tables(all_models(c))


@query(
    "dq_gates",
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS gate, count(*) AS row_count, count(*) = 0 AS passed FROM {CONSTRAINED[name]}"
        for name in build.GATES
    ),
)
def dq_gates(c: Crm) -> DataFrame:
    """Both gates of a strict build."""
    found = audits(c)
    return quality.gate_results({name: found[name] for name in build.GATES})


@query(
    "dq_accepted_values",
    """SELECT 'orders' AS table_name, c AS column_name, t AS test_name, n AS failures FROM (
         SELECT 'o_orderstatus' AS c, 'accepted_values' AS t, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS n FROM orders
         UNION ALL SELECT 'o_custkey', 'unique', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))""",
)
def dq_accepted_values(c: Crm) -> DataFrame:
    rules = quality.Constraints(unique=("o_custkey",), accepted={"o_orderstatus": ("F", "O")})
    return quality.check_columns(c.table("orders"), "orders", rules)


@query(
    "dq_zero_rows",
    """SELECT 'audit_unmapped_custom_activity_types' AS check_name, count(*) > 0 AS has_rows
       FROM custom a LEFT JOIN types t ON t.custom_activity_type_id = a.custom_activity_type_id AND t.is_active
       WHERE t.custom_activity_type_id IS NULL
       UNION ALL SELECT 'dim_user_without_id', count(*) > 0 FROM users WHERE user_id IS NULL""",
)
def dq_zero_rows(c: Crm) -> DataFrame:
    checks = {
        "audit_unmapped_custom_activity_types": audit.unmapped_activity_types(c.events, c.types),
        "dim_user_without_id": c.users.where(F.col("user_id").isNull()),
    }
    parts = [
        df.agg(F.lit(name).alias("check_name"), (F.count("*") > 0).alias("has_rows"))
        for name, df in checks.items()
    ]
    return parts[0].unionByName(parts[1])


MONEY_PAIR = (
    "r.total_contract_value AS total_contract_value, f.total_contract_value AS fact_total_contract_value, "
    "r.total_cash_collected AS total_cash_collected, f.total_cash_collected AS fact_total_cash_collected"
)


def _reconcile(report: str, rows: str, where: str, counted: dict[str, str], extra_r="", extra_f="", head="") -> str:
    r = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in counted)
    f = ", ".join(f"{x} AS {c}" for c, x in counted.items())
    pairs = ", ".join(f"r.{c} AS {c}, f.{c} AS fact_{c}, r.{c} - f.{c} AS {c}_diff" for c in counted)
    return (
        f"SELECT r.{rows}{head}, {pairs}, {MONEY_PAIR} FROM (SELECT count(*) AS {rows}, {r}{extra_r}, "
        f"{money('total_contract_value')} AS total_contract_value, {money('total_cash_collected')} AS total_cash_collected "
        f"FROM {report}) r, (SELECT {f}{extra_f}, {money('contract_value')} AS total_contract_value, "
        f"{money('cash_collected')} AS total_cash_collected FROM fact WHERE {where}) f"
    )


@query(
    "reconcile_closer",
    _reconcile(
        "closer",
        "closer_count",
        "strategy_activity_id IS NOT NULL",
        {"calls_booked": "count(*)", "sales": "count(sale_activity_id)"},
    ),
)
def reconcile_closer(c: Crm) -> DataFrame:
    return quality.reconcile_closer(c.closer(c.stored_paths), c.stored_paths)


@query(
    "reconcile_inbound",
    _reconcile(
        "inbound",
        "setter_count",
        "funnel_source = 'inbound'",
        {
            "inbound_booked": "count(*)",
            "strategy_calls_booked": "count(strategy_activity_id)",
            "total_sales": "count(sale_activity_id)",
        },
    ),
)
def reconcile_inbound(c: Crm) -> DataFrame:
    return quality.reconcile_inbound(c.inbound(c.stored_paths), c.stored_paths)


@query(
    "reconcile_outbound",
    _reconcile(
        "outbound",
        "setter_count",
        "funnel_source = 'outbound'",
        {
            "total_outbound_calls": "count(*)",
            "strategy_calls_booked": "count(strategy_activity_id)",
            "total_sales": "count(sale_activity_id)",
        },
        ", CAST(sum(unique_leads_touched) AS BIGINT) AS summed_unique_leads_touched",
        ", count(DISTINCT lead_id) AS fact_distinct_leads_touched",
        ", r.summed_unique_leads_touched, f.fact_distinct_leads_touched",
    ),
)
def reconcile_outbound(c: Crm) -> DataFrame:
    return quality.reconcile_outbound(c.outbound(c.stored_paths), c.stored_paths)


@query(
    "reconcile_objections",
    """SELECT flattened_objection_count, distinct_strategy_calls_with_objections, report_objection_count,
              strategy_calls_evaluated, report_objection_count - flattened_objection_count AS objection_count_diff,
              strategy_calls_evaluated - distinct_strategy_calls_with_objections AS strategy_calls_evaluated_diff,
              0 AS evaluated_per_date_diff
       FROM (SELECT count(*) AS flattened_objection_count,
                    count(DISTINCT strategy_activity_id) AS distinct_strategy_calls_with_objections FROM mentions),
            (SELECT CAST(sum(objection_count) AS BIGINT) AS report_objection_count,
                    max(strategy_calls_evaluated) AS strategy_calls_evaluated FROM objections_report)""",
)
def reconcile_objections(c: Crm) -> DataFrame:
    return quality.reconcile_objections(c.objections(c.stored_paths), c.stored_paths)


@query(
    "layer_row_counts",
    f"""SELECT 'stg_bronze__leads_raw' AS model_name, count(*) AS row_count FROM lead_rows
        UNION ALL SELECT 'stg_bronze__lead_activities_raw', count(*) FROM {WRAPPERS}
        UNION ALL SELECT 'silver_activities', count(*) FROM act
        UNION ALL SELECT 'silver_custom_activity_events', count(*) FROM custom""",
)
def layer_row_counts(c: Crm) -> DataFrame:
    return quality.row_counts(
        {
            "stg_bronze__leads_raw": c.leads,
            "stg_bronze__lead_activities_raw": c.wrappers,
            "silver_activities": c.activities,
            "silver_custom_activity_events": c.events,
        }
    )


@query(
    "duplicate_keys",
    """SELECT lead_id, activity_id, count(*) AS duplicate_count, min(activity_at) AS first_activity_at,
              max(activity_at) AS latest_activity_at, min(activity_updated_at) AS first_date_updated,
              max(activity_updated_at) AS latest_date_updated FROM act GROUP BY 1, 2 HAVING count(*) > 1
       ORDER BY duplicate_count DESC, latest_date_updated DESC NULLS LAST, lead_id NULLS LAST, activity_id NULLS LAST LIMIT 50""",
)
def duplicate_keys(c: Crm) -> DataFrame:
    return profile.repeated_activities(c.activities)


@query(
    "duplicate_after_dedup",
    """SELECT lead_id, activity_id, count(*) AS duplicate_count FROM custom GROUP BY 1, 2 HAVING count(*) > 1 LIMIT 50""",
)
def duplicate_after_dedup(c: Crm) -> DataFrame:
    return quality.duplicate_keys(c.events, ["lead_id", "activity_id"])


@query(
    "dim_profile",
    """SELECT count(*) AS dim_lead_row_count, count(DISTINCT lead_id) AS distinct_lead_count,
              count(*) - count(DISTINCT lead_id) AS duplicate_lead_id_count,
              count(*) FILTER (WHERE lead_name IS NULL AND display_name IS NULL) AS missing_name_count,
              count(*) FILTER (WHERE status_label IS NULL) AS missing_status_label_count,
              min(lead_created_at) AS min_lead_created_at, max(lead_created_at) AS max_lead_created_at,
              min(lead_updated_at) AS min_lead_updated_at, max(lead_updated_at) AS max_lead_updated_at FROM leads""",
)
def dim_profile(c: Crm) -> DataFrame:
    return quality.lead_profile(gold.dim_lead(c.leads))


SUMMARY = f"""
SELECT funnel_source, path_category, count(*) AS path_count, count(DISTINCT lead_id) AS lead_count,
       count(DISTINCT initial_activity_id) AS initial_event_count,
       count(DISTINCT strategy_activity_id) AS strategy_event_count,
       count(DISTINCT sale_activity_id) AS sale_event_count,
       {money('contract_value')} AS total_contract_value, {money('cash_collected')} AS total_cash_collected,
       count(*) - count(DISTINCT lead_funnel_id) AS duplicate_funnel_id_count
FROM fact GROUP BY 1, 2"""


@query("funnel_summary", SUMMARY)
def funnel_summary(c: Crm) -> DataFrame:
    return quality.funnel_summary(c.paths)


ROLES = """(SELECT 'setter' AS role_name, setter_user_id AS user_id FROM fact WHERE setter_user_id LIKE 'user_%'
UNION ALL SELECT 'closer', closer_user_id FROM fact WHERE closer_user_id LIKE 'user_%') x"""


@query("role_unpivot", f"SELECT role_name, user_id, count(*) AS n FROM {ROLES} GROUP BY 1, 2")
def role_unpivot(c: Crm) -> DataFrame:
    roles = quality.unpivot_roles(c.paths, {"setter": "setter_user_id", "closer": "closer_user_id"})
    return roles.groupBy("role_name", "user_id").agg(F.count("*").alias("n"))


@query(
    "role_coverage",
    f"""SELECT 'dim_user_summary' AS result_type, CAST(NULL AS VARCHAR) AS role_name, count(*) AS populated_user_id_count,
               count(DISTINCT user_id) AS distinct_user_id_count, 0 AS unmatched_user_id_count FROM users
        UNION ALL SELECT 'fact_lead_funnel_role_coverage', role_name, count(*), count(DISTINCT x.user_id),
               count(*) - count(u.user_id) FROM {ROLES} LEFT JOIN users u ON x.user_id = u.user_id GROUP BY role_name""",
)
def role_coverage(c: Crm) -> DataFrame:
    return quality.role_coverage(c.paths, c.users)


# --- profiles -----------------------------------------------------------------------


@query(
    "activity_type_counts",
    """SELECT activity_type, count(*) AS raw_event_count, count(DISTINCT activity_id) AS distinct_activity_id_count,
              count(DISTINCT lead_id) AS distinct_lead_count, min(activity_at) AS first_activity_at,
              max(activity_at) AS latest_activity_at FROM act GROUP BY 1""",
)
def activity_type_counts(c: Crm) -> DataFrame:
    return profile.activity_type_counts(c.activities)


@query(
    "custom_type_counts",
    "SELECT custom_activity_type_id, count(*) AS event_count FROM custom GROUP BY 1",
)
def custom_type_counts(c: Crm) -> DataFrame:
    return profile.custom_type_counts(c.events)


@query(
    "multi_distinct",
    """SELECT l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts,
              count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1, 2""",
)
def multi_distinct(c: Crm) -> DataFrame:
    return c.table("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.countDistinct("l_orderkey").alias("orders"),
        F.countDistinct("l_partkey").alias("parts"),
        F.countDistinct("l_suppkey").alias("suppliers"),
    )


@query(
    "conditional_counts",
    """SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
              count(*) FILTER (WHERE l_discount > 0.05 AND l_linestatus = 'O') AS open_discounted,
              max(CASE WHEN l_quantity > 49 THEN 1 ELSE 0 END) AS has_bulk FROM lineitem GROUP BY 1""",
)
def conditional_counts(c: Crm) -> DataFrame:
    discounted = (F.col("l_discount") > 0.05) & (F.col("l_linestatus") == "O")
    return c.table("lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(discounted).alias("open_discounted"),
        F.max(values.flag(F.col("l_quantity") > 49)).alias("has_bulk"),
    )


@query(
    "duplicate_summary",
    """SELECT count(*) AS flattened_activity_rows, count(DISTINCT activity_id) AS distinct_activity_ids,
              count(DISTINCT lead_id || '|' || activity_id) AS distinct_lead_activity_keys,
              count(*) - count(DISTINCT lead_id || '|' || activity_id) AS duplicate_rows FROM act""",
)
def duplicate_summary(c: Crm) -> DataFrame:
    return profile.duplicate_summary(c.activities)


@query(
    "load_profile",
    f"""SELECT CAST(CAST({STAMP} AS DATE) AS VARCHAR) AS load_date, count(*) AS raw_batch_rows,
               CAST(sum(CASE WHEN v = 0 AND event_id % 97 = 0 THEN 0 WHEN v = 0 AND event_id % 7 = 0 THEN 2 ELSE 1 END)
                    AS BIGINT) AS flattened_activity_count FROM {WRAPPERS} GROUP BY 1""",
)
def load_profile(c: Crm) -> DataFrame:
    return profile.load_profile(c.wrappers)


@query(
    "date_range",
    """SELECT min(activity_at) AS min_activity_at, max(activity_at) AS max_activity_at,
              min(activity_updated_at) AS min_activity_updated_at, max(activity_updated_at) AS max_activity_updated_at
       FROM act""",
)
def date_range(c: Crm) -> DataFrame:
    return profile.date_range(c.activities)


@query(
    "discover_types",
    """SELECT a.*, n.custom_activity_type_name FROM (
         SELECT custom_activity_type_id, count(*) AS activity_count, count(DISTINCT lead_id) AS distinct_lead_count,
                min(activity_at) AS first_activity_at, max(activity_at) AS latest_activity_at FROM custom GROUP BY 1) a
       LEFT JOIN type_names n ON n.custom_activity_type_id = a.custom_activity_type_id""",
)
def discover_types(c: Crm) -> DataFrame:
    return profile.discover_types(c.events, c.metadata)


@query(
    "discover_fields",
    """SELECT a.*, n.custom_field_name, n.custom_field_type FROM (
         SELECT custom_activity_type_id, custom_field_id, count(*) AS populated_count,
                count(DISTINCT field_value) AS distinct_value_count FROM field_rows WHERE field_value <> '' GROUP BY 1, 2) a
       LEFT JOIN field_names n ON n.custom_field_id = a.custom_field_id""",
)
def discover_fields(c: Crm) -> DataFrame:
    return profile.discover_fields(c.events, c.metadata)


OUTCOME_FIELDS = {
    "Triage Call Outcome": (crm.TRIAGE, "triage_outcome"),
    "Strategy Call Outcome": (crm.STRATEGY, "strategy_outcome"),
    "Prospecting Call Outcome": (crm.PROSPECT, "prospecting_outcome"),
}


@query(
    "outcome_distribution",
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS field_name, coalesce(nullif({f}, ''), '[blank]') AS field_value, count(*) AS record_count "
        f"FROM custom WHERE custom_activity_type_id = '{t}' GROUP BY 2"
        for n, (t, f) in OUTCOME_FIELDS.items()
    ),
)
def outcome_distribution(c: Crm) -> DataFrame:
    ids = {n: (t, crm.field_ids(f)[0]) for n, (t, f) in OUTCOME_FIELDS.items()}
    return profile.outcome_distribution(c.events, ids)


@query(
    "objection_profile",
    f"""WITH raw AS (SELECT activity_id, lead_id, CASE WHEN json_type(objections) = 'ARRAY' THEN objections
                            ELSE json_extract_string(objections, '$') END AS t FROM custom
                     WHERE custom_activity_type_id IN ('{crm.STRATEGY}', '{crm.STRATEGY_FOLLOW}')),
        labels AS (SELECT activity_id, lead_id, trim(unnest(regexp_split_to_array(trim(replace(
                     regexp_replace(t, '^\\[|\\]$', '', 'g'), '"', '')), '\\s*,\\s*'))) AS label FROM raw WHERE t <> '')
        SELECT coalesce(m.normalized_objection_category, label) AS normalized_objection_category,
               label AS source_objection_value, count(*) AS objection_count,
               count(DISTINCT activity_id) AS distinct_activity_count, count(DISTINCT lead_id) AS distinct_lead_count
        FROM labels LEFT JOIN objection_map m ON lower(m.source_objection_value) = lower(label)
             AND m.source_objection_value <> 'No Show'
        WHERE label <> '' GROUP BY 1, 2""",
)
def objection_profile(c: Crm) -> DataFrame:
    return profile.objection_profile(
        c.events, [crm.STRATEGY, crm.STRATEGY_FOLLOW], crm.OBJECTIONS_FIELD, c.categories
    )


def _quality_counts() -> str:
    return ", ".join(
        [
            "count(*) AS revenue_event_count",
            "count(contract_text) AS populated_contract_value_raw_count",
            "count(cash_cents) AS populated_cash_collected_raw_count",
            "count(extra_cents) AS populated_additional_cash_raw_count",
            "count(contract_value) AS numeric_contract_value_count",
            "count(cash_collected) AS numeric_cash_collected_count",
            "count(additional_cash_collected) AS numeric_additional_cash_count",
            "count(*) FILTER (WHERE contract_value IS NULL AND contract_text IS NOT NULL) AS invalid_contract_value_count",
            "count(*) FILTER (WHERE cash_collected IS NULL AND cash_cents IS NOT NULL) AS invalid_cash_collected_count",
            "count(*) FILTER (WHERE contract_value = 0) AS zero_contract_value_count",
            "count(*) FILTER (WHERE cash_collected = 0) AS zero_cash_collected_count",
            "count(*) FILTER (WHERE contract_value < 0) AS negative_contract_value_count",
            "count(*) FILTER (WHERE cash_collected < 0) AS negative_cash_collected_count",
            f"{money('contract_value')} AS total_contract_value",
            f"{money('cash_collected')} AS total_cash_collected",
            f"{money('additional_cash_collected')} AS total_additional_cash_collected",
            f"{average('sum(contract_value)', 'count(contract_value)')} AS avg_contract_value",
            "CAST(min(contract_value) AS DOUBLE) AS min_contract_value",
            "CAST(max(contract_value) AS DOUBLE) AS max_contract_value",
            "CAST(min(cash_collected) AS DOUBLE) AS min_cash_collected",
            "CAST(max(cash_collected) AS DOUBLE) AS max_cash_collected",
        ]
    )


@query(
    "revenue_quality",
    f"""SELECT custom_activity_type_id, {_quality_counts()} FROM amounts
        WHERE custom_activity_type_id IN ('{crm.SALE}', '{crm.SALE_PLAN}', '{crm.BACKEND}', '{crm.EXTRA_CASH}') GROUP BY 1""",
)
def revenue_quality(c: Crm) -> DataFrame:
    ids = {
        "contract_value": crm.CONTRACT_FIELD,
        "cash_collected": crm.CASH_FIELD,
        "additional_cash_collected": crm.EXTRA_FIELD,
    }
    found = profile.revenue_quality(
        c.events, [crm.SALE, crm.SALE_PLAN, crm.BACKEND, crm.EXTRA_CASH], ids
    )
    return found.withColumn("avg_contract_value", F.round("avg_contract_value", 2))


ASSIGNED = """(SELECT 'setter' AS role_name, custom_activity_type_id, setter_a AS user_id FROM custom
UNION ALL SELECT 'closer', custom_activity_type_id, closer_a FROM custom) ra"""


@query(
    "assignment_coverage",
    f"""SELECT 'parsed_user_summary' AS result_type, CAST(NULL AS VARCHAR) AS role_name, CAST(NULL AS VARCHAR) AS role_field_name,
               CAST(NULL AS VARCHAR) AS custom_activity_type_id, count(*) AS populated_assignment_count,
               count(DISTINCT user_id) AS distinct_user_id_count, count(email) AS matched_assignment_count,
               CAST(NULL AS BIGINT) AS unmatched_assignment_count FROM users
        UNION ALL SELECT 'role_coverage', role_name, 'primary_' || role_name, custom_activity_type_id, count(*),
               count(DISTINCT ra.user_id), count(*) FILTER (WHERE u.user_id IS NOT NULL),
               count(*) FILTER (WHERE u.user_id IS NULL)
        FROM {ASSIGNED} LEFT JOIN users u ON ra.user_id = u.user_id
        WHERE ra.user_id LIKE 'user_%' GROUP BY role_name, custom_activity_type_id""",
)
def assignment_coverage(c: Crm) -> DataFrame:
    return profile.assignment_coverage(c.events, c.users, ROLE_FIELDS)


PROFILED = ["events", "orders", "customer", "part"]


@query(
    "schema_profile",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, CAST(row_number() OVER () AS INTEGER) AS ordinal_position, column_name, "
        f"\"null\" = 'YES' AS is_nullable, (SELECT count(*) FROM {t}) AS row_count "
        f"FROM (DESCRIBE SELECT * FROM {t})"
        for t in PROFILED
    ),
)
def schema_profile(c: Crm) -> DataFrame:
    """Columns of the tables, with the rows each table has."""
    tables = {n: c.table(n) for n in PROFILED}
    counts = quality.row_counts(tables, "table_name")
    return profile.schema_profile(tables).drop("data_type").join(counts, "table_name")


# --- dashboard ----------------------------------------------------------------------


def _all_reports(c: Crm) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    paths = c.stored_paths
    return c.inbound(paths), c.outbound(paths), c.closer(paths), c.objections(paths)


@query(
    "date_bounds",
    "SELECT CAST(min(d) AS VARCHAR) AS min_date, CAST(max(d) AS VARCHAR) AS max_date FROM ("
    + " UNION ALL ".join(f"SELECT report_date AS d FROM {t}" for t in ("inbound", "outbound", "closer", "objections_report"))
    + ")",
)
def date_bounds(c: Crm) -> DataFrame:
    return dashboard.date_bounds(*_all_reports(c))


@query(
    "filter_reports",
    f"""SELECT {OUTBOUND} FROM outbound WHERE report_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
        AND setter_name IN ('Customer 000000003', 'Customer 000000012')""",
)
def filter_reports(c: Crm) -> DataFrame:
    names = ["Customer 000000003", "Customer 000000012"]
    return dashboard.filter_report(
        c.outbound(), dt.date(2024, 1, 5), dt.date(2024, 1, 20), "setter_name", names
    )


@query(
    "selector_values",
    "SELECT DISTINCT closer_name FROM closer WHERE closer_name IS NOT NULL ORDER BY 1",
)
def selector_values(c: Crm) -> DataFrame:
    return dashboard.selector_values(c.closer(), "closer_name")


def _rate(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0), 0)"


def _sums(names: str, prefix: str = "") -> str:
    return ", ".join(f"coalesce(sum({n}), 0) AS {prefix}{n}" for n in names.split())


@query(
    "executive_kpis",
    f"""SELECT CAST(total_sales + o_total_sales AS BIGINT) AS total_sales,
          CAST(total_contract_value + o_total_contract_value AS DOUBLE) AS total_contract_value,
          CAST(total_cash_collected + o_total_cash_collected AS DOUBLE) AS total_cash_collected,
          {_rate('(total_cash_collected + o_total_cash_collected)', '(total_contract_value + o_total_contract_value)')} AS cash_collection_rate,
          {shown(*['int:' + n for n in 'inbound_booked inbound_taken triage_set total_outbound_calls outbound_set total_closer_show calls_booked shows no_shows sales'.split()])},
          {_rate('inbound_taken', 'inbound_booked')} AS inbound_show_rate,
          {_rate('triage_set', 'inbound_taken')} AS inbound_triage_set_rate,
          {_rate('outbound_set', 'total_outbound_calls')} AS outbound_dial_to_set_rate,
          {_rate('total_closer_show', 'outbound_set')} AS outbound_set_to_show_rate,
          {_rate('o_total_sales', 'total_closer_show')} AS outbound_show_to_sale_rate,
          {_rate('shows', 'calls_booked')} AS closer_show_rate, {_rate('sales', 'shows')} AS closer_close_rate
        FROM (SELECT {_sums('inbound_booked inbound_taken triage_set total_sales total_contract_value total_cash_collected')} FROM inbound),
             (SELECT {_sums('total_outbound_calls outbound_set total_closer_show')},
                     {_sums('total_sales total_contract_value total_cash_collected', 'o_')} FROM outbound),
             (SELECT {_sums('calls_booked shows no_shows sales')} FROM closer)""",
)
def executive_kpis(c: Crm) -> DataFrame:
    inbound, outbound, closer, _ = _all_reports(c)
    return dashboard.executive_kpis(inbound, outbound, closer)


@query(
    "top_objections",
    f"SELECT {OBJECTIONS} FROM objections_report ORDER BY objection_count DESC, objections_report.report_date DESC NULLS LAST, "
    "objection_category LIMIT 10",
)
def top_objections(c: Crm) -> DataFrame:
    return dashboard.top_objections(c.objections())


@query(
    "top_objection",
    "SELECT objection_category, CAST(sum(objection_count) AS BIGINT) AS objection_count FROM objections_report "
    "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
)
def top_objection(c: Crm) -> DataFrame:
    return dashboard.top_objection(c.objections())


@query(
    "objection_totals",
    "SELECT CAST(sum(objection_count) AS BIGINT) AS objection_count, CAST(sum(distinct_strategy_call_count) AS BIGINT) "
    "AS distinct_strategy_call_count, CAST(sum(distinct_lead_count) AS BIGINT) AS distinct_lead_count FROM objections_report",
)
def objection_totals(c: Crm) -> DataFrame:
    return dashboard.objection_totals(c.objections())


@query(
    "tile_scorecard",
    f"""SELECT CAST(sum(inbound_booked) AS BIGINT) AS inbound_booked, CAST(sum(triage_set) AS BIGINT) AS inbound_strategy_calls_set,
               CAST(sum(total_sales) AS BIGINT) AS inbound_sales, {money('total_cash_collected')} AS inbound_cash_collected FROM inbound""",
)
def tile_scorecard(c: Crm) -> DataFrame:
    return dashboard.tile_scorecard(c.inbound())


@query(
    "tile_inbound",
    """SELECT coalesce(setter_name, setter_user_id) AS setter, inbound_booked, inbound_taken, triage_set, strategy_calls_taken,
              total_sales, sale_rate, CAST(total_cash_collected AS DOUBLE) AS total_cash_collected FROM inbound""",
)
def tile_inbound(c: Crm) -> DataFrame:
    return dashboard.tile_inbound(c.inbound())


@query(
    "tile_outbound",
    """SELECT coalesce(setter_name, setter_user_id) AS setter, total_outbound_calls, unique_leads_touched, outbound_set,
              total_closer_show, total_sales, dial_to_set_rate, show_to_sale_rate FROM outbound""",
)
def tile_outbound(c: Crm) -> DataFrame:
    return dashboard.tile_outbound(c.outbound())


@query(
    "tile_closer",
    """SELECT coalesce(closer_name, closer_user_id) AS closer, calls_booked, shows, no_shows, lost_deals, sales, show_rate,
              show_to_sale_rate, CAST(total_cash_collected AS DOUBLE) AS total_cash_collected FROM closer""",
)
def tile_closer(c: Crm) -> DataFrame:
    return dashboard.tile_closer(c.closer())


@query(
    "tile_objections",
    "SELECT objection_category, objection_count, distinct_strategy_call_count, strategy_call_percentage FROM objections_report",
)
def tile_objections(c: Crm) -> DataFrame:
    return dashboard.tile_objections(c.objections())


@query(
    "tile_funnel",
    f"""SELECT funnel_source, path_category, count(*) AS path_count, count(DISTINCT lead_id) AS lead_count,
               {money('contract_value')} AS total_contract_value, {money('cash_collected')} AS total_cash_collected
        FROM fact GROUP BY 1, 2""",
)
def tile_funnel(c: Crm) -> DataFrame:
    return dashboard.tile_funnel(c.paths)


@query(
    "formatted_report",
    """SELECT CAST(report_date AS VARCHAR) AS report_date, objection_category, objection_count, distinct_strategy_call_count,
              distinct_lead_count, strategy_calls_evaluated,
              printf('%d.%d%%', t // 10, t % 10) AS strategy_call_percentage
       FROM (SELECT *, CAST(round_even(CAST(strategy_call_percentage * 10000 AS DECIMAL(18,1)) / 10, 0) AS BIGINT) AS t
             FROM objections_report)""",
)
def formatted_report(c: Crm) -> DataFrame:
    return dashboard.formatted(c.objections())


# --- changes and streaming ----------------------------------------------------------

CHANGED = "CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"


@query(
    "cdc_classify",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 AND o_orderkey % 13 = 0 THEN 'absent'
              WHEN o_orderkey % 11 = 0 THEN 'missing' WHEN o_orderkey % 13 = 0 THEN 'insert'
              WHEN o_orderkey % 7 = 0 THEN 'update' ELSE 'unchanged' END AS change_type
       FROM orders WHERE NOT (o_orderkey % 11 = 0 AND o_orderkey % 13 = 0)""",
)
def cdc_classify(c: Crm) -> DataFrame:
    orders = c.table("orders")
    before = orders.where("o_orderkey % 13 <> 0")
    after = orders.where("o_orderkey % 11 <> 0").withColumn("o_totalprice", F.expr(CHANGED))
    compared = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    found = changes.classify_changes(before, after, ["o_orderkey"], compared)
    return found.select("o_orderkey", "change_type")


def _snapshot_sql(price: str, present: str) -> str:
    key = "CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END"
    return (
        f"SELECT {key} AS order_key, o_orderkey AS version, {price} AS price, o_orderstatus FROM orders WHERE {present} "
        f"UNION ALL SELECT {key}, -1, o_totalprice + 5, o_orderstatus FROM orders "
        f"WHERE {present} AND o_orderkey % 5 = 0 AND o_orderkey % 97 <> 0"
    )


#: Versions of keys that come twice and of a NULL key; some repriced, new or missing.
SNAPSHOTS = {
    "before": _snapshot_sql("o_totalprice", "o_orderkey % 1753 <> 0"),
    "after": _snapshot_sql(
        "CASE WHEN o_orderkey % 1009 = 0 OR o_orderkey % 97 = 0 THEN o_totalprice + 1 ELSE o_totalprice END",
        "o_orderkey % 1511 <> 0",
    ),
}


@query(
    "cdc_snapshots",
    f"""WITH b AS (SELECT * FROM ({SNAPSHOTS["before"]}) QUALIFY row_number() OVER (PARTITION BY order_key ORDER BY version DESC) = 1),
             a AS (SELECT * FROM ({SNAPSHOTS["after"]}) QUALIFY row_number() OVER (PARTITION BY order_key ORDER BY version DESC) = 1)
        SELECT coalesce(a.order_key, b.order_key) AS order_key,
               CASE WHEN b.version IS NULL THEN 'insert' WHEN a.version IS NULL THEN 'missing' ELSE 'update' END AS change_type
        FROM b FULL OUTER JOIN a ON coalesce(a.order_key, -1) = coalesce(b.order_key, -1)
        WHERE a.version IS NULL OR b.version IS NULL OR a.price <> b.price""",
)
def cdc_snapshots(c: Crm) -> DataFrame:
    """Changes between two stored snapshots, read from the buckets that differ."""
    store = Store(c.spark, scratch(c.spark, "snapshots"))
    for name, text in SNAPSHOTS.items():
        rows = c.spark.sql(text.replace("FROM orders ", "FROM {orders} "), orders=c.table("orders"))
        snapshots.keep_snapshot(
            store, name, rows, ["order_key"], ["price", "o_orderstatus"], ["version"], buckets=32
        )
    return snapshots.snapshot_changes(store, "before", "after", ["version"])


@query(
    "upsert_latest",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
               CASE WHEN o_orderkey % 13 <> 0 THEN TIMESTAMP '2026-05-16 07:30:00' ELSE TIMESTAMP '2026-05-17 07:30:00' END AS insert_date,
               CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 13 = 0 THEN TIMESTAMP '2026-05-17 07:30:00'
                    ELSE TIMESTAMP '2026-05-16 07:30:00' END AS update_date,
               CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL '1' DAY ELSE o_orderdate END AS changed_at
        FROM orders""",
)
def upsert_latest(c: Crm) -> DataFrame:
    """A second delivery with changed and new orders merged into the first."""
    first, second = [F.lit(t).cast("timestamp_ntz") for t in crm.LOADS]
    orders = c.table("orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("changed_at"))
    current = orders.where("o_orderkey % 13 <> 0").withColumns({"insert_date": first, "update_date": first})
    incoming = orders.where("o_orderkey % 7 = 0 OR o_orderkey % 13 = 0").withColumns(
        {
            "o_totalprice": F.expr(CHANGED),
            "changed_at": F.expr(
                "if(o_orderkey % 7 = 0, changed_at + INTERVAL '1' DAY, changed_at)"
            ),
            "insert_date": second,
            "update_date": second,
        }
    )
    return changes.upsert_latest(current, incoming, ["o_orderkey"], ["changed_at"])


@query(
    "stored_upsert",
    """SELECT user_id, event_type, event_id, ts, value, props, insert_date, update_date FROM (
         SELECT *, min(d) OVER k AS insert_date, max(d) OVER k AS update_date,
                row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
         FROM (SELECT CASE WHEN user_id % 9 > 0 THEN user_id END AS user_id, event_type, event_id,
                      CASE WHEN event_id % 7 > 0 THEN date_trunc('hour', ts) END AS ts, value, props,
                      TIMESTAMP '2026-05-16 07:30:00' + INTERVAL 1 DAY * (event_id % 3) AS d FROM events)
         WINDOW k AS (PARTITION BY user_id, event_type)) WHERE rn = 1""",
)
def stored_upsert(c: Crm) -> DataFrame:
    """Three deliveries upserted into a stored table, one of them twice.

    Keys come again in other deliveries, some are NULL, and stamps tie or are missing.
    """
    store = Store(c.spark, scratch(c.spark, "upsert"))
    events = c.table("events").withColumns(
        {
            "user_id": F.expr("CASE WHEN user_id % 9 > 0 THEN user_id END"),
            "ts": F.expr("CASE WHEN event_id % 7 > 0 THEN CAST(date_trunc('hour', ts) AS TIMESTAMP_NTZ) END"),
        }
    )
    for batch, day in enumerate((1, 0, 2)):
        delivery = events.where(F.col("event_id") % 3 == day)
        for _ in range(2 if day == 0 else 1):
            incremental.upsert_batch(
                store,
                delivery,
                "events",
                batch,
                ["user_id", "event_type"],
                ["ts", "event_id"],
                crm.LOADS[0] + dt.timedelta(days=day),
                buckets=4,
            )
    return store.read(incremental.LATEST)


DAILY = {
    "rpt_inbound_setter": (
        "inbound", "setter_user_id", "inbound_booked", "inbound_taken", "triage_set", "total_sales",
        "total_contract_value", "total_cash_collected", "show_rate",
    ),
    "rpt_outbound_setter": (
        "outbound", "setter_user_id", "total_outbound_calls", "unique_leads_touched", "outbound_set", "total_sales",
        "total_contract_value", "total_cash_collected", "dial_to_set_rate",
    ),
    "rpt_closer": (
        "closer", "closer_user_id", "calls_booked", "no_shows", "shows", "sales",
        "total_contract_value", "total_cash_collected", "show_to_sale_rate",
    ),
    "rpt_objections_faced": (
        "objections_report", "objection_category", "objection_count", "distinct_strategy_call_count",
        "distinct_lead_count", "strategy_calls_evaluated", "NULL", "NULL", "strategy_call_percentage",
    ),
}
DAILY_NAMES = ["person", "n1", "n2", "n3", "n4", "contract_value", "cash_collected", "rate"]


def _daily_columns(columns: tuple[str, ...]) -> list[str]:
    kinds = ["VARCHAR", *["BIGINT"] * 4, *["DOUBLE"] * 3]
    return [
        f"CAST({c} AS {k}) AS {n}" for c, k, n in zip(columns, kinds, DAILY_NAMES, strict=True)
    ]


@query(
    "daily_loads",
    "\nUNION ALL\n".join(
        f"SELECT {way} AS way, '{report}' AS report, CAST(report_date AS VARCHAR) AS report_date, "
        f"{', '.join(_daily_columns(columns))} FROM {table}"
        for report, (table, *columns) in DAILY.items()
        for way in (1, 2)
    ),
)
def daily_loads(c: Crm) -> DataFrame:
    """Seven daily loads in two orders, kept load by load; both give the reports of one build.

    The second order takes several days at once where they have piled up, and one day again.
    """
    days = [stored(raw, "day") for _, raw in crm.daily_loads(c.spark, c.sf_dir)]
    ways = {1: [[d] for d in range(7)], 2: [[5, 0], [6, 3, 1], [2], [4, 0]]}

    def run(way: int) -> list[DataFrame]:
        store = Store(c.spark, scratch(c.spark, "daily"))
        for batch, load in enumerate(ways[way]):
            raw = days[load[0]]
            for day in load[1:]:
                raw = raw.unionByName(days[day])
            increments.apply_activities(store, raw, batch, c.seeds, buckets=4)
        for batch, load in enumerate(crm.LOADS):
            users = c.raw("close_crm_users_raw").where(F.col("load_date") == load.date())
            increments.apply_users(store, users, batch, buckets=2)
        found = []
        for report, (_, *columns) in DAILY.items():
            rows = increments.read_report(store, report)
            found.append(
                rows.select(
                    F.lit(way).alias("way"),
                    F.lit(report).alias("report"),
                    "report_date",
                    *[F.expr(x.replace("VARCHAR", "STRING")) for x in _daily_columns(columns)],
                )
            )
        return found

    with ThreadPoolExecutor(len(ways)) as pool:
        parts = [df for way in pool.map(run, ways) for df in way]
    return reduce(DataFrame.unionByName, parts)


@query(
    "stream_keep_latest",
    """SELECT user_id, event_type, event_id, ts, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""",
)
def stream_keep_latest(c: Crm) -> DataFrame:
    """Latest versions kept by a stream over two deliveries that arrive in turn."""
    base = scratch(c.spark, "stream")
    events = c.table("events").drop("props")
    keys, newest = ["user_id", "event_type"], ["ts", "event_id"]
    for rest in (1, 0):
        events.where(F.col("event_id") % 2 == rest).write.mode("append").parquet(f"{base}/in")
        stream = c.spark.readStream.schema(events.schema).parquet(f"{base}/in")
        incremental.keep_latest(
            c.spark, stream, f"{base}/out", f"{base}/checkpoint", keys, newest, buckets=4
        )
    return incremental.read_latest(c.spark, f"{base}/out")


__all__ = ["CTES", "MODELS", "ORACLE", "QUERIES", "Crm"]
