"""Profiles of raw records, activities and business fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelry.functions import documents, values
from funnelry.operators import fields
from funnelry.operators.skew import join_key_totals
from funnelry.plans.quality import row_counts, unpivot_roles

# Fixed patterns: how activity types and fields are written in the metadata text.
TYPE_ENTRY = r"'id': '(actitype_[^']+)'[^}]*?'name': '([^']*)'"
FIELD_ENTRY = r"'id': '(cf_[^']+)'[^}]*?'name': '([^']*)'[^}]*?'type': '([^']*)'"


# --- catalog and raw structure ------------------------------------------------------


def table_inventory(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database with their kind; the session's own views are in no database."""
    listed = spark.catalog.listTables(database)
    rows = [(database, t.name, t.tableType) for t in listed if t.tableType != "TEMPORARY"]
    return spark.createDataFrame(rows, "table_schema string, table_name string, table_type string")


def schema_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Position, name, type and nullability of every column."""
    rows = [
        (name, position, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for position, f in enumerate(df.schema, start=1)
    ]
    return next(iter(tables.values())).sparkSession.createDataFrame(
        rows,
        "table_name string, ordinal_position int, column_name string, data_type string, "
        "is_nullable boolean",
    )


def catalog_profile(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database with kind, columns, types and row counts.

    Columns come from the catalog; rows are counted from file footers, no column is read.
    """
    inventory = table_inventory(spark, database)
    tables = {r["table_name"]: spark.table(f"{database}.{r['table_name']}") for r in inventory.collect()}
    if not tables:
        return spark.createDataFrame(
            [],
            "table_name string, table_schema string, table_type string, ordinal_position int, "
            "column_name string, data_type string, is_nullable boolean, row_count bigint",
        )
    columns = schema_profile(tables)
    return inventory.join(columns, "table_name").join(row_counts(tables, "table_name"), "table_name")


def top_level_keys(
    raw: DataFrame, table: str, rows: int = 5, nested: str | None = None
) -> DataFrame:
    """Key list, document type and a short text sample of a few raw rows."""
    sample = raw.orderBy("insert_date", "source_file_name", "source_row_number").limit(rows)
    keys = F.array_sort(F.map_keys(documents.entries("raw_data")))
    columns = [
        F.lit(table).alias("table_name"),
        F.col("insert_date"),
        F.col("source_row_number"),
        documents.type_name("raw_data").alias("raw_data_type"),
        keys.alias("top_level_keys"),
    ]
    if nested == "data":
        data = documents.part("raw_data", "data")
        columns += [
            documents.type_name(data).alias("data_key_type"),
            F.array_size(documents.items(data)).alias("activity_count_in_row"),
        ]
    elif nested:
        text = documents.text("raw_data", nested)
        columns.append(F.left(text, F.lit(500)).alias("json_object_sample"))
    return sample.select(*columns)


def _paths(document: Column, prefix: str | Column, depth: int) -> Column:
    """Path and type of everything below a document, down to some levels, as an array."""
    nothing = F.array().cast("array<struct<path:string,type:string>>")

    def entry(path: Column, value: Column, below: str) -> Column:
        own = F.array(F.struct(path.alias("path"), documents.type_name(value).alias("type")))
        if depth == 1:
            return own
        return F.concat(own, _paths(value, F.concat(path, F.lit(below)), depth - 1))

    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    keys = F.transform(
        F.map_entries(documents.entries(document)),
        lambda e: entry(F.concat(head, e["key"]), e["value"], "."),
    )
    # Elements share one path: that of the array, with brackets in place of the last dot.
    bare = F.regexp_replace(head, r"\.$", "")
    items = F.transform(
        documents.items(document), lambda x: entry(F.concat(bare, F.lit("[]")), x, ".")
    )
    return F.coalesce(F.flatten(F.coalesce(keys, items)), nothing)


def document_shapes(raw_tables: dict[str, DataFrame], depth: int = 3) -> DataFrame:
    """How often each key path occurs with each type, nested keys included, in all feeds.

    ``a.b`` is a key of an object, ``a[]`` an element of an array; the empty path is the
    document itself. Counts are merged from partial ones of every task: one pass over the
    feeds, and a row of each path and type is all that is shuffled.
    """
    feeds = [df.select(F.lit(n).alias("table_name"), "raw_data") for n, df in raw_tables.items()]
    rows = reduce(DataFrame.unionByName, feeds)
    whole = F.array(
        F.struct(F.lit("").alias("path"), documents.type_name("raw_data").alias("type"))
    )
    below = _paths(F.col("raw_data"), "", depth)
    found = rows.select("table_name", F.explode(F.concat(whole, below)).alias("x"))
    return found.groupBy("table_name", F.col("x.path").alias("key_path"), F.col("x.type").alias("type")).agg(
        F.count("*").alias("occurrences")
    )


def json_shape_profile(raw_tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """Row counts by document type and by type of one nested key."""
    shapes = None
    for table, (raw, nested) in raw_tables.items():
        nested_type = F.lit(None)
        if nested:
            nested_type = documents.type_name(documents.part("raw_data", nested))
        counts = raw.groupBy(
            F.lit(table).alias("table_name"),
            documents.type_name("raw_data").alias("raw_data_type"),
            F.lit(nested).cast("string").alias("nested_key"),
            nested_type.cast("string").alias("nested_key_type"),
        ).agg(F.count("*").alias("row_count"))
        shapes = counts if shapes is None else shapes.unionByName(counts)
    return shapes


def load_profile(staged: DataFrame) -> DataFrame:
    """Wrapper rows and array elements per insert date; missing arrays add nothing."""
    size = F.array_size(documents.items("activity_data"))
    return staged.groupBy(F.to_date("insert_date").alias("load_date")).agg(
        F.count("*").alias("raw_batch_rows"),
        F.sum(size).cast("bigint").alias("flattened_activity_count"),
    )


# --- activities ---------------------------------------------------------------------


def activity_type_counts(activities: DataFrame) -> DataFrame:
    return activities.groupBy("activity_type").agg(
        F.count("*").alias("raw_event_count"),
        F.countDistinct("activity_id").alias("distinct_activity_id_count"),
        F.countDistinct("lead_id").alias("distinct_lead_count"),
        F.min("activity_at").alias("first_activity_at"),
        F.max("activity_at").alias("latest_activity_at"),
    )


def custom_type_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("custom_activity_type_id").agg(F.count("*").alias("event_count"))


def duplicate_summary(activities: DataFrame) -> DataFrame:
    """How many delivered rows repeat a lead and activity; rows missing either never count."""
    # concat() is NULL if a part is NULL, which count(distinct) then skips.
    key = F.concat("lead_id", F.lit("|"), "activity_id")
    return activities.agg(
        F.count("*").alias("flattened_activity_rows"),
        F.countDistinct("activity_id").alias("distinct_activity_ids"),
        F.countDistinct(key).alias("distinct_lead_activity_keys"),
        (F.count("*") - F.countDistinct(key)).alias("duplicate_rows"),
    )


def repeated_activities(activities: DataFrame, rows: int = 50) -> DataFrame:
    copies = activities.groupBy("lead_id", "activity_id").agg(
        F.count("*").alias("duplicate_count"),
        F.min("activity_at").alias("first_activity_at"),
        F.max("activity_at").alias("latest_activity_at"),
        F.min("activity_updated_at").alias("first_date_updated"),
        F.max("activity_updated_at").alias("latest_date_updated"),
    )
    order = [
        F.desc("duplicate_count"),
        F.desc_nulls_last("latest_date_updated"),
        F.asc_nulls_last("lead_id"),
        F.asc_nulls_last("activity_id"),
    ]
    return copies.where("duplicate_count > 1").orderBy(*order).limit(rows)


def date_range(activities: DataFrame) -> DataFrame:
    return activities.agg(
        *[
            how(c).alias(f"{name}_{c}")
            for c in ("activity_at", "activity_updated_at")
            for name, how in (("min", F.min), ("max", F.max))
        ]
    )


# --- metadata -----------------------------------------------------------------------


def metadata_entries(staged: DataFrame, pattern: str, names: list[str]) -> DataFrame:
    """Distinct capture groups of every match in the metadata text."""
    found = staged.select(F.explode(values.all_matches("json_object_text", pattern)).alias("m"))
    groups = [F.regexp_extract("m", pattern, i).alias(n) for i, n in enumerate(names, start=1)]
    return found.select(*groups).distinct()


def type_names(staged: DataFrame) -> DataFrame:
    names = ["custom_activity_type_id", "custom_activity_type_name"]
    return metadata_entries(staged, TYPE_ENTRY, names)


def field_names(staged: DataFrame) -> DataFrame:
    names = ["custom_field_id", "custom_field_name", "custom_field_type"]
    return metadata_entries(staged, FIELD_ENTRY, names)


def discover_types(events: DataFrame, staged: DataFrame) -> DataFrame:
    """Use of every custom activity type, with its name from the metadata."""
    used = events.groupBy("custom_activity_type_id").agg(
        F.count("*").alias("activity_count"),
        F.countDistinct("lead_id").alias("distinct_lead_count"),
        F.min("activity_at").alias("first_activity_at"),
        F.max("activity_at").alias("latest_activity_at"),
    )
    return used.join(type_names(staged), "custom_activity_type_id", "left")


def discover_fields(events: DataFrame, staged: DataFrame) -> DataFrame:
    """Where each custom field is filled, with name and type from the metadata."""
    filled = fields.explode_keys(events, "activity", ["custom_activity_type_id"]).where(
        F.col("field_value") != ""
    )
    used = filled.groupBy("custom_activity_type_id", "custom_field_id").agg(
        F.count("*").alias("populated_count"),
        F.countDistinct("field_value").alias("distinct_value_count"),
    )
    return used.join(field_names(staged), "custom_field_id", "left")


# --- business fields ----------------------------------------------------------------


def outcome_distribution(
    events: DataFrame, outcomes: dict[str, tuple[str, str]]
) -> DataFrame:
    """Value counts of outcome fields, each on its own activity type, in one scan.

    ``outcomes`` maps a field's display name to its activity type id and field id.
    """
    type_id = F.col("custom_activity_type_id")
    # An array of what the event's type has: several fields may be on one type.
    counted = [
        F.when(
            type_id == activity_type,
            F.struct(
                F.lit(field_name).alias("field_name"),
                values.blank_label(fields.mapped_text("activity", [field_id])).alias("field_value"),
            ),
        )
        for field_name, (activity_type, field_id) in outcomes.items()
    ]
    wanted = events.where(type_id.isin([t for t, _ in outcomes.values()]))
    present = F.filter(F.array(*counted), lambda p: p.isNotNull())
    return (
        wanted.select(F.inline(present))
        .groupBy("field_name", "field_value")
        .agg(F.count("*").alias("record_count"))
    )


def sale_source_compare(
    events: DataFrame,
    strategy_type: str,
    outcome_field: str,
    sale_outcome: str,
    sale_types: list[str],
    contract_field: str,
    cash_field: str,
) -> DataFrame:
    """Leads by whether a sale shows as call outcome, as sale activity, or as both.

    Revenue counts once per pair of signals of a lead, as the comparison is defined; the
    factor is applied to per-lead totals, so no pairs are produced.
    """
    type_id = F.col("custom_activity_type_id")
    is_call = (type_id == strategy_type) & (
        fields.mapped_text("activity", [outcome_field]) == sale_outcome
    )
    is_sale = type_id.isin(sale_types)
    signals = events.select(
        "lead_id",
        "activity_id",
        is_call.alias("is_call"),
        is_sale.alias("is_sale"),
        values.money(fields.mapped_text("activity", [contract_field])).alias("contract_value"),
        values.money(fields.mapped_text("activity", [cash_field])).alias("cash_collected"),
    ).where("is_call or is_sale")
    leads = signals.groupBy("lead_id").agg(
        F.count_if("is_call").alias("calls"),
        F.count(F.when(F.col("is_call"), F.col("activity_id"))).alias("strategy_sale_count"),
        F.count(F.when(F.col("is_sale"), F.col("activity_id"))).alias("new_sale_count"),
        F.sum(F.when(F.col("is_sale"), F.col("contract_value"))).alias("contract_value"),
        F.sum(F.when(F.col("is_sale"), F.col("cash_collected"))).alias("cash_collected"),
    )
    # Rows without a lead never pair up.
    pairs = F.when(F.col("lead_id").isNull(), 1).otherwise(F.greatest("calls", F.lit(1)))
    calls, sales = F.col("strategy_sale_count") > 0, F.col("new_sale_count") > 0
    category = (
        F.when(calls & sales, "strategy_sale_and_new_sale")
        .when(calls, "strategy_sale_only")
        .when(sales, "new_sale_only")
        .otherwise("neither")
    )
    return leads.groupBy(category.alias("sale_match_category")).agg(
        F.count("*").alias("lead_count"),
        F.sum("strategy_sale_count").alias("strategy_sale_activity_count"),
        F.sum("new_sale_count").alias("new_sale_activity_count"),
        F.sum(F.col("contract_value") * pairs).alias("total_contract_value"),
        F.sum(F.col("cash_collected") * pairs).alias("total_cash_collected"),
    )


def objection_profile(
    events: DataFrame, strategy_types: list[str], field_id: str, category_map: DataFrame
) -> DataFrame:
    """Objection labels split from text, with the category each one belongs to.

    Unlike the report, text that is not a list counts as one label here.
    """
    calls = events.where(F.col("custom_activity_type_id").isin(strategy_types)).select(
        "activity_id", "lead_id", fields.mapped_text("activity", [field_id]).alias("text")
    )
    labels = calls.where(F.col("text") != "").select(
        "activity_id", "lead_id", F.explode(values.split_list_text("text")).alias("label")
    )
    counted = (
        labels.where(F.col("label") != "")
        .groupBy("label")
        .agg(
            F.count("*").alias("objection_count"),
            F.countDistinct("activity_id").alias("distinct_activity_count"),
            F.countDistinct("lead_id").alias("distinct_lead_count"),
        )
    )
    # Fixed value: the profile leaves this label as it is written.
    profiled = category_map.where(F.col("source_objection_value") != "No Show")
    known = profiled.select(
        F.lower("source_objection_value").alias("match_value"), "normalized_objection_category"
    )
    return (
        counted.withColumn("match_value", F.lower("label"))
        .join(known, "match_value", "left")
        .select(
            F.coalesce("normalized_objection_category", "label").alias(
                "normalized_objection_category"
            ),
            F.col("label").alias("source_objection_value"),
            "objection_count",
            "distinct_activity_count",
            "distinct_lead_count",
        )
    )


def revenue_quality(events: DataFrame, types: list[str], ids: dict[str, str]) -> DataFrame:
    """Filled, numeric, invalid, zero and negative amounts per revenue activity type.

    ``ids`` gives the field ids of contract_value, cash_collected and
    additional_cash_collected.
    """
    rows = events.where(F.col("custom_activity_type_id").isin(types)).select(
        "custom_activity_type_id",
        *[fields.mapped_text("activity", [i]).alias(f"{n}_raw") for n, i in ids.items()],
    )
    rows = rows.withColumns({n: values.money(f"{n}_raw") for n in ids})
    contract, cash = F.col("contract_value"), F.col("cash_collected")

    def invalid(name: str):
        return F.count_if(F.col(name).isNull() & F.col(f"{name}_raw").isNotNull())

    return rows.groupBy("custom_activity_type_id").agg(
        F.count("*").alias("revenue_event_count"),
        F.count("contract_value_raw").alias("populated_contract_value_raw_count"),
        F.count("cash_collected_raw").alias("populated_cash_collected_raw_count"),
        F.count("additional_cash_collected_raw").alias("populated_additional_cash_raw_count"),
        F.count("contract_value").alias("numeric_contract_value_count"),
        F.count("cash_collected").alias("numeric_cash_collected_count"),
        F.count("additional_cash_collected").alias("numeric_additional_cash_count"),
        invalid("contract_value").alias("invalid_contract_value_count"),
        invalid("cash_collected").alias("invalid_cash_collected_count"),
        F.count_if(contract == 0).alias("zero_contract_value_count"),
        F.count_if(cash == 0).alias("zero_cash_collected_count"),
        F.count_if(contract < 0).alias("negative_contract_value_count"),
        F.count_if(cash < 0).alias("negative_cash_collected_count"),
        F.sum(contract).alias("total_contract_value"),
        F.sum(cash).alias("total_cash_collected"),
        F.sum("additional_cash_collected").alias("total_additional_cash_collected"),
        F.avg(contract).alias("avg_contract_value"),
        F.min(contract).alias("min_contract_value"),
        F.max(contract).alias("max_contract_value"),
        F.min(cash).alias("min_cash_collected"),
        F.max(cash).alias("max_cash_collected"),
    )


def assignment_coverage(
    events: DataFrame, users: DataFrame, role_fields: dict[str, str]
) -> DataFrame:
    """User assignments per role and activity type, and how many name a known user."""
    columns = {role: fields.mapped_text("activity", [i]) for role, i in role_fields.items()}
    wide = events.select("custom_activity_type_id", *[c.alias(r) for r, c in columns.items()])
    assigned = (
        unpivot_roles(wide, {r: r for r in role_fields}, ["custom_activity_type_id"])
        .groupBy("role_name", "custom_activity_type_id", "user_id")
        .agg(F.count("*").alias("n"))
    )
    known = users.select("user_id", F.lit(True).alias("is_known"))
    is_known = F.col("is_known").isNotNull()
    coverage = (
        assigned.join(known, "user_id", "left")
        .groupBy("role_name", "custom_activity_type_id")
        .agg(
            F.sum("n").alias("populated_assignment_count"),
            F.count("*").alias("distinct_user_id_count"),
            F.sum(F.when(is_known, F.col("n")).otherwise(0)).alias("matched_assignment_count"),
            F.sum(F.when(is_known, 0).otherwise(F.col("n"))).alias("unmatched_assignment_count"),
        )
        .withColumns(
            {
                "result_type": F.lit("role_coverage"),
                "role_field_name": F.concat(F.lit("primary_"), "role_name"),
            }
        )
    )
    summary = users.agg(
        F.lit("parsed_user_summary").alias("result_type"),
        F.count("*").alias("populated_assignment_count"),
        F.countDistinct("user_id").alias("distinct_user_id_count"),
        F.count("email").alias("matched_assignment_count"),
    )
    return summary.unionByName(coverage, allowMissingColumns=True).select(
        "result_type",
        "role_name",
        "role_field_name",
        "custom_activity_type_id",
        "populated_assignment_count",
        "distinct_user_id_count",
        "matched_assignment_count",
        "unmatched_assignment_count",
    )


def orphan_events(events: DataFrame) -> DataFrame:
    """Strategy calls without an earlier contact and sales without an earlier call.

    An earlier event exists exactly if the lead's first event of that stage is not
    later, so one minimum per lead answers it without any ordered matching. ``events``
    is read twice; pass a stored table.
    """
    stage = F.col("funnel_stage")
    first = (
        events.where(F.col("lead_id").isNotNull())
        .groupBy("lead_id")
        .agg(
            F.min(F.when(stage == "initial_contact", F.col("activity_at"))).alias("first_initial"),
            F.min(F.when(stage == "strategy", F.col("activity_at"))).alias("first_strategy"),
        )
    )
    later = events.where(stage.isin("strategy", "sale")).select(
        "lead_id", "activity_id", "activity_at", "funnel_stage"
    )
    joined = join_key_totals(later, first, "lead_id")
    earlier = F.when(stage == "strategy", F.col("first_initial")).otherwise(F.col("first_strategy"))
    preceded = values.is_true(earlier <= F.col("activity_at"))
    name = F.when(stage == "strategy", "strategy_without_prior_initial").otherwise(
        "sale_without_prior_strategy"
    )
    return (
        joined.where(~preceded)
        .groupBy(name.alias("orphan_type"))
        .agg(F.count("*").alias("event_count"), F.countDistinct("lead_id").alias("lead_count"))
    )
