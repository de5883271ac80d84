"""Reading document keys that a mapping table names."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from funnelry.functions import documents, values
from funnelry.sources.tables import stored

PREFIX = "custom."
#: Mapping rows up to which field keys are literals of a projection. Larger mappings are
#: joined, with the same rows.
LITERAL_ROWS = 1_000


def mapping_rows(mapping: DataFrame, max_rows: int = LITERAL_ROWS) -> list[Row] | None:
    """The rows of a mapping that is small enough for literals, otherwise None."""
    rows = mapping.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def active_fields(field_map: DataFrame) -> DataFrame:
    """``custom_field_id`` and ``name`` of the active mapping rows, each pair once."""
    known = values.is_true("is_active") & F.col("custom_field_id").isNotNull()
    pairs = field_map.where(known).select(
        "custom_field_id", F.col("canonical_field_name").alias("name")
    )
    return pairs.distinct()


def mapped_text(
    document: str,
    field_ids: Sequence[str],
    read: Callable[[str, str], Column] = documents.text,
) -> Column:
    """Text of the mapped fields; the greatest where several ids are filled."""
    found = [read(document, PREFIX + i) for i in field_ids]
    if not found:
        return F.lit(None).cast("string")
    return found[0] if len(found) == 1 else F.greatest(*found)


def project_fields(
    document: str, ids: Mapping[str, Sequence[str]], as_json: Collection[str] = ()
) -> list[Column]:
    """One column per canonical name, for a plain projection: no explode, no pivot.

    Names in ``as_json`` keep their JSON form, which tells lists from text.
    """
    return [
        mapped_text(document, i, documents.json if n in as_json else documents.text).alias(n)
        for n, i in ids.items()
    ]


def explode_keys(events: DataFrame, document: str, keep: Sequence[str]) -> DataFrame:
    """One row per custom field present in the document (the wildcard matches any sign)."""
    pairs = F.map_filter(documents.entries(document), lambda k, _: F.like(k, F.lit("custom.cf_%")))
    return events.select(*keep, F.explode(pairs).alias("raw_activity_key", "field_value")).select(
        *keep,
        "raw_activity_key",
        F.replace("raw_activity_key", F.lit(PREFIX), F.lit("")).alias("custom_field_id"),
        F.col("field_value").cast("string").alias("field_value"),
    )


def read_fields(
    events: DataFrame,
    document: str,
    keep: Sequence[str],
    field_map: DataFrame,
    names: Sequence[str],
    as_json: Collection[str] = (),
    max_rows: int = LITERAL_ROWS,
) -> DataFrame:
    """Events reduced to ``keep`` and the text of their mapped fields, a column per name.

    A small mapping is a plain projection: no shuffle. Any other is joined by key; both
    forms give the same rows.
    """
    wanted = active_fields(field_map).where(F.col("name").isin(list(names)))
    rows = mapping_rows(wanted, max_rows)
    if rows is not None:
        ids = {n: sorted(r.custom_field_id for r in rows if r.name == n) for n in names}
        return events.select(*keep, *project_fields(document, ids, as_json))
    numbered, found = join_fields(events, document, keep, wanted)
    columns = [
        F.max(F.when(F.col("name") == n, F.col("json" if n in as_json else "text"))).alias(n)
        for n in names
    ]
    wide = found.groupBy("_row").agg(*columns)
    return numbered.join(wide, "_row", "left").select(*keep, *names)


def join_fields(
    events: DataFrame, document: str, keep: Sequence[str], mapping: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Numbered events, and by their number the fields that a mapping of any size names.

    ``mapping`` has ``custom_field_id`` and ``name``. The keys of each document are exploded
    and joined with it; a key that most events hold is a skewed join key that AQE splits.
    Events are stored with their numbers, so that both results agree on them.
    """
    entries = F.map_filter(
        documents.entries(document), lambda k, _: F.startswith(k, F.lit(PREFIX))
    )
    held = F.transform_values(
        entries, lambda _, v: F.struct(v.cast("string").alias("text"), F.to_json(v).alias("json"))
    )
    row = F.monotonically_increasing_id().alias("_row")
    numbered = stored(events.select(*keep, row, held.alias("_held")), "fields")
    each = numbered.select("_row", F.explode("_held").alias("key", "value"))
    field_id = F.substr("key", F.lit(len(PREFIX) + 1)).alias("custom_field_id")
    found = each.select("_row", "value.*", field_id).join(mapping, "custom_field_id")
    json = F.nullif("json", F.lit("null")).alias("json")
    return numbered.drop("_held"), found.select("_row", "name", "text", json)


def explode_mapped_fields(
    events: DataFrame,
    document: str,
    keep: Sequence[str],
    field_map: DataFrame,
    max_rows: int = LITERAL_ROWS,
) -> DataFrame:
    """One row per mapped key present in the document; one row of NULLs where none is.

    With a small mapping the key-presence join is answered inside each row: unmapped keys
    are dropped from the document's own entries before the explode, so the work grows with
    the keys present and not with events x mapping rows, and no join back is needed. A key
    that holds a JSON null is present and has a NULL value.
    """
    active = active_fields(field_map)
    rows = mapping_rows(active, max_rows)
    if rows is None:
        numbered, found = join_fields(events, document, keep, active)
        return numbered.join(found, "_row", "left").select(
            *keep, F.col("name").alias("canonical_field_name"), F.col("text").alias("field_value")
        )
    names: dict[str, list[str | None]] = {}
    for row in rows:
        names.setdefault(PREFIX + row.custom_field_id, []).append(row.name)
    mapped = F.map_filter(documents.entries(document), lambda k, _: k.isin(list(names)))
    if not names:
        lookup = F.lit(None).cast("map<string,array<string>>")
    else:
        lookup = F.create_map(
            *[x for k, v in sorted(names.items()) for x in (F.lit(k), F.array(*map(F.lit, v)))]
        )
    each = events.select(*keep, F.explode_outer(mapped).alias("_key", "_value"))
    named = F.explode_outer(F.try_element_at(lookup, F.col("_key")))
    return each.select(
        *keep,
        named.alias("canonical_field_name"),
        F.col("_value").cast("string").alias("field_value"),
    )
