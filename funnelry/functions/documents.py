"""Column helpers for semi-structured documents held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_path(key: str) -> str:
    """JSON path of one top-level key; the quoted form keeps dots inside the key."""
    if '"' in key or "\\" in key:
        raise ValueError(f"document key cannot be quoted in a path: {key!r}")
    return f'$["{key}"]'


def text(document: str | Column, key: str) -> Column:
    """The value under a key as text; absent keys and JSON nulls are NULL."""
    return F.try_variant_get(document, key_path(key), "string")


def part(document: str | Column, key: str) -> Column:
    """The value under a key, still a document."""
    return F.try_variant_get(document, key_path(key), "variant")


def json(document: str | Column, key: str) -> Column:
    """The value under a key as JSON text, strings quoted; a JSON null is NULL."""
    return F.nullif(F.to_json(part(document, key)), F.lit("null"))


def items(document: str | Column) -> Column:
    """The elements of an array document; anything else is NULL and explodes to no rows."""
    return F.try_variant_get(document, "$", "array<variant>")


def entries(document: str | Column) -> Column:
    """The top level of an object document as a map; anything else is NULL."""
    return F.try_variant_get(document, "$", "map<string,variant>")


def present(document: str | Column, key: str) -> Column:
    """True where a key exists, also where it holds a JSON null."""
    return part(document, key).isNotNull()


def type_name(document: str | Column) -> Column:
    """object, array, string, number, boolean or null; NULL for a missing document."""
    scalar = F.schema_of_variant(document)
    return (
        F.when(items(document).isNotNull(), "array")
        .when(entries(document).isNotNull(), "object")
        .when(scalar == "STRING", "string")
        .when(scalar == "BOOLEAN", "boolean")
        .when(scalar == "VOID", "null")
        .when(F.is_variant_null(document), "null")
        .when(scalar.isNotNull(), "number")
    )
