"""Reference tables: activity types, fields, outcomes and objection categories."""

from __future__ import annotations

import csv
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from funnelry.schema import SEEDS

_ARROW = {T.StringType(): pa.string(), T.BooleanType(): pa.bool_()}


def packaged_rows(name: str) -> list[dict[str, str | None]]:
    """Rows of a seed shipped with the package; blank cells are None."""
    text = resources.files("funnelry").joinpath("seeds", f"{name}.csv").read_text("utf-8")
    lines = [line for line in text.splitlines() if not line.startswith("#")]
    return [{k: v or None for k, v in row.items()} for row in csv.DictReader(lines)]


def load_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A seed with its declared types, from a CSV path or from the package.

    Packaged files live on the driver only, so their few rows travel inside the plan.
    """
    schema = SEEDS[name]
    if path is not None:
        reader = spark.read.schema(schema).option("header", True).option("comment", "#")
        return reader.option("enforceSchema", False).csv(path)
    rows = packaged_rows(name)
    columns = {}
    for field in schema:
        cells = [row[field.name] for row in rows]
        if isinstance(field.dataType, T.BooleanType):
            cells = [None if c is None else c.lower() == "true" for c in cells]
        columns[field.name] = pa.array(cells, _ARROW[field.dataType])
    return spark.createDataFrame(pa.table(columns), schema)


def load_seeds(spark: SparkSession, folder: str | None = None) -> dict[str, DataFrame]:
    return {
        name: load_seed(spark, name, f"{folder}/{name}.csv" if folder else None)
        for name in SEEDS
    }
