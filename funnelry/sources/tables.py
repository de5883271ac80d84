"""Stored tables: layers by environment, and intermediate results in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LAYERS = {
    "bronze": "view",
    "silver": "table",
    "gold": "table",
    "audit": "view",
    "reference": "table",
}


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="funnelry-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes an intermediate result to the shared folder and reads it back.

    For results read more than once: later stages prune columns, and an executor lost
    afterwards costs a re-read instead of the whole lineage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/funnelry/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def database(layer: str, environment: str = "") -> str:
    """Layer database of an environment: ``dev_gold`` for dev, ``gold`` without one."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{environment}_{layer}" if environment else layer


def materialise(
    df: DataFrame,
    layer: str,
    name: str,
    environment: str = "",
    partition_by: str | None = None,
    bucket_by: tuple[str, int] | None = None,
) -> DataFrame:
    """Creates the table or view of a model and returns it for later models to read.

    The previous content is replaced in full, partition by partition columns included. With
    ``bucket_by`` (column, number) rows are stored by a hash of the column, so that readers
    that group or join by it need no shuffle; a bucket of more rows than one task should
    write becomes several files.
    """
    spark = df.sparkSession
    target = f"{database(layer, environment)}.{name}"
    if LAYERS[layer] == "view":
        # Views over frames live for the session; their database only prefixes the name.
        df.createOrReplaceTempView(f"{database(layer, environment)}_{name}")
        return df
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database(layer, environment)}")
    if bucket_by:
        df = df.hint("rebalance", bucket_by[1], bucket_by[0])
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if bucket_by:
        writer = writer.bucketBy(bucket_by[1], bucket_by[0])
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(target)
    return spark.table(target)
