"""JSON-lines files to raw tables, with file lineage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelry.functions import documents, values
from funnelry.operators.skew import bounded_broadcast
from funnelry.schema import RAW
from funnelry.sources.tables import stored

SPLIT = ["source_file_name", "split_start"]
#: About 100 MB of split rows; one load beyond it (128 TB of text) joins by shuffle.
MAX_BROADCAST_SPLITS = 1_000_000


def file_lines(source: DataFrame) -> DataFrame:
    """Lines of a text source with the file and byte range (split) each came from."""
    return source.select(
        F.make_valid_utf8("value").alias("value"),
        F.col("_metadata.file_path").alias("source_file_name"),
        F.col("_metadata.file_block_start").alias("split_start"),
    )


def number_rows(lines: DataFrame) -> DataFrame:
    """Adds the 1-based line number within the file; large files stay split.

    ``lines`` must come straight from the scan (:func:`file_lines`), unfiltered.

    A task reads a split's lines in order and gives them consecutive ids, so a line's
    number is its offset in the split plus the lines of the file's earlier splits. The
    source is read once: how it is split may change from one scan to the next, so the
    lines are stored with their splits, and these are counted from the stored table.
    """
    lines = stored(lines.withColumn("line_id", F.monotonically_increasing_id()), "lines")
    splits = lines.groupBy(*SPLIT).agg(
        F.min("line_id").alias("first_id"), F.count("*").alias("n_lines")
    )
    earlier = (
        Window.partitionBy("source_file_name")
        .orderBy("split_start")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    splits = splits.select(
        *SPLIT,
        (F.coalesce(F.sum("n_lines").over(earlier), F.lit(0)) - F.col("first_id") + 1).alias(
            "shift"
        ),
    )
    splits = bounded_broadcast(stored(splits, "splits"), MAX_BROADCAST_SPLITS)
    return lines.join(splits, SPLIT).select(
        "value",
        "source_file_name",
        (F.col("line_id") + F.col("shift")).alias("source_row_number"),
    )


def unwrap(document: Column) -> Column:
    """The payload under ``raw_data`` where the line has one, else the whole line."""
    return F.coalesce(documents.part(document, "raw_data"), document)


def stamp(load_ts: dt.datetime) -> Column:
    return F.lit(load_ts).cast("timestamp_ntz")


def to_raw(numbered: DataFrame, load_ts: dt.datetime) -> DataFrame:
    """Raw-table rows. A line that is not JSON raises and so aborts the load.

    ``load_ts`` is an argument so that a repeated run gives the same rows.
    """
    parsed = numbered.where(values.not_blank("value")).withColumn("doc", F.parse_json("value"))
    return parsed.select(
        unwrap(F.col("doc")).alias("raw_data"),
        "source_file_name",
        "source_row_number",
        stamp(load_ts).cast("date").alias("load_date"),
        F.coalesce(
            values.timestamp(documents.text("doc", "insert_date")), stamp(load_ts)
        ).alias("insert_date"),
        stamp(load_ts).alias("bronze_loaded_at"),
    )


def read_landed(spark: SparkSession, path: str, load_ts: dt.datetime) -> DataFrame:
    """One-off load of a folder of JSON lines; compression follows the file extension."""
    reader = spark.read.option("recursiveFileLookup", True)
    return to_raw(number_rows(file_lines(reader.text(path))), load_ts)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Lines under ``load_date=YYYY-MM-DD`` folders; a filter on the date skips folders."""
    return spark.read.text(path).select("value", F.col("load_date").cast("date"))


def read_variant(spark: SparkSession, path: str) -> DataFrame:
    """Lines parsed by the JSON reader itself into one document column."""
    return spark.read.option("singleVariantColumn", "document").json(path)


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW)


def export_lines(table: DataFrame, *keep: str) -> DataFrame:
    """``{"raw_data": ..., "insert_date": ...}`` lines of a source table."""
    line = F.to_json(F.struct("raw_data", "insert_date"))
    return table.select(line.alias("value"), *keep)


def export_files(table: DataFrame, folder: str, load_date: dt.date) -> None:
    """Writes the lines under the date-partitioned landing layout."""
    export_lines(table).write.mode("overwrite").text(
        f"{folder}/load_date={load_date.isoformat()}"
    )


def read_source_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A source table over JDBC.

    Give partitionColumn, lowerBound, upperBound and numPartitions to read it in
    parallel ranges; without them a single task reads the whole table.
    """
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files waiting in a landing folder, without reading their content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.load(path).select("path", "length", "modificationTime")


def preview(raw: DataFrame, rows: int = 10) -> DataFrame:
    """First rows by file and line, to look at before a load."""
    return raw.orderBy("source_file_name", "source_row_number").limit(rows)


def file_load_profile(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source_file_name").agg(
        F.count("*").alias("rows_loaded"),
        F.min("insert_date").alias("min_insert_date"),
        F.max("insert_date").alias("max_insert_date"),
    )
