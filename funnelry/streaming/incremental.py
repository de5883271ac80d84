"""Loads that pick up only files not seen before, and tables they are merged into.

Every batch of a stream is one commit to a versioned store: what a killed batch has written
is never read, and a batch that comes again after its commit is passed over.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelry.operators.changes import upsert_latest
from funnelry.operators.latest import RANK, latest_by
from funnelry.sources import landing
from funnelry.sources.tables import stored
from funnelry.sources.versions import Change, Store

RAW, LATEST = "raw", "latest"


def _run(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Takes in what is there, then stops."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _begin(store: Store, source: str, batch: int) -> Change | None:
    """A change for a batch, None if the batch is in the store already."""
    change = store.begin()
    return None if change.base.applied.get(source, -1) >= batch else change


# --- landing --------------------------------------------------------------------------


def land_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    load_ts: dt.datetime,
    archive: str | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Appends the rows of new files to a raw table, then stops.

    The checkpoint is the list of processed files. A batch is seen once it is committed to
    the manifest of ``target``, and only once. A malformed line fails the run before its
    batch is committed. ``files_per_batch`` breaks a backlog into batches that are committed
    one by one. With ``archive``, files of finished batches are moved there.
    """
    stream = spark.readStream.option("recursiveFileLookup", True)
    if archive:
        stream = stream.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    lines = landing.file_lines(stream.text(source))
    store = Store(spark, target)

    def write(batch: DataFrame, batch_id: int) -> None:
        change = _begin(store, checkpoint, batch_id)
        if change is None:
            return
        raw = landing.to_raw(landing.number_rows(batch), load_ts)
        raw = raw.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        change.create(RAW, raw.schema, ["source_file_name"], 1)
        change.append(RAW, raw)
        change.commit({checkpoint: batch_id})

    _run(lines, checkpoint, write)


def read_raw_table(spark: SparkSession, target: str) -> DataFrame:
    """The committed rows of a raw table; empty before the first load."""
    store = Store(spark, target)
    if RAW not in store.manifest().tables:
        return landing.empty_raw(spark).withColumn("batch_id", F.lit(None).cast("bigint"))
    return store.read(RAW)


def compact_raw_table(spark: SparkSession, target: str) -> int:
    """Gathers the small files that many loads have left; how many there were."""
    change = Store(spark, target).begin()
    gathered = change.compact(RAW)
    if gathered:
        change.commit()
    return gathered


def file_manifest(raw: DataFrame) -> DataFrame:
    """Processed files, and how many rows and which batch each one gave."""
    return raw.groupBy("source_file_name").agg(
        F.count("*").alias("rows_loaded"),
        F.min("batch_id").cast("bigint").alias("batch_id"),
        F.max("bronze_loaded_at").alias("loaded_at"),
    )


# --- tables kept by key ---------------------------------------------------------------


def merge_batch(
    store: Store,
    incoming: DataFrame,
    source: str,
    batch: int,
    keys: Sequence[str],
    combine: Callable[[DataFrame, DataFrame], DataFrame],
    buckets: int = 256,
    name: str = LATEST,
) -> bool:
    """Merges a batch into a stored table; False if the batch is in already.

    ``combine`` gets the stored rows of the touched buckets and the incoming rows. Only
    these buckets are read and written. A batch whose keys fall in every bucket rewrites the
    table: without updates in place that is the price.
    """
    change = _begin(store, source, batch)
    if change is None:
        return False
    incoming = stored(incoming, "incoming")
    change.create(name, incoming.schema, keys, buckets)
    touched = change.touched(name, incoming)
    change.replace(name, combine(change.read(name, touched), incoming), touched)
    change.commit({source: batch})
    return True


def upsert_batch(
    store: Store,
    incoming: DataFrame,
    source: str,
    batch: int,
    keys: Sequence[str],
    newest: Sequence[str],
    load_ts: dt.datetime,
    buckets: int = 256,
    name: str = LATEST,
) -> bool:
    """Upserts a batch by key: first ``insert_date`` and last ``update_date`` are kept.

    Both columns are set to ``load_ts``, so a repeated run gives the same rows.
    """
    stamp = F.lit(load_ts).cast("timestamp_ntz")
    stamped = incoming.withColumns({"insert_date": stamp, "update_date": stamp})

    def combine(current: DataFrame, rows: DataFrame) -> DataFrame:
        return upsert_latest(current, rows, keys, newest)

    return merge_batch(store, stamped, source, batch, keys, combine, buckets, name)


def keep_latest(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    newest: Sequence[str],
    buckets: int = 256,
) -> None:
    """Streaming form of the latest-version rule, as an upsert per batch."""
    store = Store(spark, target)

    def combine(current: DataFrame, rows: DataFrame) -> DataFrame:
        return latest_by(current.unionByName(rows), keys, newest).drop(RANK)

    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_batch(store, batch, checkpoint, batch_id, keys, combine, buckets)

    _run(source, checkpoint, merge)


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    """The table kept by :func:`keep_latest` or :func:`upsert_batch`."""
    store = Store(spark, target)
    if LATEST not in store.manifest().tables:
        raise FileNotFoundError(f"nothing has been written to {target}")
    return store.read(LATEST)
