"""Exact copies of texts, found by counting quotient filters and proven on bytes.

Each partition counts the fingerprints of its texts in counting quotient filters, one for each
segment of the fingerprint space. The filters of a segment are merged by their sorted
remainders; nothing is lost, as whole fingerprints are kept. Only texts whose fingerprint was
counted more than once are compared byte by byte, and only they are shuffled.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.sources.tables import stored

#: Share of slots in use for which a filter is sized.
LOAD = 0.9
#: Fingerprints that a task holds before it hands on its filters.
FILTER_ROWS = 1 << 20
#: Fingerprints for which a segment is sized; at least 2^6 segments.
SEGMENT_ROWS = 1 << 20
MIN_SEGMENT_BITS, MAX_SEGMENT_BITS = 6, 20
#: Most bits of the table of suspects that all tasks get (32 MB). Beyond about 2^24 suspects
#: more texts are compared than need be; the result is the same.
MAX_SUSPECT_BITS = 28
_HEAD = struct.Struct("<BBQ")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pack(values: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A counting quotient filter of sorted distinct values below 2^bits.

    A value's upper bits, the quotient, are its home slot; its lower bits, the remainder, are
    kept in the first free slot from there on, in order. A count above one follows in a slot of
    its own. Three bits for each slot: a quotient has values (occupied), a run of one quotient
    ends here, the slot holds a count.
    """
    width = 1 + (counts > 1).astype(np.int64)
    need = int(width.sum())
    upper = min(max(1, math.ceil(math.log2(max(need, 1) / LOAD))), bits)
    lower = bits - upper
    quotient = (values >> np.uint64(lower)).astype(np.int64)
    before = np.cumsum(width) - width
    place = before + np.maximum.accumulate(quotient - before) if need else before
    size = max(1 << upper, int(place[-1] + width[-1]) if need else 0)
    slots = np.zeros(size, dtype="<u8")
    slots[place] = values & np.uint64((1 << lower) - 1)
    many = counts > 1
    slots[place[many] + 1] = counts[many]
    occupied, ends, counted = np.zeros(1 << upper, bool), np.zeros(size, bool), np.zeros(size, bool)
    occupied[quotient] = True
    counted[place[many] + 1] = True
    if need:
        last = np.append(quotient[1:] != quotient[:-1], True)
        ends[(place + width - 1)[last]] = True
    flags = [np.packbits(x).tobytes() for x in (occupied, ends, counted)]
    return b"".join([_HEAD.pack(bits, upper, size), *flags, slots.tobytes()])


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted values of a filter and their counts."""
    bits, upper, size = _HEAD.unpack_from(packed)
    at = _HEAD.size

    def flags(n: int) -> np.ndarray:
        nonlocal at
        raw = np.frombuffer(packed, np.uint8, -(-n // 8), at)
        at += len(raw)
        return np.unpackbits(raw, count=n).astype(bool)

    occupied, ends, counted = flags(1 << upper), flags(size), flags(size)
    slots = np.frombuffer(packed, "<u8", size, at)
    quotient, stop = np.flatnonzero(occupied), np.flatnonzero(ends)
    start = np.maximum(quotient, np.concatenate([[0], stop[:-1] + 1]) if len(stop) else stop)
    length = stop - start + 1
    used = np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)
    first = ~counted[used]
    place = used[first]
    values = np.repeat(quotient, length)[first].astype(np.uint64) << np.uint64(bits - upper)
    counts = np.ones(len(place), dtype=np.int64)
    many = np.flatnonzero(np.append(counted, False)[place + 1])
    counts[many] = slots[place[many] + 1]
    return values | slots[place], counts


def merge(filters: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Values and summed counts of several filters: their sorted runs are merged."""
    parts = [unpack(x) for x in filters]
    values = np.concatenate([v for v, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def segmented(prints: np.ndarray, segment_bits: int) -> Iterator[tuple[int, bytes]]:
    """The filters of some fingerprints: one for each segment that has any."""
    values, counts = np.unique(prints, return_counts=True)
    bits = 64 - segment_bits
    segment = (values >> np.uint64(bits)).astype(np.int64)
    rest = values & np.uint64((1 << bits) - 1)
    cuts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])[: len(segment)])
    for a, b in zip(cuts, [*cuts[1:], len(segment)], strict=True):
        yield int(segment[a]), pack(rest[a:b], counts[a:b], bits)


def merged_filters(prints: DataFrame, name: str, segment_bits: int) -> DataFrame:
    """``segment``, ``n_rows``, ``n_values`` and ``suspects``: a filter of those met again."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flushed() -> pa.RecordBatch:
            rows = list(segmented(np.concatenate(held), segment_bits))
            return pa.record_batch(
                [pa.array([s for s, _ in rows], pa.int32()), pa.array([f for _, f in rows], pa.binary())],
                ["segment", "filter"],
            )

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += batch.num_rows
            if n >= FILTER_ROWS:
                yield flushed()
                held, n = [], 0
        if n:
            yield flushed()

    def together(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        values, counts = merge(list(group["filter"]))
        again = counts > 1
        suspects = pack(values[again], counts[again], 64 - segment_bits)
        row = (key[0], int(counts.sum()), len(values), int(again.sum()), suspects)
        return pd.DataFrame([row], columns=["segment", "n_rows", "n_values", "n_suspects", "suspects"])

    filters = prints.select(name).mapInArrow(build, "segment int, filter binary")
    return filters.groupBy("segment").applyInPandas(
        together, "segment int, n_rows long, n_values long, n_suspects long, suspects binary"
    )


def suspect_column(merged: DataFrame, fingerprint: Column, segment_bits: int) -> Column:
    """Whether a fingerprint may have been counted more than once: never wrongly false.

    The occupied bits of all suspects, for as many upper bits of the fingerprint as keep one in
    64 of them in use, at most 2^MAX_SUSPECT_BITS; only these reach the driver.
    """
    spark = merged.sparkSession
    n = merged.agg(F.sum("n_suspects")).first()[0] or 0
    bits = min(max(segment_bits + 3, math.ceil(math.log2(64 * max(n, 1)))), MAX_SUSPECT_BITS)
    inner = bits - segment_bits

    def occupied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            slices = []
            for packed in batch["suspects"]:
                values, _ = unpack(packed)
                table = np.zeros(1 << inner, bool)
                table[values >> np.uint64(64 - segment_bits - inner)] = True
                slices.append(np.packbits(table).tobytes())
            yield pd.DataFrame({"segment": batch["segment"], "bits": slices})

    table = np.zeros((1 << bits) // 8, np.uint8)
    wide = (1 << inner) // 8
    for r in merged.mapInPandas(occupied, "segment int, bits binary").toLocalIterator():
        table[r["segment"] * wide : (r["segment"] + 1) * wide] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def met_again(values: pd.Series) -> pd.Series:
        at = values.to_numpy().view(np.uint64) >> np.uint64(64 - bits)
        hit = shared.value[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1
        return pd.Series(hit.astype(bool))

    return met_again(fingerprint)


def folded(text: Column) -> Column:
    """The text with A-Z lower-cased, empty for null."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def exact_copies(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row.

    ``docs`` has ``doc_id`` and ``text``, other columns are not looked at; it is read twice.
    Of equal texts (A-Z lower-cased, null as empty) one row with the largest id stays. Null ids
    come last: they stay only where the group has no id, and ``keep_id`` is then null. Of several
    rows with that id one stays. An empty table gives no rows.

    Copies are grouped by their bytes, combined in every map task first, so a text that a third
    of all rows share is one row of each task. A row finds its group by fingerprint and SHA-256.
    """
    text = folded(F.col("text"))
    rows = stored(
        docs.select(
            "doc_id",
            F.xxhash64(text).alias("print"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "fingerprints",
    )
    n = rows.count()
    segment_bits = math.ceil(math.log2(max(n / SEGMENT_ROWS, 1)))
    segment_bits = min(max(segment_bits, MIN_SEGMENT_BITS), MAX_SEGMENT_BITS)
    merged = stored(merged_filters(rows, "print", segment_bits), "filters")
    if (merged.agg(F.sum("n_rows")).first()[0] or 0) != n:
        raise RuntimeError("the merged filters do not count every row")
    suspect = suspect_column(merged, F.col("print"), segment_bits)

    # Byte verification of the texts whose fingerprint was met again.
    groups = (
        docs.select("doc_id", text.alias("bytes"))
        .withColumn("print", F.xxhash64("bytes"))
        .where(suspect)
        .groupBy("print", "bytes")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select("print", F.unhex(F.sha2("bytes", 256)).alias("digest"), "keep_id", "group_size")
    )
    marked = rows.withColumn("suspect", suspect)
    again = marked.where("suspect").drop("suspect")
    # Rows alike in text and id are combined in the map tasks, the others go to many.
    one = again.groupBy("print", "digest", "doc_id").agg(F.min("row").alias("keep_row"))
    o, g = one.alias("o"), groups.alias("g")
    decided = o.join(
        g,
        (F.col("o.print") == F.col("g.print"))
        & (F.col("o.digest") == F.col("g.digest"))
        & F.col("o.doc_id").eqNullSafe(F.col("g.keep_id")),
    ).select("o.print", "o.digest", "keep_id", "group_size", "keep_row")
    found = again.join(decided, ["print", "digest"], "left")
    grouped = F.col("group_size").isNotNull()
    copies = found.select(
        "doc_id",
        F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        "digest",
    )
    single = marked.where(~F.col("suspect")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "digest",
    )
    every = copies.unionByName(single)
    return every.select(*every.columns[:-1], F.lower(F.hex("digest")).alias("text_sha256"))
