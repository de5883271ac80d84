"""Clusters of integer vectors by equal-average equal-variance nearest-centroid search.

Centroids are sorted by their mean. From a vector's own mean the search goes outward, nearest
mean first, and ends as soon as the means alone prove that nothing nearer follows; a centroid
whose deviation from its mean differs too much is passed over. What is left gets its exact
integer distance. Both bounds are on squares of integers, so ties are not lost.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelry.sources.tables import stored

#: Sums of components go through Spark in digits of so many bits, so none can overflow.
DIGIT_BITS = 30
LONGEST = (1 << 63) - 1


def whole(vector: Column, size: int) -> Column:
    """Whether a vector has exactly ``size`` components, none null or non-finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(vector) == size) & finite, F.lit(False))


def _exact(floats: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in floats], dtype=object).reshape(floats.shape)


def narrow_limit(size: int) -> int:
    """Components up to this one need no more than 62 bits in any product or bound below."""
    return (1 << 31) // (2 * size)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and the squared distance, ties to the smaller number.

    For 64-bit integers within :func:`narrow_limit`; all vectors take a step outward together.
    """
    n, size = vectors.shape
    sums, own = centroids.sum(axis=1), vectors.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    means = sums[order]

    def deviation(rows: np.ndarray, total: np.ndarray) -> np.ndarray:
        return np.sqrt((size * (rows * rows).sum(axis=1) - total * total).astype(float))

    spread, wide = deviation(vectors, own), deviation(centroids, sums)
    best = np.full(n, (1 << 62) // size, dtype=np.int64)
    cluster = np.full(n, len(centroids), dtype=np.int64)
    above = np.searchsorted(means, own)
    below = above - 1
    far = np.iinfo(np.int64).max
    active = np.arange(n)
    while len(active):
        low, high, total = below[active], above[active], own[active]
        down = np.where(low >= 0, total - means[np.maximum(low, 0)], far)
        up = np.where(high < len(means), means[np.minimum(high, len(means) - 1)] - total, far)
        rise = up < down
        gap = np.where(rise, up, down)
        # Beyond this gap all means differ by more, so the best found is the nearest.
        open_ = gap != far
        open_[open_] = gap[open_] ** 2 <= size * best[active[open_]]
        active, rise, gap = active[open_], rise[open_], gap[open_]
        at = order[np.where(rise, above[active], below[active])]
        above[active] += rise
        below[active] -= ~rise
        # Rounded down by more than the error of the square roots.
        apart = np.abs(spread[active] - wide[at])
        apart = np.maximum(apart - (spread[active] + wide[at]) * 1e-14, 0)
        near = gap.astype(float) ** 2 + apart**2 <= (size * best[active]) * (1 + 1e-12) + 1
        rows, numbers = active[near], at[near]
        diff = vectors[rows] - centroids[numbers]
        distance = (diff * diff).sum(axis=1)
        better = (distance < best[rows]) | (distance == best[rows]) & (numbers < cluster[rows])
        best[rows[better]], cluster[rows[better]] = distance[better], numbers[better]
    return cluster, best


def nearest_exact(vector: list[int], centroids: list[list[int]]) -> tuple[int, int]:
    """The same for one vector of integers of any size."""
    size, own = len(vector), sum(vector)
    spread = math.isqrt(size * sum(x * x for x in vector) - own * own)
    ranked = sorted((abs(own - sum(c)), i) for i, c in enumerate(centroids))
    best: tuple[int, int] | None = None
    for gap, i in ranked:
        if best and gap * gap > size * best[0]:
            break
        center = centroids[i]
        total = sum(center)
        wide = math.isqrt(size * sum(x * x for x in center) - total * total)
        apart = max(abs(spread - wide) - 1, 0)
        if best and gap * gap + apart * apart > size * best[0]:
            continue
        found = (sum((x - y) ** 2 for x, y in zip(vector, center, strict=True)), i)
        best = found if best is None else min(best, found)
    return best[1], best[0]


class Search:
    """Centroids ready for batches: in 64 bits where all numbers allow it, else exact."""

    def __init__(self, centroids: list[list[int]], scale: int):
        self.centroids, self.scale = centroids, scale
        self.limit = narrow_limit(len(centroids[0]))
        narrow = all(abs(x) <= self.limit for c in centroids for x in c)
        self.table = np.array(centroids, dtype=np.int64) if narrow else None

    def batch(self, column: pa.Array) -> tuple[np.ndarray, list, list]:
        """Integer vectors of an Arrow list column, their clusters and squared distances."""
        size = len(self.centroids[0])
        flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        floats = np.floor(self.scale * flat).reshape(-1, size)
        if self.table is not None and np.abs(floats).max(initial=0) <= self.limit:
            vectors = floats.astype(np.int64)
            cluster, distance = nearest(vectors, self.table)
            return vectors, cluster.tolist(), distance.tolist()
        vectors = _exact(floats)
        found = [nearest_exact(list(v), self.centroids) for v in vectors]
        return vectors, [c for c, _ in found], [d for _, d in found]


def digits(value: int) -> list[int]:
    """Digits of an integer, lowest first; the last one bears the sign."""
    out = []
    while not -(1 << DIGIT_BITS) < value < 1 << DIGIT_BITS:
        out.append(value & (1 << DIGIT_BITS) - 1)
        value >>= DIGIT_BITS
    return [*out, value]


def _means(kept: DataFrame, vector: str, search: Search) -> list[list[int]]:
    """The next centroids: floored means of the vectors nearest to each.

    Each task sends one sum per centroid and component, so what reaches the driver is in
    proportion to the centroids alone.
    """
    size = len(search.centroids[0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors, clusters, _ = search.batch(batch.column(0))
            clusters = np.asarray(clusters, dtype=np.int64)
            for c in np.unique(clusters).tolist():
                mine = vectors[clusters == c]
                total = totals.setdefault(c, np.zeros(size + 1, dtype=object))
                total += np.array([*mine.sum(axis=0).tolist(), len(mine)], dtype=object)
        rows = [
            (c, part, place, digit)
            for c, total in totals.items()
            for part, value in enumerate(total)
            for place, digit in enumerate(digits(int(value)))
        ]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        yield pa.record_batch(
            [pa.array(x, pa.int64()) for x in columns], ["cluster", "part", "place", "digit"]
        )

    schema = "cluster long, part long, place long, digit long"
    found: dict[tuple[int, int], int] = {}
    summed = kept.select(vector).mapInArrow(sums, schema).groupBy("cluster", "part", "place")
    for r in summed.agg(F.sum("digit").alias("digit")).collect():
        key = r["cluster"], r["part"]
        found[key] = found.get(key, 0) + (r["digit"] << DIGIT_BITS * r["place"])
    return [
        [found[i, x] // found[i, size] for x in range(size)] if found.get((i, size)) else list(old)
        for i, old in enumerate(search.centroids)
    ]


def cluster_vectors(
    spark: SparkSession,
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    size: int = 64,
    scale: int = 64,
    centroids: int = 16,
    rounds: int = 3,
) -> DataFrame:
    """``key``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Components become floor(scale * x), x as double. Vectors null, of another size or holding
    null or non-finite components take no part; rows that repeat a key are vectors of their
    own, and other columns are not looked at. The first centroids are the vectors with the
    smallest SHA-256 of ``1:<key>`` (a null key is written as nothing), equal hashes by vector;
    with fewer vectors there are fewer centroids, and without any the result is empty. A squared
    distance, or sum of them, that does not fit 64 bits is null; components are exact at any
    size. ``df`` is read once a round and twice more: give a stored table.
    """
    schema = (
        f"{key} {df.schema[key].dataType.simpleString()}, cluster int, distance long, "
        "cluster_inertia long, inertia long, centroid_sha256 string"
    )
    kept = df.where(whole(F.col(vector), size)).select(key, vector)
    written = F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    starts = kept.orderBy(F.sha2(written, 256), vector).limit(centroids).collect()
    if not starts:
        return spark.createDataFrame([], schema)
    search = Search([[math.floor(scale * x) for x in r[vector]] for r in starts], scale)
    for _ in range(rounds):
        search = Search(_means(kept, vector, search), scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, clusters, distances = search.batch(batch.column(1))
            distances = [d if d <= LONGEST else None for d in distances]
            yield pa.record_batch(
                [batch.column(0), pa.array(clusters, pa.int32()), pa.array(distances, pa.int64())],
                [key, "cluster", "distance"],
            )

    parts = schema.split(", ")
    assigned = stored(kept.mapInArrow(assign, ", ".join(parts[:3])), "assigned")
    sums = assigned.groupBy("cluster").agg(
        F.when(F.count("*") == F.count("distance"), F.expr("try_sum(distance)")).alias("sum")
    )
    by_cluster = {r["cluster"]: r["sum"] for r in sums.collect()}
    known = [x for x in by_cluster.values() if x is not None]
    whole_sum = sum(known) if len(known) == len(by_cluster) and sum(known) <= LONGEST else None
    # One row per centroid.
    described = spark.createDataFrame(
        [
            (i, by_cluster.get(i), whole_sum, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for i, c in enumerate(search.centroids)
        ],
        ", ".join([parts[1], *parts[3:]]),
    )
    return assigned.join(F.broadcast(described), "cluster").select(key, *assigned.columns[1:], *described.columns[1:])
