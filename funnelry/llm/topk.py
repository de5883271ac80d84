"""Exact top-k inner products from an impact-ordered index, a score at a time.

Vectors are dealt to blocks. A block's index holds, for each component and quantised impact,
the segment of vectors that have it. A query processes the segments by descending size of
their contribution, adding it to the accumulators of the segment's vectors. After a stage the
largest error an accumulator can still have is known; once that proves that few vectors can
belong to the best k, these are rescored exactly from their components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from funnelry.sources.tables import stored

#: Least width of an impact class and classes on either side of 0; vectors of a block,
#: queries of a block, and query blocks that pass by one copy of an index.
STEP, CLASSES, VECTORS, QUERIES, PASSING = 8, 128, 8192, 512, 64
#: Shares of all postings after which the proof is tried, and the share of vectors that is
#: cheaper to rescore than to go on with.
STAGES, FEW = (0.4, 0.65, 0.85, 1.0), 1 / 16
#: Tasks of the search at most; beyond it a task takes several indexes in turn.
TASKS = 1 << 14
#: Largest sum of products that 64-bit integers, and doubles, hold exactly.
_LONG, _EXACT = 2.0**62, 2.0**52


class Index:
    """Segments of a block: component, impact class, and the vectors that have them.

    Vectors hold integers as doubles. The classes' width is a power of two that follows the
    largest component, so that a component and its class differ by half a width at most.
    """

    def __init__(self, vectors: np.ndarray) -> None:
        largest = np.abs(vectors).max(initial=0)
        self.step = max(float(STEP), 2.0 ** np.ceil(np.log2(max(1.0, largest / CLASSES))))
        level = np.rint(vectors / self.step)
        row, dim = np.nonzero(level)
        value = level[row, dim]
        order = np.lexsort((row, value, dim))
        self.rows = row[order]
        dim, value = dim[order], value[order]
        new = np.ones(len(dim), bool)
        new[1:] = (dim[1:] != dim[:-1]) | (value[1:] != value[:-1])
        self.starts = np.flatnonzero(new)
        self.ends = np.append(self.starts[1:], len(dim))
        self.dims, self.impacts = dim[self.starts], value[self.starts] * self.step

    def best(
        self, query: np.ndarray, vectors: np.ndarray, allowed: np.ndarray, k: int
    ) -> np.ndarray:
        """Rows that may be among the k best: all that are, and few others."""
        others = np.flatnonzero(allowed)
        with np.errstate(over="ignore", invalid="ignore"):
            gain = query[self.dims] * self.impacts
            reach = np.abs(query) @ np.abs(vectors).max(axis=0, initial=0)
        if len(others) <= k or not np.isfinite(reach):
            return others
        order = np.argsort(-np.abs(gain), kind="stable")
        sizes = (self.ends - self.starts)[order]
        done = np.cumsum(sizes)
        total = done[-1] if len(done) else 0
        scores = np.zeros(len(vectors))
        rounding = np.abs(query).sum() * (self.step / 2)
        # What adding doubles may lose: each vector gets a term of each component at most.
        rounding += (2 * reach + rounding) * (len(query) + 8) * 2.0**-52
        at, few = 0, max(64, int(len(vectors) * FEW))
        possible = others
        for share in STAGES:
            to = int(np.searchsorted(done, share * total, side="left")) + 1
            now = order[at:to]
            if len(now):
                rows = np.concatenate(
                    [self.rows[a:b] for a, b in zip(self.starts[now], self.ends[now], strict=True)]
                )
                scores += np.bincount(rows, np.repeat(gain[now], sizes[at:to]), len(scores))
            at = max(at, to)
            # A vector has one segment at most of each component.
            rest = np.zeros(len(query))
            left = order[at:]
            np.maximum.at(rest, self.dims[left], np.abs(gain[left]))
            error = rounding + rest.sum()
            seen = np.where(allowed, scores, -np.inf)
            kth = np.partition(seen, len(seen) - k)[len(seen) - k]
            possible = np.flatnonzero(seen + error >= kth - error)
            if len(possible) <= few or at >= len(order):
                break
        return possible


def _components(vector: object) -> np.ndarray | None:
    """The components as doubles; None if one is null or not finite."""
    values = np.array([np.nan if x is None else x for x in vector], float)
    return values if np.isfinite(values).all() else None


def _whole(values: np.ndarray) -> np.ndarray:
    """floor(256 * x), still as doubles, which hold it exactly; infinite if too large."""
    with np.errstate(over="ignore"):
        return np.floor(values * 256)


def _as_int(x: float) -> int:
    return int(x) * 256 if abs(x) >= _EXACT else int(np.floor(x * 256))


def _products(vectors: np.ndarray, query: np.ndarray) -> list[int]:
    """Exact integer inner products of raw rows with a raw query."""
    with np.errstate(over="ignore", invalid="ignore"):
        rows, asked = _whole(vectors), _whole(query)
        reach = (np.abs(rows) @ np.abs(asked)).max(initial=0)
    largest = max(np.abs(rows).max(initial=0), np.abs(asked).max(initial=0))
    if reach < _LONG and largest < _LONG:
        return (rows.astype(np.int64) @ asked.astype(np.int64)).tolist()
    asked = [_as_int(x) for x in query]
    return [sum(_as_int(x) * y for x, y in zip(row, asked, strict=True)) for row in vectors]


def _placed(score: int) -> tuple[int | None, int, str]:
    """A score as 64 bits, or null with its side (1 above, -1 below) and a text in its order."""
    if -(2**63) <= score < 2**63:
        return score, 0, ""
    digits = f"{abs(score):x}"
    text = f"{len(digits):08x}{digits}"
    if score > 0:
        return None, 1, text
    return None, -1, text.translate(str.maketrans("0123456789abcdef", "fedcba9876543210"))


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """A block as one row: row numbers, ids, and vectors padded with zeros to one length."""
    vectors = [_components(v) for v in rows["vector"]]
    kept = [i for i, v in enumerate(vectors) if v is not None]
    width = max((len(vectors[i]) for i in kept), default=0)
    matrix = np.zeros((len(kept), width))
    for at, i in enumerate(kept):
        matrix[at, : len(vectors[i])] = vectors[i]
    packed = {c: [rows[c].to_numpy(np.int64)[kept].tobytes()] for c in ("rows", "ids")}
    block = {"block": [rows["block"].iloc[0]], "width": [width]}
    return pd.DataFrame(block | packed | {"vectors": [matrix.tobytes()]})


def _unpacked(r: tuple, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, ids = np.frombuffer(r.rows, np.int64), np.frombuffer(r.ids, np.int64)
    matrix = np.frombuffer(r.vectors).reshape(len(rows), r.width)
    return rows, ids, np.pad(matrix, ((0, 0), (0, max(0, width - r.width))))


_FOUND = "query_row long, query_id long, vec_id long, score long, side int, digits string"


def _searched(k: int):
    """Takes indexes, each followed by the blocks of queries that pass by it."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, index, vectors = None, None, np.zeros((0, 0))
        for batch in batches:
            for r in batch.itertuples(index=False):
                if r.asked < 0:
                    held, index = r, None
                    continue
                if held is None or (held.block, held.turn) != (r.block, r.turn):
                    # No vector was dealt to this block.
                    continue
                rows, ids, plain = _unpacked(held, r.width)
                if index is None or plain.shape[1] != vectors.shape[1]:
                    vectors = _whole(plain)
                    index = Index(vectors) if np.isfinite(vectors).all() else None
                numbers, names, queries = _unpacked(r, plain.shape[1])
                found = []
                for number, name, query in zip(numbers, names, queries, strict=True):
                    allowed, asked = rows != number, _whole(query)
                    some = np.flatnonzero(allowed)
                    if index is not None and np.isfinite(asked).all():
                        some = index.best(asked, vectors, allowed, k)
                    scored = zip(_products(plain[some], query), ids[some].tolist(), strict=True)
                    best = sorted(scored, key=lambda x: (-x[0], x[1]))[:k]
                    found += [(number, name, i, *_placed(s)) for s, i in best]
                columns = [x.split()[0] for x in _FOUND.split(", ")]
                out = pd.DataFrame(found, columns=columns)
                yield out.astype({"score": "Int64"})

    return search


def top_k(df: DataFrame, vec_id: str, vector: str, every: int, k: int = 5) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best of every query.

    Queries are the rows whose id is divisible by ``every``; all rows but the query's own are
    searched. Rows that repeat an id are rows of their own, as queries too: each such query
    has its ranks. Ties go to the smaller id; a query with fewer others gets all of them.
    Vectors that are null or hold null or non-finite components, and rows without id, take
    no part. A shorter vector counts as padded with zeros. Scores are exact at any size and
    ranked so; one that does not fit 64 bits is null.
    """
    rows = df.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull())
    good = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = rows.filter(good).select(
        F.monotonically_increasing_id().alias("rows"),
        F.col(vec_id).cast("long").alias("ids"),
        F.col(vector).alias("vector"),
    )
    rows = stored(named, "vectors")
    asked = rows.filter(F.col("ids") % every == 0)
    schema = "block long, width int, rows binary, ids binary, vectors binary"

    def blocks(part: DataFrame, size: int) -> tuple[DataFrame, int]:
        many = max(1, -(-part.count() // size))
        dealt = part.withColumn("block", F.pmod(F.xxhash64("rows"), F.lit(many)))
        return dealt.groupBy("block").applyInPandas(_packed, schema), many

    index, many = blocks(rows, VECTORS)
    queries, asking = blocks(asked, QUERIES)
    turns = -(-asking // PASSING)
    # Blocks of the stated queries go to the indexes, which are the larger side.
    copies = index.withColumns(
        {"asked": F.lit(-1).cast("long"), "turn": F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))}
    )
    passing = queries.withColumns(
        {"asked": F.col("block"), "turn": F.floor(F.col("block") / PASSING).cast("int")}
    ).withColumn("block", F.explode(F.expr(f"sequence(0L, {many - 1}L)")))
    both = copies.unionByName(passing).repartition(min(TASKS, many * turns), "block", "turn")
    found = both.sortWithinPartitions("block", "turn", "asked").mapInPandas(_searched(k), _FOUND)
    order = [F.desc("side"), F.desc("score"), F.desc("digits"), "vec_id"]
    ranks = F.row_number().over(Window.partitionBy("query_row").orderBy(*order))
    ranked = found.withColumn("rank", ranks).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
