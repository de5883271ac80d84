"""Stored counts that changes are added to and taken from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelry.operators.latest import RANK, latest_by
from funnelry.sources.tables import stored
from funnelry.sources.versions import Change

OLD, NEW = "old", "new"
SIGN = "sign"
_INCOMING, _NEWEST = "_incoming", "_newest"


def _merged_counts(
    change: Change, name: str, changes: DataFrame, touched: set[int], compared: bool
) -> DataFrame:
    """The touched buckets' counts with the changes added, and what they were if compared."""
    current = change.read(name, touched)
    keys = change.tables[name].keys
    counts = [c for c in changes.columns if c not in keys]
    both = current.withColumn(_INCOMING, F.lit(0)).unionByName(
        changes.select(*[F.col(f.name).cast(f.dataType) for f in current.schema]).withColumn(
            _INCOMING, F.lit(1)
        )
    )
    before = F.col(_INCOMING) == 0

    def total(column: str, when: Column | None = None) -> Column:
        value = F.col(column) if when is None else F.when(when, F.col(column))
        kind = current.schema[column].dataType
        return F.coalesce(F.sum(value), F.lit(0)).cast(kind).alias(column)

    sides = [F.struct(*[total(c) for c in counts]).alias(NEW)]
    if compared:
        sides.append(F.struct(*[total(c, before) for c in counts]).alias(OLD))
    return both.groupBy(*keys).agg(F.max(_INCOMING).alias(_INCOMING), *sides)


def _put_counts(
    change: Change, name: str, merged: DataFrame, touched: set[int], rows: str
) -> None:
    left = F.col(f"{NEW}.{rows}")
    below = F.raise_error(F.concat(F.lit(f"{name} counts below zero: "), left.cast("string")))
    kept = merged.where(F.when(left < 0, below.cast("boolean")).otherwise(left > 0))
    change.replace(name, kept.select(*change.tables[name].keys, f"{NEW}.*"), touched)


def apply_counts(change: Change, name: str, changes: DataFrame, rows: str = "n") -> DataFrame:
    """Adds ``changes`` to a stored table of counts; what the touched keys had and have.

    The table's columns are its keys and additive counts; ``changes`` has the same columns,
    several rows for a key allowed, and negative where something is taken back. ``rows``
    counts what a key stands for: keys left without any go, and one below zero raises, as
    something was taken back that had not been added. Only the buckets of touched keys are
    read and written. The result has the keys and two structs, ``old`` and ``new``.
    ``changes`` is read twice, once for its keys only: give what stored tables yield.

    A distinct count is kept without listing its members: with a table keyed by group and
    member, the group's count rises where ``old.n`` is 0 and falls where ``new.n`` is.
    """
    touched = change.touched(name, changes)
    merged = stored(_merged_counts(change, name, changes, touched, compared=True), name)
    _put_counts(change, name, merged, touched, rows)
    return merged.where(F.col(_INCOMING) == 1).drop(_INCOMING)


def add_counts(change: Change, name: str, changes: DataFrame, rows: str = "n") -> None:
    """:func:`apply_counts` where nobody asks what the keys had: merged in one go.

    For tables of one bucket, whose ``changes`` are read only once.
    """
    touched = change.touched(name, changes)
    merged = _merged_counts(change, name, changes, touched, compared=False)
    _put_counts(change, name, merged, touched, rows)


def difference(touched: DataFrame, keys: Sequence[str], counts: dict[str, Column]) -> DataFrame:
    """New minus old of expressions over the counts, for groups of touched keys.

    ``counts`` maps a name to an expression that reads the counts as columns of their own.
    """

    def side(which: str, sign: int) -> DataFrame:
        flat = touched.select(*[c for c in touched.columns if c not in (OLD, NEW)], f"{which}.*")
        return flat.select(*keys, *[(c * sign).alias(n) for n, c in counts.items()])

    both = side(NEW, 1).unionByName(side(OLD, -1))
    summed = both.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in counts])
    return summed.where(" OR ".join(f"{n} <> 0" for n in counts))


def merge_latest(
    change: Change, name: str, incoming: DataFrame, keys: Sequence[str], newest: Sequence[str]
) -> tuple[DataFrame, set[int]]:
    """Merges rows into a stored table, keeping the newest version per key.

    Returns the rows of the touched buckets as they are now, read from their new files, and
    these buckets. ``incoming`` is read twice: give a stored table.
    """
    touched = change.touched(name, incoming)
    current = change.read(name, touched)
    both = current.unionByName(incoming.select(*current.columns))
    change.replace(name, latest_by(both, keys, newest).drop(RANK), touched)
    return change.read(name, touched), touched


def moved_latest(
    change: Change, name: str, incoming: DataFrame, keys: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """Merges like :func:`merge_latest`; the versions that went (-1) and came (1), by ``SIGN``.

    A key whose newest version stays has no rows. The stored rows are shuffled once to be
    merged and compared; copies of an incoming key are reduced to one before.
    """
    touched = change.touched(name, incoming)
    current = change.read(name, touched)
    latest = latest_by(incoming.select(*current.columns), keys, newest).drop(RANK)
    both = current.withColumn(_INCOMING, F.lit(0)).unionByName(
        latest.withColumn(_INCOMING, F.lit(1))
    )
    order = [F.col(c).desc_nulls_last() for c in newest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, F.col(_INCOMING)))
    # Newest and stored stays, newest and incoming came, stored and not newest went.
    is_newest, was_there = rank == 1, F.col(_INCOMING) == 0
    sign = F.when(is_newest & ~was_there, 1).when(~is_newest & was_there, -1)
    ranked = both.select("*", is_newest.alias(_NEWEST), sign.alias(SIGN)).drop(_INCOMING)
    ranked = stored(ranked.where(F.col(_NEWEST) | F.col(SIGN).isNotNull()), name)
    change.replace(name, ranked.where(_NEWEST), touched)
    return ranked.where(F.col(SIGN).isNotNull()).drop(_NEWEST)
