"""Sharding by a weighted tree of regions, racks and shards, descended by hash draws.

A shard's draw for a key is exponential with the shard's weight as its rate; a rack's or
region's draw is the smallest below it, which is exponential with the rate of the subtree's
whole weight. The descent takes the child of the smallest draw at each level. A draw depends
on the key and the shard alone, so changing a weight moves keys only into or out of the
subtrees that hold it, and a new shard takes keys only into itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.llm.running import blocks_for, totals_before
from funnelry.sources.tables import stored

#: A tree: regions, each a list of racks, each a map of shard to weight.
Tree = list[list[dict[int, float]]]


def regular_tree(shards: int, per_rack: int = 4, racks: int = 3) -> Tree:
    """A tree of equal shards, filled rack by rack: one more shard only adds to it."""
    numbers = list(range(shards))
    filled = [numbers[i : i + per_rack] for i in range(0, shards, per_rack)]
    regions = [filled[i : i + racks] for i in range(0, len(filled), racks)]
    return [[{n: 1.0 for n in rack} for rack in region] for region in regions]


def _literal(tree: Tree) -> str:
    def rack(of: dict[int, float]) -> str:
        leaves = ", ".join(
            f"named_struct('shard', {n}, 'weight', {w!r}D)" for n, w in sorted(of.items())
        )
        return f"array({leaves})"

    kept = [[{n: w for n, w in r.items() if w > 0} for r in region] for region in tree]
    kept = [[r for r in region if r] for region in kept]
    return ", ".join(f"array({', '.join(map(rack, region))})" for region in kept if region)


def descend(key: str, tree: Tree) -> Column:
    """The shard of the key column: region, then rack, then shard of the smallest draw.

    Shards of weight 0 get nothing. A null key is a key like others. Equal draws, which a
    53-bit hash hardly gives, go to the smaller shard.
    """
    if not any(w > 0 for region in tree for rack in region for w in rack.values()):
        raise ValueError("the tree has no shard with a weight")
    uniform = f"((shiftrightunsigned(xxhash64({key}, s.shard), 11) + 0.5D) / 9007199254740992D)"
    draw = f"named_struct('draw', -ln({uniform}) / s.weight, 'shard', s.shard)"

    def smallest(nodes: str, below: str) -> str:
        # Of each node: its draw, and what it holds.
        draws = f"transform({nodes}, n -> named_struct('by', {below}, 'node', n))"
        return f"array_min({draws}).node"

    region = smallest(
        f"array({_literal(tree)})", f"array_min(transform(flatten(n), s -> {draw}))"
    )
    rack = smallest(region, f"array_min(transform(n, s -> {draw}))")
    return F.expr(f"array_min(transform({rack}, s -> {draw})).shard")


def shard_rows(
    df: DataFrame, key: str, tree: Tree, grown: Tree | None = None, tie: list[str] = ()
) -> DataFrame:
    """Adds ``shard``, ``slot`` and, for a ``grown`` tree, ``grown_shard``.

    Slots number the rows of a shard from 0 without gaps, in the order of a hash of the key,
    then key and ``tie`` columns; rows equal in all of these are interchangeable. No task
    numbers a whole shard. Nulls are a key like others; an empty table gives no rows;
    columns named like the added ones are replaced.
    """
    placed = df.withColumns(
        {
            "shard": descend(f"`{key}`", tree),
            "grown_shard": descend(f"`{key}`", grown) if grown else F.lit(None).cast("int"),
        }
    )
    held = stored(placed, "shards")
    leaves = sum(len(rack) for region in tree for rack in region)
    blocks = blocks_for(held.count() // leaves)
    salt = F.xxhash64(F.col(key), F.lit("slot"), *[F.col(c) for c in tie])
    blocked = held.withColumn("_block", F.pmod(salt, F.lit(blocks)))
    order = [F.col(key), *[F.col(c) for c in tie]]
    return totals_before(blocked, "shard", "_block", order, F.lit(1), "slot").drop("_block")
