"""N-gram Jaccard join with prefixes under several global token orders.

Two sets of a Jaccard similarity of t or more share a token among the first
``n - ceil(t * n) + 1`` of each, under any order of all tokens, and one more for each token
that the prefix is longer by. Order A puts rare tokens first, and its prefixes are longer in
proportion to the set; orders B and C are hashes. Only pairs that share prefix tokens under
all of them, and whose sizes and outlines (a bit map of the tokens) allow it, are verified, on
the words themselves.

The work is kept linear where many texts are alike:

1. Equal sets are one class, and one node from there on. All nodes are dealt into classes by
   size, and each node counts its lists that have other nodes of a class. Two linked sets of
   such sizes share so many prefix tokens, so a node leaves its lists without a class of such a
   count: tokens shared by chance, or by sets that are half alike, go before any pair is made.
   Lists of the same nodes then become one, with the number of their tokens: a passage that
   some sets share is one list, not one for each of its tokens.
2. In each list the nodes are paired with a few leaders. The pairs that share most tokens, and
   enough of them, are verified; links make components. This is repeated with other leaders
   while it helps and far too many pairs remain.
3. All other pairs of a list matter only if they lie in different components. Those are made
   in full, filtered and verified; with their links the components are complete. Where the
   first common token of two sets stands bounds their overlap, so that a token that stands
   late in one of them makes no pair.

So no link between different texts can be lost, and a group of copies costs a few pairs a
member instead of all pairs. Classes are told apart by 128-bit digests.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from funnelry.llm.components import components, forest
from funnelry.sources.tables import stored

WORDS, NUM, DEN = 5, 75, 100
#: Cells of the token count sketch that makes order A (16 MB, whatever the input), and of the
#: bit map of nodes that have a partner (2 MB). Their sizes change the work, not the result.
SKETCH_BITS, MAP_BITS, SLICE_BITS = 24, 24, 18
#: A token's list is split where the sketch counts more than this.
LIST_ROWS = 100_000
#: Leaders of a list, and partners of a node, in the first turn and in later ones.
LEADERS, MORE_LEADERS = 3, 12
#: Another turn follows while more pairs than this are left for each row of the lists, and
#: the last turn left less than this share of those before it.
PAIRS_LEFT, WORTH = 2, 0.9
#: A node is heavy if it shares one token in so many with others.
HEAVY = 10
#: Linked sets share one more prefix token of order A for each so many tokens.
EXTRA = 32
#: Size classes that nodes are dealt into, one for each bit of a long. So many cover all sizes
#: of sets that may be linked to one; other sizes share the classes.
CLASSES = 64
_WIDTH = 2 * math.log(DEN / NUM) / CLASSES
#: Early tokens of a set that keep a pair from being made at each common token.
FIRST = 12
_SEEN = 100_000
_GAP = re.compile(rb"[ \t-\r]")
_MIX = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15)]


#: Whether a byte belongs to a word; a random number for each, the same for A-Z and a-z.
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_NUMBERS = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
_NUMBERS[65:91] = _NUMBERS[97:123]
#: Texts are hashed in parts of about so many bytes, cut between words.
_PART = 1 << 18


def _powers(base: int) -> np.ndarray:
    powers = np.full(_PART + 1, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


_BASE = 0x9E3779B97F4A7C15
_POWERS, _INVERSES = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _mix(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * by
    return x ^ (x >> np.uint64(29))


def _hashes_of_part(text: bytes) -> np.ndarray:
    """Polynomial hashes of the words, from differences of one running sum over the bytes."""
    if len(text) > _PART:
        # Words of such a length have a hash of their own, the others the usual one.
        each = [
            _hashes_of_part(w)
            if len(w) <= _PART
            else np.array([xxhash.xxh3_64_intdigest(w)], np.uint64)
            for w in words_of(text)
        ]
        return np.concatenate(each) if each else np.zeros(0, np.uint64)
    codes = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = _IN_WORD[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_NUMBERS[codes] * _POWERS[: len(codes)], out=sums[1:])
    values = (sums[ends] - sums[starts]) * _INVERSES[starts]
    return _mix(values + (ends - starts).astype(np.uint64) * _MIX[2], _MIX[1])


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    if len(text) <= _PART:
        return _hashes_of_part(text)
    parts, at = [], 0
    while at < len(text):
        end = min(at + _PART, len(text))
        if end < len(text):
            cut = _GAP.search(text, max(at, end - 4096), end) or _GAP.search(text, end)
            end = cut.end() if cut else len(text)
        parts.append(_hashes_of_part(text[at:end]))
        at = end
    return np.concatenate(parts)


def _each(texts: pa.Array) -> Iterator[bytes | None]:
    """The texts one after the other, so that a batch is not held twice."""
    return (text.as_py() for text in texts)


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased words between spaces and U+0009 to U+000D."""
    return text.lower().split() if text else []


def shingles(text: bytes | None, width: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit tokens of the windows; of all words, if there are fewer."""
    each = word_hashes(text) if text else np.zeros(0, np.uint64)
    if not len(each):
        return each
    width = min(width, len(each))
    size = len(each) - width + 1
    token = each[:size].copy()
    for k in range(1, width):
        token = token * _MIX[2] + each[k : k + size]
    token = _mix(token + np.uint64(width), _MIX[0])
    token.sort()
    new = np.ones(size, bool)
    np.not_equal(token[1:], token[:-1], out=new[1:])
    return token[new]


def word_sets(words: list[bytes], width: int = WORDS) -> set[tuple[bytes, ...]]:
    """The windows themselves, for verification."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width)), strict=False))


def prefix_length(n: int, shared: int = 1) -> int:
    """Tokens of which linked sets share so many."""
    return n - -(-NUM * n // DEN) + shared


def shared_tokens(n):
    """Prefix tokens of order A that a set of size n shares with any linked one of its size or more."""
    return 1 + n // EXTRA


def linked(x: set, y: set) -> bool:
    common = len(x & y)
    return bool(common) and DEN * common >= NUM * (len(x) + len(y) - common)


def _digest(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _hash_prefix(tokens: np.ndarray, by: np.uint64) -> np.ndarray:
    """Prefix under a hash order, by 32 bits: equal tokens stay equal."""
    p = prefix_length(len(tokens))
    ranks = _mix(tokens, by)
    return np.unique(np.partition(ranks, p - 1)[:p].astype(np.uint32))


def _slices(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    width = 1 << SLICE_BITS
    for at in range(0, len(counts), width):
        part = counts[at : at + width]
        if part.any():
            yield at // width, zlib.compress(part.tobytes(), 1)


def _sets_and_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row its set's digest and size; at the end the partition's token counts."""
    kept, held = [], 0
    counts = np.zeros(1 << SKETCH_BITS, np.uint8)
    names, kind = ["id", "digest", "n", "slice", "counts"], pa.int64()

    def count() -> None:
        cells = np.concatenate(kept) & np.uint64(len(counts) - 1)
        cells, times = np.unique(cells, return_counts=True)
        counts[cells] = np.minimum(counts[cells] + times, 255)
        kept.clear()

    for batch in batches:
        digests, sizes = [], []
        kind = batch.column(0).type
        for text in _each(batch.column(1)):
            tokens = shingles(text)
            digests.append(_digest(tokens) if len(tokens) else None)
            sizes.append(len(tokens))
            kept.append(tokens)
            held += len(tokens)
            if held > 1 << 20:
                count()
                held = 0
        rows = len(sizes)
        arrays = [
            batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()),
            pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names)
    if kept:
        count()
    for at, part in _slices(counts):
        arrays = [
            pa.nulls(1, kind), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()),
            pa.array([at], pa.int32()), pa.array([part], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _add_slices(parts: pd.DataFrame) -> pd.DataFrame:
    """Adds some partitions' counts of one slice, as 32-bit numbers."""
    total = np.zeros(1 << SLICE_BITS, np.uint64)
    for packed in parts["counts"]:
        part = zlib.decompress(packed)
        total += np.frombuffer(part, np.uint8 if len(part) == len(total) else np.uint32)
    top = np.minimum(total, np.iinfo(np.uint32).max).astype(np.uint32)
    counts = zlib.compress(top.tobytes(), 1)
    return pd.DataFrame({"slice": [parts["slice"].iloc[0]], "counts": [counts]})


def _scaled(parts: pd.DataFrame) -> pd.DataFrame:
    """Adds up a slice and keeps an eighth of a power of two of each count: enough to order."""
    total = _add_slices(parts)
    counts = np.frombuffer(zlib.decompress(total["counts"].iloc[0]), np.uint32)
    classes = np.minimum(8 * np.log2(counts.astype(np.float64) + 1), 255).astype(np.uint8)
    total["counts"] = [classes.tobytes()]
    return total


def _sketch(rows: DataFrame) -> np.ndarray:
    """How often the tokens of each cell occur in all rows: a table of fixed size, summed in
    two steps. Partitions count to 255 only, which matters to the order alone."""
    parts = rows.filter("slice is not null").select("slice", "counts")
    schema = "slice int, counts binary"
    spread = parts.withColumn("deal", F.pmod(F.xxhash64("counts"), F.lit(16)))
    some = spread.groupBy("slice", "deal").applyInPandas(
        lambda key, x: _add_slices(x[["slice", "counts"]]), schema
    )
    classes = np.zeros(1 << SKETCH_BITS, np.uint8)
    for row in some.groupBy("slice").applyInPandas(_scaled, schema).collect():
        at = row["slice"] << SLICE_BITS
        classes[at : at + (1 << SLICE_BITS)] = np.frombuffer(row["counts"], np.uint8)
    return classes


def _postings(sketch):
    """Prefix tokens of each set under order A, once for equal sets of a partition."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = sketch.value, set()
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for text in _each(batch.column(0)):
                tokens = shingles(text)
                if not len(tokens):
                    continue
                node = _node(_digest(tokens))
                if node in seen:
                    continue
                if len(seen) < _SEEN:
                    seen.add(node)
                often = counts[tokens & np.uint64(len(counts) - 1)]
                p = prefix_length(len(tokens), shared_tokens(len(tokens)))
                first = np.lexsort((tokens, often))[:p]
                chosen, often = tokens[first], often[first]
                columns[0].append(chosen.view(np.int64))
                columns[1].append(1 + (2.0 ** (often / 8) // LIST_ROWS).astype(np.int32))
                columns[2].append(np.full(len(chosen), node, np.int64))
                columns[3].append(np.full(len(chosen), len(tokens), np.int32))
                columns[4].append(np.arange(len(chosen), dtype=np.int32))
            if columns[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in columns],
                    ["token", "parts", "node", "n", "place"],
                )

    return emit


def _bit_map(nodes: DataFrame) -> np.ndarray:
    """Which nodes there are, by the low bits of their number; a table of fixed size."""
    place = nodes.select(F.pmod("node", F.lit(1 << MAP_BITS)).alias("place")).distinct()
    width = 1 << 18

    def mark(places: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(width, bool)
        bits[places["place"].to_numpy() % width] = True
        slice_ = int(places["place"].iloc[0] // width)
        return pd.DataFrame({"slice": [slice_], "bits": [np.packbits(bits).tobytes()]})

    sliced = place.withColumn("slice", F.floor(F.col("place") / width))
    rows = sliced.groupBy("slice").applyInPandas(mark, "slice int, bits binary").collect()
    bits = np.zeros(1 << MAP_BITS, bool)
    for row in rows:
        at = row["slice"] * width
        bits[at : at + width] = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
    return np.packbits(bits)


def outline(tokens: np.ndarray) -> bytes:
    """A bit for each token, by its low bits, in a table of 8 to 16 bits a token."""
    size = max(64, 1 << (8 * len(tokens) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(tokens & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def outlines_allow(n: int, m: int, x: bytes, y: bytes) -> bool:
    """Whether sets of sizes n and m may be linked: each bit that only one of them has stands
    for a token, at least, that the other lacks."""
    size = 8 * min(len(x), len(y))
    x, y = (int.from_bytes(v, "little") for v in (x, y))
    while (wide := max(x.bit_length(), y.bit_length())) > size:
        half = max(size, 1 << ((wide - 1).bit_length() - 1))
        x, y = ((v & ((1 << half) - 1)) | (v >> half) for v in (x, y))
    most = min(n - (x & ~y).bit_count(), m - (y & ~x).bit_count())
    return (NUM + DEN) * most >= NUM * (n + m)


def _payloads(bit_map):
    """For nodes that may have a partner: digest, size, outline, prefixes under orders B and C,
    and words."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = bit_map.value, set()
        for batch in batches:
            rows = []
            for text in _each(batch.column(0)):
                tokens = shingles(text)
                if not len(tokens):
                    continue
                digest = _digest(tokens)
                node = _node(digest)
                place = node % (1 << MAP_BITS)
                if digest in seen or not bits[place >> 3] >> (7 - (place & 7)) & 1:
                    continue
                if len(seen) < _SEEN:
                    seen.add(digest)
                b, c = (_hash_prefix(tokens, by).tobytes() for by in _MIX[:2])
                words = zlib.compress(b" ".join(words_of(text)), 1)
                rows.append((node, digest, len(tokens), outline(tokens), b, c, words))
            if rows:
                columns = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.binary(), pa.int64(), *[pa.binary()] * 4]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                names = ["node", "digest", "n", "outline", "b", "c", "words"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return emit


def _share(x: bytes, y: bytes) -> bool:
    x, y = (np.frombuffer(v, np.uint32) for v in (x, y))
    return bool(np.isin(x, y, assume_unique=True).any())


def _likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs that share prefix tokens under orders B and C and whose outlines are alike."""
    for batch in batches:
        rows = [
            (r.a, r.b)
            for r in batch.itertuples(index=False)
            if outlines_allow(r.n_a, r.n_b, r.outline_a, r.outline_b)
            and _share(r.b_a, r.b_b)
            and _share(r.c_a, r.c_b)
        ]
        yield pd.DataFrame(rows, columns=["a", "b"])


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs that are linked."""
    for batch in batches:
        rows, sets = [], {}

        def windows(digest: bytes, packed: bytes, sets: dict = sets) -> set:
            if digest not in sets:
                if len(sets) >= 64:
                    sets.clear()
                sets[digest] = word_sets(zlib.decompress(packed).split())
            return sets[digest]

        for r in batch.itertuples(index=False):
            if linked(windows(r.digest_a, r.words_a), windows(r.digest_b, r.words_b)):
                rows.append((r.digest_a, r.digest_b))
        yield pd.DataFrame(rows, columns=["a", "b"])


def _payloads_of(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Payloads of the nodes, and of some others, once each."""
    bits = texts.sparkSession.sparkContext.broadcast(_bit_map(nodes))
    schema = (
        "node long, digest binary, n long, outline binary, b binary, c binary, words binary"
    )
    found = texts.mapInArrow(_payloads(bits), schema)
    return stored(found.dropDuplicates(["digest"]), "payloads")


def _with_sides(pairs: DataFrame, payloads: DataFrame, columns: list[str]) -> DataFrame:
    """The pairs with some columns of both nodes' payloads."""
    for x in ("a", "b"):
        named = [F.col(c).alias(f"{c}_{x}") for c in columns]
        pairs = pairs.join(payloads.select(F.col("node").alias(x), *named), x)
    return pairs


def _verify(pairs: DataFrame, payloads: DataFrame) -> DataFrame:
    """Links among the pairs, by digest; words are sent only for likely ones."""
    likely = _with_sides(pairs, payloads, ["n", "outline", "b", "c"])
    likely = stored(likely.mapInPandas(_likely, "a long, b long").distinct(), "likely")
    nodes = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    both = _with_sides(likely, payloads.join(nodes, "node", "left_semi"), ["digest", "words"])
    return stored(both.drop("a", "b").mapInPandas(_verified, "a binary, b binary"), "links")


def _components_of(labels: DataFrame, payloads: DataFrame) -> DataFrame:
    """The component of each linked node that has a payload."""
    of_digest = labels.withColumnRenamed("node", "digest")
    of_digest = of_digest.withColumn("component", F.xxhash64("root")).drop("root")
    of_node = payloads.select("node", "digest").join(of_digest, "digest")
    return of_node.groupBy("node").agg(F.min("component").alias("component"))


def _overlap_allows(most: Column, n: str, m: str) -> Column:
    """Whether sets of sizes n and m with an overlap of at most ``most`` may be linked."""
    sizes = (F.col(n) + F.col(m)).cast("long")
    return (NUM + DEN) * most >= NUM * sizes


def _after_prefix(n: str) -> Column:
    """Tokens of a set that are not in its prefix."""
    return F.ceil(F.col(n).cast("long") * NUM / DEN) - 1 - F.floor(F.col(n) / EXTRA)


def _with_component(lists: DataFrame, component: DataFrame) -> DataFrame:
    """The lists with each member's component; a node without links is its own."""
    members = lists.drop("component").join(component, "node", "left")
    return members.withColumn("component", F.coalesce("component", "node"))


def _live(members: DataFrame) -> DataFrame:
    """Members of the lists in which several components remain; only split lists are joined."""
    low, high = F.min("component"), F.max("component")
    by_list = Window.partitionBy("token")
    whole = members.filter("parts = 1")
    whole = whole.withColumns({"low": low.over(by_list), "high": high.over(by_list)})
    split = members.filter("parts > 1")
    several = split.groupBy("token").agg(low.alias("low"), high.alias("high"))
    several = several.filter("low != high").select("token")
    return whole.filter("low != high").drop("low", "high").unionByName(split.join(several, "token"))


def _heavy(lists: DataFrame) -> DataFrame:
    """Lists of the nodes that share a good part of their tokens with some others.

    Sets that share a few tokens by chance are left to the third step.
    """
    counts = lists.groupBy("node").agg(F.sum("weight").alias("k"), F.first("n").alias("of"))
    return lists.join(counts.filter(F.col("k") * HEAVY >= F.col("of")).select("node"), "node")


def _pairs_left(live: DataFrame) -> tuple[int, int]:
    """Rows of the lists, and pairs across components, a pair counted in each list."""
    each = live.groupBy("token", "component").agg(F.count(F.lit(1)).alias("c"))
    lists = each.groupBy("token").agg(F.sum("c").alias("c"), F.sum(F.col("c") ** 2).alias("s"))
    sums = lists.agg(F.sum("c"), F.sum((F.col("c") ** 2 - F.col("s")) / 2)).first()
    return sums[0] or 0, sums[1] or 0


def _led(live: DataFrame, turn: int) -> DataFrame:
    """For each node the few leaders of its lists that share most prefix tokens with it.

    Leaders come first in an order of all nodes that changes with the turn; large lists are
    split, otherwise each turn. Two linked sets share so many prefix tokens that their
    overlap can suffice with all that comes after the prefix.
    """
    many = MORE_LEADERS if turn else LEADERS
    order = F.xxhash64("node", F.lit(turn))
    part = F.pmod(order, F.col("parts"))
    lists = Window.partitionBy("token", "part").orderBy("order", "node")
    so_far = lists.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leaders = [
        F.nth_value(F.struct("node", "n", "component"), k + 1).over(so_far)
        for k in range(many)
    ]
    led = live.withColumns({"order": order, "part": part}).withColumn("led", F.array(*leaders))
    # Only those that may be linked are paired; a size is a bound of the overlap.
    others = F.filter(
        "led",
        lambda by: (by["component"] != F.col("component"))
        & ((NUM + DEN) * F.least("n", by["n"]) >= NUM * (F.col("n") + by["n"]).cast("long")),
    )
    both = led.withColumn("led", others).select("node", "n", "weight", F.explode("led").alias("by"))
    counted = both.groupBy("node", "n", "by.node", "by.n").agg(F.sum("weight").alias("c"))
    counted = counted.toDF("node", "n", "other", "m", "c")
    most = F.col("c") + F.greatest(_after_prefix("n"), _after_prefix("m"))
    counted = counted.filter(_overlap_allows(F.least(most, "n", "m"), "n", "m"))
    best = Window.partitionBy("node").orderBy(F.desc("c"), "other")
    ranked = counted.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= many)
    pairs = ranked.select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")
    )
    return stored(pairs.distinct(), "pairs")


def _across(live: DataFrame) -> DataFrame:
    """All pairs of list members in different components that places and counts allow.

    Two nodes cannot share more tokens than either has in these lists. A pair is made at the
    first token that both have, as far as the first few of each tell: that token stands
    earlier in both sets than any other common one, so that it allows what the others allow.
    """
    counts = live.groupBy("node").agg(F.sum("weight").alias("k"))
    by_place = Window.partitionBy("node").orderBy("place", "token")
    heavy = _heavy(live).withColumn("at", F.row_number().over(by_place)).filter(F.col("at") <= FIRST)
    early = heavy.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("at", "token"))).alias("e"))
    early = early.select("node", F.col("e.token").alias("early"))
    left = live.join(counts.join(early, "node", "left"), "node").select(
        "token", "node", "n", "component", "k", "early", (F.col("n") - F.col("place")).alias("rest")
    )
    names = {"node": "b", "n": "m", "rest": "left", "component": "of", "k": "h", "early": "soon"}
    right = left.withColumnsRenamed(names)
    shared = F.least("k", "h") + F.greatest(_after_prefix("n"), _after_prefix("m"))
    most = F.least("rest", "left", shared).cast("long")
    first = F.get(F.array_intersect("early", "soon"), F.lit(0)) == F.col("token")
    pairs = left.withColumnRenamed("node", "a").join(right, "token")
    pairs = pairs.filter(
        (F.col("a") < F.col("b"))
        & (F.col("component") != F.col("of"))
        & _overlap_allows(most, "n", "m")
        & F.coalesce(first, F.lit(True))
    )
    return stored(pairs.select("a", "b").distinct(), "pairs")


def jaccard_components(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row, nothing else.

    ``component_id`` is the smallest id that links reach, the row's own included (null if
    all of them are null). A null or wordless text has no shingles and no link. Repeated
    rows and ids are separate rows; equal texts always have one component.
    """
    spark = df.sparkSession
    source = df.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    texts = source.select("text")
    rows = stored(
        source.mapInArrow(
            _sets_and_sketch, f"id {kind}, digest binary, n int, slice int, counts binary"
        ),
        "sets",
    )
    lists = _lists(texts, spark.sparkContext.broadcast(_sketch(rows)))
    lists = stored(_merged(lists), "lists")
    payloads = _payloads_of(lists.select("node"), texts)
    labels = components(_verify(_led(lists.withColumn("component", F.col("node")), 0), payloads))
    component = _components_of(labels, payloads)
    live = stored(_live(_with_component(lists, component)), "live")
    turn, before, (members, left) = 1, float("inf"), _pairs_left(live)
    while left > PAIRS_LEFT * members and left < WORTH * before:
        # A spanning forest stands for the links of all turns before.
        labels = components(forest(labels).union(_verify(_led(live, turn), payloads)))
        component = _components_of(labels, payloads)
        live = stored(_live(_with_component(live, component)), "live")
        turn, before, (members, left) = turn + 1, left, _pairs_left(live)
    return _labelled(rows, forest(labels).union(_verify(_across(live), payloads)))


def _lists(texts: DataFrame, sketch) -> DataFrame:
    """Prefix tokens that several sets have, with each of these sets that may be linked."""
    schema = "token long, parts int, node long, n int, place int"
    return _with_partners(texts.mapInArrow(_postings(sketch), schema))


def _merged(lists: DataFrame) -> DataFrame:
    """Lists of the same nodes as one, known by a digest of them instead of the token.

    Each row has how many tokens that are, and the first place of them in its set. All these
    sets have the same of these tokens first. A list of one node links nothing and is left
    out; split lists stay as they are.
    """
    by_list = Window.partitionBy("token")
    whole = lists.filter("parts = 1").withColumns(
        {
            "low": F.min("node").over(by_list),
            "high": F.max("node").over(by_list),
            "nodes": F.bit_xor(F.xxhash64("node")).over(by_list),
        }
    )
    whole = whole.filter("low != high").groupBy(F.col("nodes").alias("token"), "parts", "node", "n")
    whole = whole.agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("weight"))
    split = lists.filter("parts > 1").withColumn("weight", F.lit(1).cast("long"))
    return whole.unionByName(split)


def _class(n: str) -> Column:
    return F.pmod(F.floor(F.log(n) / _WIDTH), F.lit(CLASSES)).cast("int")


def least_in_class(n: np.ndarray, class_: int) -> np.ndarray:
    """Prefix tokens that a set of size n shares at least with a linked one of a size class.

    Linked sets of sizes n and m have 3/7 (n + m) tokens in common, of which those after the
    prefix of one of them, and of either, are not shared in the prefixes. Between the sizes of
    a class that bound is least at an end.
    """
    n = n.astype(np.float64)
    own = np.floor(np.log(n) / _WIDTH)
    least = np.full(len(n), np.inf)
    for turn in (0, CLASSES):
        number = own + (class_ - own) % CLASSES - turn
        low = np.maximum(np.exp(number * _WIDTH) * (1 - 1e-6), n * NUM / DEN)
        high = np.minimum(np.exp((number + 1) * _WIDTH) * (1 + 1e-6), n * DEN / NUM)
        for m in (low, high):
            after = np.maximum(n, m) * (NUM / DEN - 1 / EXTRA) + 1
            shared = (n + m) * NUM / (NUM + DEN) - after
            least = np.minimum(least, np.where(low <= high * (1 + 1e-6), shared * (1 - 1e-6), np.inf))
    return np.maximum(least, shared_tokens(-(-NUM * n // DEN)))


def _with_partners(postings: DataFrame) -> DataFrame:
    """Rows of lists that have, in some class, other nodes as often as a linked one would be.

    Split lists count as having nodes of all classes.
    """
    dealt = postings.withColumn("part", F.pmod(F.col("node"), F.col("parts")))
    by_list = Window.partitionBy("token", "part")
    # Nodes of a class that may be linked follow one another.
    order = by_list.orderBy("n", "node")
    dealt = dealt.withColumns(
        {
            "before": F.lag("node").over(order),
            "smaller": F.lag("n").over(order),
            "low": F.min("node").over(by_list),
            "high": F.max("node").over(by_list),
        }
    )
    # The same set may come from several partitions; a list of one set links nothing, but
    # the other parts of a split list may.
    alone = "low = high and parts = 1"
    again = "before is not null and before = node"
    dealt = dealt.filter(f"not ({alone}) and not ({again})").drop("low", "high")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _class("n"))
    second = F.when(_class("smaller") == _class("n"), F.col("bit"))
    dealt = dealt.withColumn("bit", bit).withColumn("second", second)
    dealt = dealt.withColumns(
        {"any": F.bit_or("bit").over(by_list), "two": F.bit_or("second").over(by_list)}
    )
    own, two = F.col("bit"), F.coalesce("two", F.lit(0).cast("long"))
    others = F.col("any").bitwiseAND(F.bitwise_not(own)).bitwiseOR(two.bitwiseAND(own))
    others = F.when(F.col("parts") > 1, F.lit(-1).cast("long")).otherwise(others)
    row = F.struct("token", "parts", "place", others.alias("others"))
    of_node = dealt.groupBy("node", "n").agg(F.collect_list(row).alias("rows"))
    schema = "token long, parts int, node long, n int, place int"
    return of_node.mapInArrow(_often, schema)


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each node whose list has nodes of a class that is often among its lists."""
    for batch in batches:
        nodes, sizes, held = (batch.column(i) for i in range(3))
        rows, counts = held.flatten(), np.diff(held.offsets.to_numpy())
        others = rows.field("others").to_numpy()
        starts = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        n = sizes.to_numpy().astype(np.int64)
        keep = np.zeros(len(others), bool)
        for bit in range(CLASSES if len(others) else 0):
            has = (others >> bit) & 1
            least = least_in_class(n, bit)
            keep |= (has == 1) & (np.add.reduceat(has, starts) >= least)[owner]
        kept = pa.array(np.flatnonzero(keep))
        owner = pa.array(owner[keep])
        token, parts, place = (rows.field(c).take(kept) for c in ("token", "parts", "place"))
        yield pa.RecordBatch.from_arrays(
            [token, parts, nodes.take(owner), sizes.take(owner), place],
            ["token", "parts", "node", "n", "place"],
        )


def _labelled(rows: DataFrame, links: DataFrame) -> DataFrame:
    sets = rows.filter("slice is null")
    classes = sets.filter("n > 0").groupBy("digest").agg(F.min("id").alias("least"))
    roots = components(links).withColumnRenamed("node", "digest")
    rooted = classes.join(roots, "digest", "left").withColumn(
        "root", F.coalesce("root", "digest")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.select("digest", "root").join(least, "root").drop("root")
    some = sets.filter("n > 0").join(labels, "digest")
    none = sets.filter("n = 0").withColumn("component_id", F.col("id"))
    columns = [
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), "component_id"
    ]
    return some.select(*columns).union(none.select(*columns))
