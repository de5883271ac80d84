"""Exact copies, filter audit and centroid search against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelry.llm import equal_average, filter_audit, quotient_dedup
from funnelry.llm.oracle import ORACLE
from funnelry.llm.queries import QUERIES

from checks.compare import duck, rows_of
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NEW = ["op11_quotient_dedup", "op12_filter_audit", "op13_equal_average"]


@pytest.mark.parametrize("name", NEW)
def test_registered_query_agrees_with_sql(spark, name):
    df = QUERIES[name](spark, SF)
    result = duck(SF).execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


# --- exact copies ---------------------------------------------------------------------


@pytest.mark.parametrize("n, bits", [(0, 58), (1, 58), (500, 58), (5000, 12), (3000, 44)])
def test_filter_keeps_values_and_counts(n, bits):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, 1 << bits, n, dtype=np.uint64))
    counts = rng.choice([1, 1, 2, 3, 1 << 40], len(values)).astype(np.int64)
    got = quotient_dedup.unpack(quotient_dedup.pack(values, counts, bits))
    assert np.array_equal(got[0], values) and np.array_equal(got[1], counts)


def test_merged_filters_lose_nothing():
    rng = np.random.default_rng(5)
    parts = [rng.choice(rng.integers(0, 1 << 64, 300, dtype=np.uint64), n) for n in (700, 40, 1)]
    parts.append(parts[0][:90])
    found = defaultdict(list)
    for part in parts:
        for segment, packed in quotient_dedup.segmented(part, 6):
            found[segment].append(packed)
    counted = {}
    for segment, filters in found.items():
        values, counts = quotient_dedup.merge(filters)
        assert (np.diff(values.astype(object)) > 0).all()
        counted |= {(segment << 58) + int(v): int(c) for v, c in zip(values, counts, strict=True)}
    assert counted == Counter(int(x) for part in parts for x in part)


COPIES = [
    (1, "Same Text"), (2, "same text"), (9, "SAME TEXT"), (9, "same text"), (None, "same text"),
    (3, None), (4, ""), (5, "Ä"), (6, "ä"), (7, "only one"), (None, "no id"), (None, "NO ID"),
    (None, "no id"), (8, "x" * 300_000), (10, "X" * 300_000), (11, "x" * 299_999 + "y"),
    *[(100 + i % 30, "shared by many") for i in range(90)],
]


def copies_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        groups[folded].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return Counter(out), len(groups)


@pytest.mark.parametrize("few_bits", [False, True])
def test_exact_copies(spark, monkeypatch, few_bits):
    if few_bits:  # nearly every text is a suspect, and each task hands on many filters
        monkeypatch.setattr(quotient_dedup, "MAX_SUSPECT_BITS", 9)
        monkeypatch.setattr(quotient_dedup, "FILTER_ROWS", 2)
    df = spark.createDataFrame(COPIES, "doc_id long, text string").repartition(7)
    clash = df.withColumns({x: F.lit("mine") for x in ("print", "digest", "row", "kept", "keep_id")})
    out = quotient_dedup.exact_copies(clash).collect()
    expected, groups = copies_by_hand(COPIES)
    assert Counter((r[0], r[1], r[2], r[4]) for r in out) == expected
    kept = [r for r in out if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in kept}) == groups
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_colliding_fingerprints_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(quotient_dedup.F, "xxhash64", lambda *x: F.length(x[0]).cast("long"))
    df = spark.createDataFrame(COPIES, "doc_id long, text string")
    out = quotient_dedup.exact_copies(df).collect()
    expected, groups = copies_by_hand(COPIES)
    assert Counter((r[0], r[1], r[2], r[4]) for r in out) == expected
    assert sum(r["kept"] for r in out) == groups


def test_no_copies_of_nothing(spark):
    assert quotient_dedup.exact_copies(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- filter audit ---------------------------------------------------------------------


def fails_by_hand(text):
    words, text = WORD.findall(text or ""), text or ""
    return (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        any(c in "#$%&*|" for c in text),
    )


def audit_by_hand(docs, labels):
    good, toxic = defaultdict(bool), defaultdict(bool)
    for i, q, t in labels:
        good[i] |= q == 1 and i is not None
        toxic[i] |= t == 1 and i is not None
    rows = []
    for i, text, lang in docs:
        earlier = i is not None and any(
            j is not None and j < i and (t or "") == (text or "") for j, t, _ in docs
        )
        fails = dict(zip("ABCDE", (*fails_by_hand(text), earlier), strict=True))
        rows.append((lang or "", fails, good[i], toxic[i]))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        mine = [r[1:] for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if r[0][letter]]
                late = [r for r in mine if r[0][letter] and r not in left]
                late = sum(r[0][letter] and any(r[0][x] for x in order[: step - 1]) for r in mine)
                left = [r for r in left if not r[0][letter]]
                alone = sum(r[0][letter] and sum(r[0].values()) == 1 for r in mine)
                counts = (len(left), len(gone), late, alone, sum(r[1] for r in gone), sum(r[2] for r in gone))
                out[part, "".join(order), step] = counts
                shapley[part, letter] += len(gone)
    return {(p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_intervals_cover_each_order_once():
    orders = list(itertools.permutations(range(4)))
    found = Counter()
    for mask, step, start, stop, late in filter_audit.rank_intervals(4):
        found.update((mask, step, rank, late) for rank in range(start, stop))
    for mask in range(1, 16):
        for rank, order in enumerate(orders):
            failing = [s for s, x in enumerate(order, 1) if mask >> x & 1]
            assert found[mask, failing[0], rank, False] == 1
            assert all(found[mask, s, rank, True] == 1 for s in failing[1:])
    assert max(found.values()) == 1
    assert sum(found.values()) == sum(24 * m.bit_count() for m in range(16))


def test_audit_of_awkward_documents(spark):
    rng = random.Random(8)
    long = " ".join(f"w{i}" for i in range(300))
    texts = [
        None, "", "ONLY CAPITALS", "a b # c", long, long, long.upper(), long + " #", "x " * 200,
        "x " * 200 + "$", "é" * 50 + " AB", " ".join(f"v{i % 90}" for i in range(100)),
        " ".join(f"v{i % 80}" for i in range(100)), " ".join(f"v{i % 79}" for i in range(100)),
        "w " * 50_000, "A" + "b" * 9, "A" + "b" * 8,
    ]
    docs = [
        (rng.choice([None, *range(12)]), rng.choice(texts), rng.choice(["de", "en", "", None]))
        for _ in range(160)
    ]
    docs.append((99, long, "clean"))
    labels = [(rng.choice([None, *range(12)]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    df = df.withColumns({x: F.lit("mine") for x in ("part", "mask", "id", "digest", "good", "n", "rank")})
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(1))
    out = filter_audit.audit_documents(spark, df, known)
    assert {tuple(r) for r in out.collect()} == audit_by_hand(docs, labels)
    assert out.count() == 600 * len({d[2] or "" for d in docs})
    assert "CartesianProduct" not in plan_of(out)


def test_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_documents(spark, docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "en")], docs.schema)
    assert filter_audit.audit_documents(spark, one, labels).count() == 600


# --- centroid search ------------------------------------------------------------------


def nearest_by_hand(vector, centroids):
    return min((sum((x - y) ** 2 for x, y in zip(vector, c, strict=True)), i) for i, c in enumerate(centroids))


@pytest.mark.parametrize("size, top", [(64, 5), (64, 300), (64, 1 << 24), (3, 2), (1, 1)])
def test_nearest_centroid_with_ties(size, top):
    rng = np.random.default_rng(top)
    vectors = rng.integers(-top, top + 1, (400, size))
    centroids = np.concatenate([rng.integers(-top, top + 1, (12, size)), vectors[:3], vectors[:1]])
    cluster, distance = equal_average.nearest(vectors, centroids)
    lists = centroids.tolist()
    expected = [nearest_by_hand(v, lists) for v in vectors.tolist()]
    assert list(zip(distance.tolist(), cluster.tolist(), strict=True)) == expected
    assert [equal_average.nearest_exact(v, lists)[::-1] for v in vectors.tolist()] == expected


@pytest.mark.parametrize("value", [0, 1, -1, (1 << 30) - 1, -(1 << 30), 1 << 90, -(1 << 90) - 7])
def test_digits(value):
    parts = equal_average.digits(value)
    assert sum(d << equal_average.DIGIT_BITS * i for i, d in enumerate(parts)) == value
    assert all(abs(d) <= 1 << equal_average.DIGIT_BITS for d in parts)


def clusters_by_hand(rows, size, k, rounds):
    kept = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    sha = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (sha(r[0]), r[1]))[:k]]
    for _ in range(rounds):
        mine = defaultdict(list)
        for _, v in kept:
            mine[nearest_by_hand(v, centroids)[1]].append(v)
        centroids = [
            [sum(x) // len(mine[i]) for x in zip(*mine[i], strict=True)] if mine[i] else c
            for i, c in enumerate(centroids)
        ]
    found = [(i, *nearest_by_hand(v, centroids)) for i, v in kept]
    total, each = sum(d for _, d, _ in found), Counter()
    for _, d, c in found:
        each[c] += d
    fits = lambda x: x if x < 1 << 63 else None
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    every = None if total >= 1 << 63 else total
    return Counter((i, c, fits(d), fits(each[c]), every, text[c]) for i, d, c in found)


@pytest.mark.parametrize("huge", [False, True])
@pytest.mark.parametrize("size, k", [(4, 5), (64, 16)])
def test_clusters(spark, huge, size, k):
    rng = random.Random(size)
    rows = [(rng.choice([None, *range(60)]), [rng.uniform(-2, 2) for _ in range(size)]) for _ in range(90)]
    rows += [(5, rows[0][1]), (5, rows[0][1]), (6, None), (7, [1.0]), (8, [1.0] * (size - 1) + [None])]
    rows += [(9, [float("nan")] * size), (10, [float("inf")] * size), (11, []), (12, [0.0] * size)]
    if huge:
        rows += [(200 + i, [10.0 ** (9 + 10 * i)] * (size - 1) + [-3.7e25]) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    df = df.withColumns({"cluster": F.lit("mine"), "distance": F.lit(1)})
    out = equal_average.cluster_vectors(spark, df, size=size, centroids=k)
    assert Counter(tuple(r) for r in out.collect()) == clusters_by_hand(rows, size, k, 3)


def test_few_vectors_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(1, [0.5, -0.01]), (2, None)], schema)
    assert [tuple(r)[:5] for r in equal_average.cluster_vectors(spark, one, size=2).collect()] == [(1, 0, 0, 0, 0)]
    for rows in ([], [(2, None)]):
        assert equal_average.cluster_vectors(spark, spark.createDataFrame(rows, schema)).count() == 0
