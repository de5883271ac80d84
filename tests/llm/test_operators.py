"""The llm operators against brute force, on small tables with awkward rows."""

from __future__ import annotations

import base64
import fnmatch
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import Window
from pyspark.sql import functions as F

from funnelry.llm import bpe, cotraining, crf_language, jaccard_join, private_spans, topk, url_globs
from funnelry.llm.components import components
from funnelry.llm.cotraining import PSEUDO, SURE, _given, _moments, _newton, _views, cotrain, quality_scores
from funnelry.llm.crf_language import Field, forward_backward, learn, predict_column, words_of
from funnelry.llm.jaccard_join import jaccard_components, word_hashes
from funnelry.llm.mixing import measured, mix_sources, repeat_rows
from funnelry.llm.quality_rules import quality_rules
from funnelry.llm.shard_tree import descend, regular_tree, shard_rows
from funnelry.llm.topk import top_k

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RNG = random.Random(3)
VOCABULARY = ["the", "of", "Ärger", "der", "une", "x", "Tion", "straße", "ñandú", "#tag", "a|b"]


def text_of(n: int, rng: random.Random = RNG) -> str:
    return "".join(rng.choice(VOCABULARY) + rng.choice([" ", " ", "\n", "\t", "  "]) for _ in range(n))


LONG = " ".join(f"w{i % 700} v{i}" for i in range(20_000))
TEXTS = [
    None, "", "   \n", "one", "one two three four", *[text_of(n) for n in (3, 60, 60, 200, 400)],
    LONG, "a b c " * 40, "same line here\n" * 30, "same line here\n" * 30,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 3}" if i % 5 else None, len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id at all here", "s0", 5), (3, "one", "s0", 3), (3, "one", "s0", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long")


def measured_by_hand(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(map(text.count, "#*$%&|<>"))
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules(docs):
    clash = docs.withColumn("quality", F.lit("mine")).withColumn("n_words", F.lit(1))
    out = quality_rules(clash).collect()
    assert len(out) == docs.count()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for row in out:
        assert tuple(row["quality"][x] for x in names) == measured_by_hand(row["text"])
        assert row["quality"]["kept"] == (not row["quality"]["failed"])
    assert quality_rules(docs.limit(0)).count() == 0


def test_descent_moves_only_into_what_grew(spark):
    ids = spark.range(4000).withColumn("id", F.expr("if(id = 7, null, id)"))
    trees = [regular_tree(n) for n in (23, 24, 25, 26)]
    rows = ids.select(*[descend("id", t).alias(f"s{i}") for i, t in enumerate(trees)]).collect()
    for k, new in enumerate((23, 24, 25)):
        moved = [r for r in rows if r[k] != r[k + 1]]
        assert moved and all(r[k + 1] == new for r in moved)
    heavier = regular_tree(24)
    heavier[1][0][13] = 3.0
    changed = ids.select(descend("id", regular_tree(24)).alias("a"), descend("id", heavier).alias("b"))
    assert {r["b"] for r in changed.filter("a != b").collect()} == {13}
    counts = Counter(r["s1"] for r in rows)
    assert len(counts) == 24 and max(counts.values()) < 1.5 * min(counts.values())


def test_slots_have_no_gaps(docs):
    out = shard_rows(docs, "doc_id", regular_tree(4), regular_tree(5), ["text"]).collect()
    for shard in {r["shard"] for r in out}:
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 4) for r in out)
    assert shard_rows(docs.limit(0), "doc_id", regular_tree(4)).count() == 0


def test_mix_meets_targets(spark, docs):
    rng = random.Random(1)
    many = [(i, text_of(rng.randint(0, 80), rng), rng.choice("aaabcd") if i % 9 else None) for i in range(500)]
    df = spark.createDataFrame(many, "doc_id long, text string, source string")
    out = mix_sources(measured(df)).toPandas()
    again = mix_sources(measured(df.repartition(7))).toPandas()
    assert dict(zip(out.doc_id, out.taken, strict=True)) == dict(zip(again.doc_id, again.taken, strict=True))
    size = {i: len(WORD.findall(t)) for i, t, _ in many}
    totals = Counter()
    for i, _, s in many:
        totals[s] += size[i]
    order = sorted((s for s in totals if s is not None)) + [None]
    weight = {s: [3, 1, 2][i % 3] for i, s in enumerate(order)}
    goal, capped = 1.5 * sum(totals.values()), set()
    while True:
        left = goal - sum(2 * totals[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and 2 * totals[s] <= left * weight[s] / free}
        if not over:
            break
        capped |= over
    longest = max(size.values())
    for s in order:
        rows = out[out.source.isna() if s is None else out.source == s]
        target = 2 * totals[s] if s in capped else left * weight[s] / free
        assert rows.target.iloc[0] == pytest.approx(target)
        assert abs(rows.taken.sum() - target) <= longest / 2 + 1
    assert (out.taken <= 2 * out["size"]).all()
    assert repeat_rows(mix_sources(measured(df))).count() == out.copies.sum()
    assert mix_sources(measured(docs)).count() == docs.count()
    assert mix_sources(measured(docs.limit(0))).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(0)
    vectors = [rng.normal(0, 0.2, 6).tolist() for _ in range(400)]
    vectors[10] = vectors[20] = vectors[30]
    rows = list(enumerate(vectors))
    rows += [(400, None), (401, [0.1, None, 0.2]), (450, [float("nan")] * 6), (500, [float("inf")] * 6), (None, vectors[1]), (402, [0.3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = top_k(df, "vec_id", "embedding", 50).collect()
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows[:400]} | {402: np.array([76, 0, 0, 0, 0, 0])}
    expected = set()
    for q in range(0, 400, 50):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        expected |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    assert {tuple(r) for r in out} == expected and len(out) == len(expected)
    few = top_k(df.filter("vec_id in (0, 1, 2)"), "vec_id", "embedding", 50).collect()
    assert [(r["query_id"], r["rank"]) for r in few] == [(0, 1), (0, 2)]


@pytest.mark.parametrize("small", [False, True])
def test_top_k_of_repeated_ids_and_large_components(spark, monkeypatch, small):
    if small:
        for name, value in {"VECTORS": 7, "QUERIES": 2, "PASSING": 1}.items():
            monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(0, s, 4).tolist()) for i, s in zip(rng.integers(0, 20, 60), [0.2, 1e7, 1e16] * 20, strict=True)]
    rows += [(0, [1.0, 0.0, 0.0, 0.0]), (1, [1.0, 0.0]), (1, [3.0]), (2, [1e7, 0.0]), (10, [1e300, 1e305]), (11, [-1e300, 1.0]), (10, [1e308] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    whole = [(i, [int(Fraction(x) * 256 // 1) for x in v] + [0] * (4 - len(v))) for i, v in rows]
    expected = Counter()
    for at, (q, x) in enumerate(whole):
        if q % 5 == 0:
            others = [(-sum(a * b for a, b in zip(x, v, strict=True)), i) for j, (i, v) in enumerate(whole) if j != at]
            for rank, (s, i) in enumerate(sorted(others)[:5], 1):
                expected[q, rank, i, -s if -(2**63) <= -s < 2**63 else None] += 1
    assert Counter(tuple(r) for r in top_k(df, "vec_id", "embedding", 5).collect()) == expected
    assert top_k(df.limit(0), "vec_id", "embedding", 5).count() == 0
    assert top_k(df.limit(0), "vec_id", "embedding", 50).count() == 0


@pytest.fixture(scope="module")
def codec():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encoding(open(path, "rb").read(), public_tokenizers.PATTERN)


def test_bpe_columns(spark, docs, codec):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = docs.select("text", bpe.encode_column(spark, F.col("text"), path, pattern).alias("ids"))
    out = ids.withColumn("raw", bpe.decode_column(spark, F.col("ids"), path, pattern)).collect()
    for row in out:
        text = row["text"] or ""
        assert np.frombuffer(row["ids"], "<u4").tolist() == codec.encode_ordinary(text)
        assert bytes(row["raw"]) == text.encode()
    assert base64.b64decode(open(path, "rb").readline().split()[0]) in codec._mergeable_ranks
    assert isinstance(codec, tiktoken.Encoding)


@pytest.mark.parametrize("run", [" " * 1000, "\n \t" * 500, "\x1c " * 400, "ab1!" * 300])
def test_bpe_pieces(codec, run):
    text = "It's  über 12 " * 30 + run + "x \n y" + run
    assert bpe.encode(codec, text, 50).tolist() == codec.encode_ordinary(text)
    assert "".join(bpe.pieces(text, 50)) == text


def test_bpe_long_runs(codec):
    run = " " * (bpe.LONG_RUN + 7)
    for text in (run, run + "x", "y" + run + "\n" + "z", "a b " + run):
        assert bpe.encode(codec, text, 100).tolist() == codec.encode_ordinary(text)
    assert len(bpe.encode(codec, " " * 3_000_000 + "x")) > 0


def components_by_hand(rows: list[tuple]) -> list:
    sets = []
    for _, text in rows:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(x: int) -> int:
        return x if root[x] == x else find(root[x])

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 75 * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    ids: dict = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(
        ((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=str,
    )


def test_jaccard_join(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 3000)}"
    passage = [word() for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for group in range(12):
        base = [word() for _ in range(rng.randint(5, 120))]
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = word()
            if group % 4 == 0:
                copy += passage
            rows.append((len(rows), " ".join(copy).title()))
    rows += [(None, rows[-1][1]), (rows[-1][0], rows[-1][1]), (None, None), (3, "ONE")]
    rows += [(i, " ".join(["tok"] + [f"n{j}" for j in range(7)] + [f"t{i}"])) for i in range(900, 905)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard_components(df.withColumn("n", F.lit(0)).repartition(5))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()), key=str)
    assert got == components_by_hand(rows)
    assert jaccard_components(df.limit(0)).count() == 0


def test_half_alike_sets_leave_the_lists(spark):
    rng = random.Random(8)
    fresh = lambda n: [f"u{rng.getrandbits(60)}" for _ in range(n)]
    texts = []
    for _ in range(20):
        passage = fresh(40)
        texts += [" ".join(passage + fresh(200 + i)) for i in range(3)]
    base = fresh(240)
    texts += [" ".join(base[:-5] + fresh(5)), " ".join(base), " ".join(base + fresh(60))]
    rows = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
    counts = np.zeros(1 << jaccard_join.SKETCH_BITS, np.uint8)
    lists = jaccard_join._lists(rows, spark.sparkContext.broadcast(counts)).collect()
    nodes = [jaccard_join._node(jaccard_join._digest(jaccard_join.shingles(t.encode()))) for t in texts]
    assert {r["node"] for r in lists} == set(nodes[-3:])
    by_size = sorted((texts.index(t), t) for t in texts)
    got = jaccard_components(spark.createDataFrame(by_size, "doc_id long, text string")).collect()
    assert sorted(r["component_id"] for r in got) == sorted([*range(60), 60, 60, 60])


def test_shared_prefix_tokens_of_size_classes():
    after = lambda n: n - jaccard_join.prefix_length(n, jaccard_join.shared_tokens(n))
    for n in [*range(1, 130), 480, 999, 5003]:
        least = [jaccard_join.least_in_class(np.array([n]), c)[0] for c in range(jaccard_join.CLASSES)]
        for m in range(-(-3 * n // 4), 4 * n // 3 + 1):
            common = -(-75 * (n + m) // 175)
            class_ = int(np.floor(np.log(m) / jaccard_join._WIDTH)) % jaccard_join.CLASSES
            assert 1 <= least[class_] <= common - max(after(n), after(m)), (n, m)
    assert min(jaccard_join.least_in_class(np.array([480]), c)[0] for c in range(64)) >= 12


def _half_alike(rng, groups: int = 8, members: int = 6) -> list[str]:
    """Groups of texts with a passage of three fifths in common, and a near copy in each."""
    fresh = lambda n: [f"u{rng.getrandbits(60)}" for _ in range(n)]
    texts = []
    for _ in range(groups):
        passage = fresh(180)
        texts += [" ".join(passage + fresh(120)) for _ in range(members)]
        texts.append(texts[-1] + " more words")
    return texts


def test_lists_of_the_same_sets_are_one(spark):
    texts = _half_alike(random.Random(21))
    rows = spark.createDataFrame([(t.encode(),) for t in texts], "text binary")
    # Tokens in order of their hash alone.
    counts = spark.sparkContext.broadcast(np.zeros(1 << jaccard_join.SKETCH_BITS, np.uint8))
    lists = jaccard_join._lists(rows, counts).persist()
    merged = jaccard_join._merged(lists).collect()
    assert len(merged) * 10 < lists.count()
    tokens_of, weights_of = {}, {}
    for r in lists.collect():
        tokens_of.setdefault(r["node"], set()).add(r["token"])
    for r in merged:
        weights_of.setdefault(r["node"], {})[r["token"]] = r["weight"]
    for a, b in itertools.combinations(sorted(tokens_of), 2):
        shared = weights_of.get(a, {}).keys() & weights_of.get(b, {}).keys()
        assert sum(weights_of[a][t] for t in shared) == len(tokens_of[a] & tokens_of[b])
    lists.unpersist()


def test_words_of_half_alike_sets_are_not_sent(spark, monkeypatch):
    texts = _half_alike(random.Random(22))
    sent = []
    store = jaccard_join.stored
    monkeypatch.setattr(
        jaccard_join, "stored", lambda df, name: sent.append((name, store(df, name))) or sent[-1][1]
    )
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard_components(df).collect()), key=str)
    assert got == components_by_hand(list(enumerate(texts)))
    # One pair of each group is linked, and only these are verified on words.
    assert sum(found.count() for name, found in sent if name == "likely") == 8
    assert sum(found.count() for name, found in sent if name == "links") == 8
    assert [name for name, _ in sent].count("payloads") == 1


def test_leaders_that_cannot_be_linked_are_not_paired(spark):
    # Two lists: sizes 100, 101 and 400; two nodes of one component.
    rows = [(1, 1, 1, 100, 0, 1, 90), (1, 1, 2, 101, 0, 2, 90), (1, 1, 3, 400, 0, 3, 90)]
    rows += [(2, 1, 4, 100, 0, 9, 95), (2, 1, 5, 101, 0, 9, 95)]
    schema = "token long, parts int, node long, n int, place int, component long, weight long"
    live = spark.createDataFrame(rows, schema)
    led = jaccard_join._led(live, 1)
    assert [tuple(r) for r in led.collect()] == [(1, 2)]
    assert jaccard_join._pairs_left(live) == (5, 3)


def test_outlines_allow_all_linked_pairs():
    rng = np.random.default_rng(23)
    for n in (1, 2, 7, 8, 30, 127, 128, 129, 500, 1100):
        for m in sorted({-(-3 * n // 4), n, 4 * n // 3}):
            tokens = rng.integers(0, 1 << 63, n + m, dtype=np.uint64)
            common = -(-75 * (n + m) // 175)
            if common > min(n, m):
                continue
            for c in (common, common // 2):
                x, y = tokens[:n], np.concatenate([tokens[:c], tokens[n : n + m - c]])
                allow = jaccard_join.outlines_allow(
                    n, m, jaccard_join.outline(x), jaccard_join.outline(y)
                )
                assert allow or c < common, (n, m)
                assert not allow or c == common or n < 100, (n, m)


def test_jaccard_join_of_split_lists_in_several_turns(spark, monkeypatch):
    texts = _half_alike(random.Random(24), groups=3, members=5)
    rng = random.Random(25)
    base = texts[0].split()
    for _ in range(15):
        copy = list(base)
        for _ in range(rng.randint(1, 8)):
            copy[rng.randrange(len(copy))] = f"v{rng.getrandbits(40)}"
        texts.append(" ".join(copy))
    monkeypatch.setattr(jaccard_join, "PAIRS_LEFT", 0)
    monkeypatch.setattr(jaccard_join, "FIRST", 1)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = components_by_hand(list(enumerate(texts)))
    got = sorted((tuple(r) for r in jaccard_components(df).collect()), key=str)
    assert got == want
    # As if each token were in some 200 000 sets: all lists are split.
    many = np.full(1 << jaccard_join.SKETCH_BITS, 141, np.uint8)
    monkeypatch.setattr(jaccard_join, "_sketch", lambda rows: many)
    got = sorted((tuple(r) for r in jaccard_components(df).collect()), key=str)
    assert got == want


def test_word_hashes_of_long_texts():
    words = [b"x" * 300_000, b"Ab", b"ab", b"c"] * 3 + [b"d"] * 200_000
    hashes = word_hashes(b" ".join(words))
    assert len(hashes) == len(words)
    assert len(set(hashes.tolist())) == 4 and hashes[1] == hashes[2]
    assert word_hashes(b"ab c").tolist() == hashes[2:4].tolist()


def test_components_of_a_path(spark):
    edges = spark.range(60).selectExpr("id as a", "id + 1 as b").filter("a != 30")
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    assert roots == {i: 0 if i <= 30 else 31 for i in range(61)}


CASES = [
    ("mail john [at] example [dot] com now", [("email", "john [at] example [dot] com")]),
    ("john at example dot com", [("email", "john at example dot com")]),
    ("jоhn@exаmple.com", [("email", "jоhn@exаmple.com")]),
    ("joh​n@exam​ple.com is", [("email", "joh​n@exam​ple.com")]),
    ("１９２.168.0.1", [("ip", "１９２.168.0.1")]),
    ("one nine two dot one six eight dot one dot one end", [("ip", "one nine two dot one six eight dot one dot one")]),
    ("four" + " one" * 15, [("card", "four" + " one" * 15)]),
    ("plus four four two zero seven nine four six one", [("phone", "plus four four two zero seven nine four six one")]),
    ("john at mail.example dot com", [("email", "john at mail.example dot com")]),
    ("j-at-a.b.example [dot] co.uk!", [("email", "j-at-a.b.example [dot] co.uk")]),
    ("look at at example dot com", [("email", "at at example dot com")]),
    ("look at mail.example.com or so dot then", []),
    ("look at example.com one or two at six", []),
    ("un deux trois, the dot and the point", []),
]


@pytest.mark.parametrize("text, expected", CASES)
def test_disguises(text, expected):
    found = private_spans.private_spans(text)
    assert [(k, text[a:b]) for k, a, b, _ in found] == expected
    assert not any(base for *_, base in found)


PARTLY = [
    ("email", "hn@example.com", "jоhn@example.com"),
    ("email", "hn@example.com", "jo​hn@example.com"),
    ("email", "john@example.c", "john@example.cоm"),
    ("ip", "192.168.1.1", "192.168.1.1２"),
    ("phone", "+1 (017) 555-771", "+1 (017) 555-771３"),
]


@pytest.mark.parametrize("kind, plain, whole", PARTLY)
def test_disguised_in_part(kind, plain, whole):
    text = f"so {whole}, then"
    found = private_spans.private_spans(text)
    assert {(k, text[a:b], base) for k, a, b, base in found} == {(kind, plain, True), (kind, whole, False)}
    assert private_spans.redact(text, found) == f"so [{kind.upper()}], then"


def test_base_spans():
    patterns = [
        re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        re.compile(r"[0-9]([\x20-]?[0-9])+"),
        re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]

    def right(kind: int, found: str) -> bool:
        digits = re.sub(r"[^0-9]", "", found)
        if kind == 1:
            return all(int(p) <= 255 for p in found.split("."))
        if kind == 2:
            return 12 <= len(digits) <= 19 and private_spans.luhn(digits)
        return kind == 0 or 9 <= len(digits) <= 15

    rng = random.Random(9)
    parts = ["a", "b.c", "@", "@x.de", "1", "255", "256", ".", "-", " ", "+", "(", ")", "4111111111111111", "é", "+49 30 1234567"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        expected = sorted(
            (m.start(), k, m.end()) for k, p in enumerate(patterns) for m in p.finditer(text) if right(k, m[0])
        )
        assert sorted((a, k, b) for k, a, b in private_spans.detect(text)) == expected, text


def test_spans_and_redaction(docs):
    text = "I am a@b.de, call +1 (017) 555-7713 or 10.0.0.1."
    spans = private_spans.private_spans(text)
    assert private_spans.redact(text, spans) == "I am [EMAIL], call [PHONE] or [IP]."
    assert private_spans.redact("x", []) == "x"
    out = docs.select("text", private_spans.find_private("text").alias("s"), private_spans.redact_private("text").alias("r"))
    assert all(r["r"] == r["text"] and r["s"] == [] for r in out.collect())
    assert private_spans.private_spans("1" * 200_000 + " " + "a" * 200_000) == []
    assert len(private_spans.private_spans("a-at-" * 40_000 + "b dot c")) == 1


def test_url_globs_against_fnmatch():
    rng = random.Random(2)
    globs = ["*casino*", "a?c/**", "**", "x*/y/**z", "", "?" * 70, "ab" * 40, "**/" * 3 + "q"]
    texts = ["", "/", "abc/", "x1/y/z", "x/1/y/z", "ab" * 40, "a/b/c/q", "é" * 70, "casino"]
    texts += ["".join(rng.choice("abcxyzq/") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    found = url_globs.match(url_globs.compile_globs(globs), texts)
    for j, glob in enumerate(globs):
        rule = re.compile("".join({"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(x, re.escape(x)) for x in re.findall(r"\*\*|.", glob)), re.S)
        assert [bool(rule.fullmatch(t)) for t in texts] == found[:, j].tolist(), glob
    assert fnmatch.fnmatchcase("casino", "*casino*")


def test_judged_urls(spark):
    expected = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "x.com/en/": ("", "", None, "allow"),
        "http://A.Example.COM/en/1?q#f": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
        "http://casino-win.org/x": ("casino-win.org", "/x", None, "block"),
        "http://good.org/casino/a.com/": ("good.org", "/casino/a.com/", None, "allow"),
        "http://good.org/" + "y" * 5000: ("good.org", "/" + "y" * 5000, None, "allow"),
    }
    df = spark.createDataFrame([(u,) for u in expected], "url string")
    out = df.select("url", url_globs.judge_urls(F.col("url")).alias("x")).collect()
    assert {r["url"]: tuple(r["x"]) for r in out} == expected


def test_forward_backward():
    rng = np.random.default_rng(4)
    scores, moves, start = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    both, _ = forward_backward(scores, moves, start, np.array([4, 2]))
    labelled, none = forward_backward(scores, moves, start, np.array([4, 2]), moved=False)
    assert none is None and (labelled == both).all()
    for chain, length in ((0, 4), (1, 2)):
        sums = np.zeros((length, 3))
        for path in itertools.product(range(3), repeat=length):
            w = start[path[0]] + sum(scores[chain, t, y] for t, y in enumerate(path))
            w += sum(moves[a, b] for a, b in itertools.pairwise(path))
            for t, y in enumerate(path):
                sums[t, y] += np.exp(w)
        assert np.allclose(both[chain, :length], sums / sums.sum(axis=1, keepdims=True))


def test_language(spark):
    rng = random.Random(8)
    words = {"en": ["the", "thing", "with", "house", "that"], "de": ["der", "schön", "und", "haus", "nicht"]}
    rows = [(i, " ".join(rng.choices(words[x], k=40)), x) for i in range(120) for x in [("en", "de")[i % 2]]]
    rows += [(200, None, "en"), (201, "12 ++", None), (202, "the thing " * 9 + "der haus", None), (None, "the thing", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn(df)
    out = df.select("doc_id", "lang", predict_column(model, df, F.col("text")).alias("x")).collect()
    got = {r["doc_id"]: r["x"] for r in out}
    assert all(got[i]["lang_pred"] == x for i, _, x in rows[:120])
    assert got[200]["lang_pred"] == got[201]["lang_pred"] == "und" and got[202]["lang_pred"] == "en"
    mixed = model.label([words_of("the thing with that house der schön und haus nicht")])[0]
    assert [model.languages[i] for i in mixed.argmax(axis=1)] == ["en"] * 5 + ["de"] * 5
    assert learn(df.limit(0)) is None
    none = df.select(predict_column(None, df, F.col("text")).alias("x")).distinct().collect()
    assert [tuple(r["x"]) for r in none] == [("und", 0.0)]


@pytest.mark.parametrize("chain", [1, 3, 64])
def test_long_texts_are_one_chain(monkeypatch, chain):
    monkeypatch.setattr(crf_language, "CHAIN", chain)
    monkeypatch.setattr(crf_language, "AT_ONCE", 150)
    rng = np.random.default_rng(chain)
    words = [f"w{chr(97 + i)}" for i in range(9)]
    rows = {f"l{w}": i for i, w in enumerate(words)}
    model = Field(["a", "b", "c"], rows, rng.normal(0, 3, (10, 3)), rng.normal(0, 2, (3, 3)), rng.normal(size=3))
    texts = [rng.choice(words, n).tolist() for n in (0, 1, 3, 4, 65, 0, 700, 128, 7)]
    for text, found in zip(texts, model.label(texts), strict=True):
        assert found.shape == (len(text), 3)
        if text:
            scores = model.weights[[rows[f"l{w}"] for w in text]][None]
            assert np.allclose(found, forward_backward(scores, model.moves, model.start, np.array([len(text)]))[0][0])


def test_many_languages_numerals_and_long_words(spark):
    lexicon = {f"x{k:02d}": [f"{chr(97 + k % 26)}{chr(97 + k // 26)}{v}" for v in ("no", "ta", "ri", "su")] for k in range(70)}
    rows = [(100 * k + i, " ".join(RNG.choices(words, k=30)), lang) for k, (lang, words) in enumerate(lexicon.items()) for i in range(6)]
    rows += [(9000 + i, t, None) for i, t in enumerate(["½ ² Ⅷ", "١٢", "²a"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = df.select("doc_id", "lang", predict_column(learn(df), df, F.col("text")).alias("x")).collect()
    assert sum(r["x"]["lang_pred"] == r["lang"] for r in out) >= 0.95 * 420
    und = {r["doc_id"]: r["x"]["lang_pred"] == "und" for r in out}
    assert und[9000] and und[9001] and not und[9002]
    assert crf_language.bounds(4) == (200, 300)
    for n in (1, 70, 500, 5000):
        texts, words = crf_language.bounds(n)
        assert texts >= 1 and words >= 16 and (words == 16 or texts * words * n * n <= crf_language.SAMPLE)
    long = "a" * 20 + "middle" + "b" * 20
    assert {"mid", "ddl"} <= set(crf_language.features_of(long))


def test_cotraining(spark):
    rng = random.Random(6)
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = " ".join(("spam%%%" if bad and rng.random() < 0.7 else f"word{rng.randint(0, 200)}") for _ in range(60))
        rows.append((i, text, "bad.example" if bad else "good.example", "en", len(text)))
        if i % 3 == 0:
            marks.append((i, 0 if bad else 1))
    rows += [(900, None, None, None, None), (None, "", None, None, 0)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    pages = spark.createDataFrame([(1, "http://x.org/en/4"), (2, None), (3, "odd")], "page_id long, url string")
    labels = spark.createDataFrame(marks + [(5, None)], "doc_id long, quality int")
    out = quality_scores(documents, pages, labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert sum(kept[i] == (i % 4 != 0) for i in range(400)) >= 390
    assert {r["score"] for r in quality_scores(documents, pages, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(documents.limit(0), pages, labels).count() == 0


def test_cotraining_takes_all_unlabelled_rows(spark):
    rng = np.random.default_rng(8)
    n, marked = 9000, 1200
    truth = rng.random(n) < 0.6
    text, meta = (truth[:, None] * 0.8 + rng.normal(0, 1, (n, k)) for k in (5, 3))
    rows = [
        (i, x.astype(np.float32).tobytes(), y.astype(np.float32).tobytes(), float(z) if i < marked else None, hash((i, "row")) >> 1)
        for i, (x, y, z) in enumerate(zip(text, meta, truth, strict=True))
    ]
    df = spark.createDataFrame(rows, "id long, features binary, meta binary, label double, hash long").repartition(7)
    pool = df.filter("label is null").select("id", "features", "meta", "hash")
    known = df.filter("label is not null").orderBy("id").toPandas()
    model, rounds = cotrain(known, pool)
    rest = pool.toPandas()
    views, hashes = _views(rest), rest["hash"].to_numpy()
    # Sure rows of the whole pool get labels, at the classes' shares, up to the rounds' share.
    right = truth[rest["id"]]
    for done in range(1, len(rounds) + 1):
        for label, least in zip(_given(views, hashes, rounds[:done]), (0.05, 0.0), strict=True):
            some = label >= 0
            assert least * len(rest) <= some.sum() <= 1.01 * done * SURE * len(rest)
            if some.sum() > 300:
                assert (label[some] == right[some]).mean() > 0.9
                assert abs(label[some].mean() - truth[:marked].mean()) < 0.05
    # The weights are those of a fit over the labelled and all pseudo-labelled rows.
    fit = np.arange(len(known)) % 4 > 0
    for v, label in enumerate(_given(views, hashes, rounds)[::-1]):
        x = np.vstack([_views(known)[v][fit], views[v][label >= 0]])
        y = np.concatenate([known["label"].to_numpy()[fit], label[label >= 0]])
        k = min(PSEUDO, fit.sum() / max(1, (label >= 0).sum()))
        parts = [(x[: fit.sum()], y[: fit.sum()], 1.0), (x[fit.sum() :], y[fit.sum() :], k)]
        by_hand = _newton(lambda w: [sum(m * _moments(a, b, w[0]) for a, b, m in parts)], [np.zeros(x.shape[1] + 1)])[0]
        assert np.allclose(by_hand, [model.text, model.meta][v], atol=1e-3)


def test_a_view_that_knows_nothing_labels_nothing(spark):
    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.85
    text = (truth * 4.0 + rng.normal(0, 1, 4000))[:, None]
    meta = rng.normal(0, 1, (4000, 2))
    rows = [(x.astype(np.float32).tobytes(), y.astype(np.float32).tobytes(), float(z) if i < 800 else None, i * 7919)
            for i, (x, y, z) in enumerate(zip(text, meta, truth, strict=True))]
    df = spark.createDataFrame(rows, "features binary, meta binary, label double, hash long")
    pool = df.filter("label is null").select("features", "meta", "hash")
    _, rounds = cotrain(df.filter("label is not null").toPandas(), pool)
    views, hashes = _views(pool.toPandas()), pool.toPandas()["hash"].to_numpy()
    by_text, by_meta = _given(views, hashes, rounds)
    assert (by_text >= 0).sum() > 0.1 * len(hashes) and (by_meta >= 0).sum() == 0


def test_exchange_does_not_lower_held_out_quality(spark, monkeypatch):
    docs, pages, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "pages", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    truth = {r["doc_id"]: r["quality"] for r in labels.filter(~half & F.col("quality").isin(0, 1)).collect()}

    def areas() -> list[float]:
        rows = [r for r in quality_scores(docs, pages, labels.filter(half)).collect() if r["doc_id"] in truth]
        good = np.array([truth[r["doc_id"]] == 1 for r in rows])
        out = []
        for view in ("text_score", "score"):
            score = np.array([r[view] for r in rows])
            more, same = score[good][:, None] > score[~good], score[good][:, None] == score[~good]
            out.append((more + same / 2).mean())
        return out

    exchanged = areas()
    monkeypatch.setattr(cotraining, "ROUNDS", 0)
    assert all(a >= b - 0.001 and a > 0.98 for a, b in zip(exchanged, areas(), strict=True))


def test_cotraining_heeds_rows_of_large_hashes(spark):
    def scores(word: str) -> dict:
        # 100 labels are held back: enough to show that a view is sure.
        # Unlabelled rows beyond the 6000 of the smallest hashes have words of their own.
        base = spark.range(7000).select(
            F.col("id").alias("doc_id"),
            F.when(F.col("id") < 400, F.col("id") % 2).cast("int").alias("quality"),
            F.rank().over(Window.orderBy(F.col("id") < 400, F.xxhash64("id"))).alias("at"),
        )
        kind = F.when(F.col("doc_id") % 2 == 1, "fine").otherwise("poor")
        text = F.concat_ws(" ", kind, kind, F.when((F.col("at") > 6000) & F.col("quality").isNull(), word).otherwise("plain"), F.col("doc_id") % 50)
        full = base.select("doc_id", "quality", text.alias("text"), F.lit("en").alias("lang"), kind.alias("source"), F.lit(20).cast("long").alias("n_chars"), "at")
        out = quality_scores(full, spark.createDataFrame([], "page_id long, url string"), full.select("doc_id", "quality"))
        seen = full.filter("at <= 6000").select("doc_id")
        return {r["doc_id"]: r["text_score"] for r in out.join(seen, "doc_id").collect()}

    plain, other = scores("plain"), scores("strange%%")
    assert max(abs(plain[i] - other[i]) for i in plain) > 1e-6


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    words = "the of and to in is that with for by stone river cloud paper green".split()
    rows = []
    for i in range(60):
        rows.append((i, " ".join(rng.choice(words) + str(rng.randint(0, 40)) * (rng.random() < 0.6) for _ in range(80)), "en", f"s{i % 4}", 1))
    rows += [(100, rows[7][1], "en", "s0", 1), (101, rows[7][1] + " mail me at a@b.de", "en", "s1", 1)]
    rows += [(102, "too short", "en", "s1", 1), (103, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = corpus_pipeline.near_duplicates(spark, corpus_pipeline.quality(spark, docs, ""), "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(60))
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    texts = {i: t for i, t, *_ in rows}
    for r in out.itertuples():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert set(out.groupby("doc_id").size()) <= {1, 2} and set(out.doc_id) <= set(range(60))
    assert zlib.crc32(b"") == 0


def test_near_duplicates_with_null_and_repeated_ids(spark):
    import corpus_pipeline

    rng = random.Random(21)
    rows = []
    for _ in range(14):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(20, 60))]
        for _ in range(rng.randint(1, 4)):
            text = " ".join([*base, "more"][: len(base) + rng.randint(0, 1)])
            rows.append((rng.choice([None, 1, 2, 3, 4, 5]), text, rng.choice(["s0", "s1", None])))
    clean, copied = (" ".join(f"{x}{i}" for i in range(30)) for x in "yz")
    rows += [(7, copied, "s0"), (9, copied + " more", "s0"), (9, clean, "s0")]
    rows += [(None, "", "s0"), (None, None, "s0"), (8, " ", "s1"), (8, " ", "s1")]

    # Groups of rows by brute force: the row's number stands for its id.
    groups: dict = {}
    for i, n, least in components_by_hand([(i, t) for i, (_, t, _) in enumerate(rows)]):
        groups.setdefault(least if n else i, []).append(rows[i])
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "", r[2] or "")
    expected = sorted((min(g, key=key) for g in groups.values()), key=key)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    got = sorted((tuple(r) for r in kept.collect()), key=key)
    assert got == expected
    assert (9, clean, "s0") in got and (9, copied + " more", "s0") not in got
