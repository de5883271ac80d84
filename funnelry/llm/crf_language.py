"""Languages of words and texts by a linear-chain conditional random field.

A word's label depends on affixes, character n-grams and a lexicon, and on its neighbours'
labels through learned transitions. The field is trained on code-switched sequences spliced
from labelled texts. Forward-backward gives the labels' probabilities for each word; a text's
language is the one with the largest sum of them. Long texts are worked on in parts of ``CHAIN``
words, all at once; messages pass from part to part, so that the result is that of one chain.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: The bounded sample that the field is trained on: texts of a language, words of a text, and
#: characters read for these words. All languages are learned; where they are many, texts and
#: words shrink so that words times languages stay below SAMPLE (see :func:`bounds`).
TEXTS, WORDS, CHARS, SAMPLE = 200, 300, 4000, 1 << 24
#: Features are kept if seen so often, up to so many (fewer beyond 64 languages).
LEAST_SEEN, FEATURES, ROUNDS = 4, 60_000, 40
CHAIN = 1024
#: Words labelled at once, and words whose scores are remembered, for up to 4 languages; fewer
#: for more.
AT_ONCE, REMEMBERED = 400_000, 200_000

_LETTER = re.compile(r"[^\W\d_]")
_EDGE = "\"'.,;:!?()[]{}<>|*#$%&-_«»„“”…"


def words_of(text: str) -> list[str]:
    """Lower-cased words that hold a letter, without marks at their ends."""
    words = (w.strip(_EDGE) for w in text.lower().split())
    # Numerals that are no digits match the pattern but are no letters.
    return [
        w for w in words if w.isalpha() or (_LETTER.search(w) and any(map(str.isalpha, w)))
    ]


def features_of(word: str) -> list[str]:
    """Prefixes, suffixes, n-grams within the word's bounds, and the word itself."""
    found = [f"l{word}"]
    found += [f"p{word[:k]}" for k in (1, 2, 3)]
    found += [f"s{word[-k:]}" for k in (1, 2, 3)]
    bound = f"^{word}$"
    found += [bound[i : i + 2] for i in range(len(bound) - 1)]
    found += [bound[i : i + 3] for i in range(len(bound) - 2)]
    return found


def _scaled(messages: np.ndarray) -> np.ndarray:
    return messages / messages.sum(axis=-1, keepdims=True)


def paths_through(scores: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Weight of all paths of each padded chain by first and last label, up to a factor."""
    weight = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves)
    paths = np.eye(len(step)) * weight[:, :1]
    for t in range(1, scores.shape[1]):
        alive = lengths > t
        now = (paths[alive] @ step) * weight[alive, t][:, None, :]
        paths[alive] = now / now.sum(axis=(1, 2), keepdims=True)
    return paths


def messages_between(
    paths: np.ndarray, counts: np.ndarray, moves: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """What enters each part of a chain from the left and from the right.

    ``counts`` parts belong to each chain, one after the other. Both are weights of labels, at
    the part's first place before its score and at its last place.
    """
    step = np.exp(moves)
    before = np.tile(np.exp(start), (len(paths), 1))
    after = np.ones_like(before)
    first = np.cumsum(counts) - counts
    for k in range(1, counts.max(initial=0)):
        at = first[counts > k] + k
        ends = (before[at - 1][:, None, :] @ paths[at - 1])[:, 0]
        before[at] = _scaled(ends @ step)
    for k in range(counts.max(initial=0) - 1, 0, -1):
        at = first[counts > k] + k
        after[at - 1] = _scaled((paths[at] @ after[at][:, :, None])[:, :, 0] @ step.T)
    return before, after


def forward_backward(
    scores: np.ndarray,
    moves: np.ndarray,
    start: np.ndarray,
    lengths: np.ndarray,
    before: np.ndarray | None = None,
    after: np.ndarray | None = None,
    moved: bool = True,
) -> tuple[np.ndarray, np.ndarray | None]:
    """Label probabilities (chain, place, label) and expected transitions of padded chains.

    Transitions are counted if ``moved``; labelling needs none. ``before`` and ``after`` are messages from the parts on both sides, if these are parts.
    """
    chains, places, labels = scores.shape
    weight = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(moves)
    ahead = np.empty_like(weight)
    ahead[:, 0] = _scaled((np.exp(start) if before is None else before) * weight[:, 0])
    for t in range(1, places):
        ahead[:, t] = _scaled((ahead[:, t - 1] @ step) * weight[:, t])
    back = np.ones((chains, labels))
    both, expected = np.empty_like(weight), np.zeros((labels, labels))
    for t in range(places - 1, -1, -1):
        # A chain that ended earlier starts anew from its own end.
        ends = lengths - 1 == t
        back[ends] = 1.0 if after is None else after[ends]
        both[:, t] = _scaled(ahead[:, t] * back)
        if t:
            right = weight[:, t] * back
            if moved:
                alive = lengths > t
                left, right_ = ahead[alive, t - 1], right[alive]
                whole = ((left @ step) * right_).sum(axis=1, keepdims=True)
                expected += step * ((left / whole).T @ right_)
            back = _scaled(right @ step.T)
    return both, expected if moved else None


@dataclass
class Field:
    """A trained field: languages, feature rows, weights, transitions, start scores."""

    languages: list[str]
    rows: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray
    _known: dict[str, int] = field(default_factory=dict)
    _scores: list[np.ndarray] = field(default_factory=list)

    def _fewer(self, number: int) -> int:
        return number * 4 // max(4, len(self.languages))

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Row of each word in a table of label scores, and the table."""
        fresh = list(dict.fromkeys(w for w in words if w not in self._known))
        if len(self._known) + len(fresh) > self._fewer(REMEMBERED):
            self._known, self._scores = {}, []
            fresh = list(dict.fromkeys(words))
        if fresh:
            get, flat, counts = self.rows.get, [], []
            for word in fresh:
                held = [r for r in map(get, features_of(word)) if r is not None]
                flat += held or [len(self.rows)]
                counts.append(max(1, len(held)))
            begins = np.concatenate([[0], np.cumsum(counts)[:-1]])
            table = np.add.reduceat(self.weights[np.array(flat)], begins, axis=0)
            at = len(self._known)
            self._known.update((w, at + i) for i, w in enumerate(fresh))
            self._scores = [np.concatenate([*self._scores, table])]
        ids = np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))
        return ids, self._scores[0]

    def label(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Label probabilities of each word of each text."""
        out: list[np.ndarray] = []
        some: list[list[str]] = []
        held = 0
        for words in texts:
            some.append(words)
            held += len(words)
            if held >= self._fewer(AT_ONCE):
                out += self._label(some)
                some, held = [], 0
        return out + self._label(some)

    def _label(self, texts: list[list[str]]) -> list[np.ndarray]:
        sizes = np.array([len(t) for t in texts], np.int64)
        flat = [w for t in texts for w in t]
        if not flat:
            return [np.zeros((0, len(self.languages)))] * len(texts)
        ids, table = self.word_scores(flat)
        begins = np.concatenate([[0], np.cumsum(sizes)])
        starts = np.concatenate(
            [np.arange(a, b, CHAIN) for a, b in zip(begins[:-1], begins[1:], strict=True)]
        )
        lengths = np.append(starts[1:], len(flat)) - starts
        counts = -(-sizes // CHAIN)
        # Parts of similar length together, so that little is padded.
        order = np.argsort(lengths, kind="stable")

        def padded(some: np.ndarray) -> Iterator[tuple]:
            pieces = max(1, len(some) * CHAIN // self._fewer(AT_ONCE))
            for group in np.array_split(some, pieces):
                if len(group):
                    places = np.arange(int(lengths[group].max()))
                    inside = places < lengths[group][:, None]
                    first = starts[group][:, None]
                    at = np.where(inside, first + places, first)
                    yield group, at, inside

        several = np.repeat(counts > 1, counts)
        labels = len(self.languages)
        before, after = np.tile(np.exp(self.start), (len(starts), 1)), np.ones((len(starts), labels))
        if several.any():
            paths = np.empty((int(several.sum()), labels, labels))
            row = np.cumsum(several) - 1
            for group, at, _ in padded(order[several[order]]):
                paths[row[group]] = paths_through(table[ids[at]], self.moves, lengths[group])
            before[several], after[several] = messages_between(
                paths, counts[counts > 1], self.moves, self.start
            )
        result = np.empty((len(flat), labels))
        for group, at, inside in padded(order):
            both, _ = forward_backward(
                table[ids[at]], self.moves, self.start, lengths[group], before[group], after[group], False
            )
            result[at[inside]] = both[inside]
        return np.split(result, begins[1:-1])


def spliced(texts: list[tuple[int, list[str]]], seed: int = 7) -> list[tuple[list[str], list[int]]]:
    """Code-switched chains: runs of 4 to 40 words of texts in random order, labelled."""
    rng = np.random.default_rng(seed)
    runs = []
    for label, words in texts:
        at = 0
        while at < len(words):
            size = int(rng.integers(4, 41))
            runs.append((label, words[at : at + size]))
            at += size
    chains, words, labels = [], [], []
    for i in rng.permutation(len(runs)):
        label, some = runs[i]
        words, labels = words + some, labels + [label] * len(some)
        if len(words) >= 64:
            chains.append((words[:64], labels[:64]))
            words, labels = [], []
    if words:
        chains.append((words, labels))
    return chains


def train(texts: list[tuple[str, list[str]]], rounds: int = ROUNDS) -> Field:
    """Maximum likelihood with a small ridge, by Adam on all chains."""
    languages = sorted({lang for lang, _ in texts})
    number = {lang: i for i, lang in enumerate(languages)}
    chains = spliced([(number[lang], words) for lang, words in texts])
    types = list(dict.fromkeys(w for words, _ in chains for w in words))
    held = [features_of(w) for w in types]
    seen = Counter(f for fs in held for f in fs)
    often = [(f, c) for f, c in seen.items() if c >= LEAST_SEEN or f[0] == "l"]
    often.sort(key=lambda x: (-x[1], x[0]))
    most = FEATURES * 64 // max(64, len(languages))
    rows = {f: i for i, (f, _) in enumerate(often[:most])}
    flat, counts = [], []
    for fs in held:
        known = [rows[f] for f in fs if f in rows] or [len(rows)]
        flat += known
        counts.append(len(known))
    flat, counts = np.array(flat, np.int64), np.array(counts)
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    k, lengths = len(languages), np.array([len(w) for w, _ in chains])
    at = {w: i for i, w in enumerate(types)}
    ids = np.zeros((len(chains), 64), np.int64)
    gold = np.zeros((len(chains), 64), np.int64)
    for i, (words, labels) in enumerate(chains):
        ids[i, : len(words)] = [at[w] for w in words]
        gold[i, : len(words)] = labels
    inside = np.arange(64) < lengths[:, None]
    gold_hot = np.eye(k)[gold]
    seen_moves = np.zeros((k, k))
    pair = inside[:, 1:]
    np.add.at(seen_moves, (gold[:, :-1][pair], gold[:, 1:][pair]), 1)
    parts = [np.zeros((len(rows) + 1, k)), np.zeros((k, k)), np.zeros(k)]
    first = [np.zeros_like(p) for p in parts]
    second = [np.zeros_like(p) for p in parts]
    total = inside.sum()
    for turn in range(1, rounds + 1):
        table = np.add.reduceat(parts[0][flat], begins, axis=0)
        both, expected = forward_backward(table[ids], parts[1], parts[2], lengths)
        wrong = (gold_hot - both) * inside[:, :, None]
        grads = [np.empty_like(parts[0]), seen_moves - expected, wrong[:, 0].sum(axis=0)]
        for c in range(k):
            by_type = np.bincount(ids.ravel(), wrong[:, :, c].ravel(), len(types))
            by_row = np.bincount(flat, np.repeat(by_type, counts), len(rows) + 1)
            grads[0][:, c] = by_row
        for i, grad in enumerate(grads):
            grad = grad / total - 1e-6 * parts[i]
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.99 * second[i] + 0.01 * grad**2
            ready = first[i] / (1 - 0.9**turn)
            size = np.sqrt(second[i] / (1 - 0.99**turn)) + 1e-9
            parts[i] = parts[i] + 0.1 * ready / size
    return Field(languages, rows, *parts)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, mod 3, is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def bounds(languages: int) -> tuple[int, int]:
    """Texts of each of so many languages, and words of each text, that are trained on."""
    words = SAMPLE // max(1, languages) ** 2
    texts = min(TEXTS, max(1, words // WORDS))
    return texts, min(WORDS, max(16, words // texts))


def sample(df: DataFrame, doc_id: str, text: str, lang: str) -> list[tuple[str, list[str]]]:
    """The bounded training sample: labelled texts of small hashes, some words of each."""
    some = df.filter(
        F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(doc_id))
    ).select(
        F.col(lang).alias("lang"), F.left(text, F.lit(CHARS)).alias("text"), F.xxhash64(doc_id).alias("h")
    )
    texts, words = bounds(some.select("lang").distinct().count())
    by_lang = Window.partitionBy("lang").orderBy("h", "text")
    few = some.withColumn("r", F.row_number().over(by_lang)).filter(F.col("r") <= texts)
    rows = sorted(few.select("lang", "h", "text").collect())
    return [(r["lang"], words_of(r["text"])[:words]) for r in rows]


PREDICTION = T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType())


def predict_column(model: Field | None, df: DataFrame, text: Column) -> Column:
    """Language and mean probability of every whole text.

    ``und`` with score 0 for a null text, one without a letter, or without a model (nothing
    to learn from).
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(PREDICTION)
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for batch in batches:
            rows = []
            if known is None:
                rows = [("und", 0.0)] * len(batch)
            else:
                words = [words_of(t) if t else [] for t in batch]
                for p in known.label(words):
                    if len(p):
                        mean = p.mean(axis=0)
                        best = int(mean.argmax())
                        rows.append((known.languages[best], float(min(1.0, mean[best]))))
                    else:
                        rows.append(("und", 0.0))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return predicted(text)


def learn(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"):
    """A field trained on the sample; None if no labelled text has a word."""
    texts = [(lang_, words) for lang_, words in sample(df, doc_id, text, lang) if words]
    return train(texts) if texts else None
