"""URL filters: many glob rules in one bit-parallel automaton (multiword Shift-And).

Rules are compiled to bits, one for every place in every pattern, packed into 64-bit words.
One step reads one character of a URL and moves all places of all patterns at once; a batch
of URLs is stepped together. Globs are matched against the canonical URL (host and path):
``?`` is one character and ``*`` any run of them, both within the host or a path segment;
``**`` is any run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rules by host and path, as (verdict, host, path).
HOST_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Globs that decide where no such rule fits; a URL that none fits is allowed.
BLOCK_GLOBS = [
    "*casino*", "*casino*/**", "*-bets.*", "*-bets.*/**", "*cheap-pills*", "*cheap-pills*/**",
    "*spam-*", "*spam-*/**", "adult-*", "adult-*/**", "*.adult-*", "*.adult-*/**",
    "ads-*/**", "*.ads-*/**", "*/**/wp-login.php", "*/**.exe",
]

_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def canonical(url: str | None) -> tuple[str, str]:
    """Host, with A-Z lower-cased, and path; both empty without a ``://``."""
    found = _URL.search(url) if url else None
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


@dataclass(frozen=True)
class Automaton:
    """Masks by symbol and word: ``step`` for moving on, ``stay`` for stars."""

    symbols: dict[str, int]
    step: np.ndarray
    stay: np.ndarray
    start: np.ndarray
    final: np.ndarray  # word and bit of each pattern's last place


def compile_globs(globs: list[str]) -> Automaton:
    """Packs patterns one after the other; a pattern may lie across words."""
    items = [re.findall(r"\*\*|\*|\?|[^*?]", g, re.S) for g in globs]
    literals = sorted({x for pattern in items for x in pattern if x not in ("*", "**", "?")})
    # Symbol 0 is any character that no pattern names; the slash has one of its own.
    symbols = {c: i + 1 for i, c in enumerate(sorted({*literals, "/"}))}
    places = sum(1 + sum(x not in ("*", "**") for x in p) for p in items)
    words = -(-places // 64)
    step = np.zeros((len(symbols) + 1, words), np.uint64)
    stay = np.zeros_like(step)
    start = np.zeros(words, np.uint64)
    final, at = [], 0

    def mark(mask: np.ndarray, rows: list[int] | slice, place: int) -> None:
        mask[rows, place // 64] |= np.uint64(1 << (place % 64))

    slash, every = symbols["/"], list(range(len(symbols) + 1))
    inside = [s for s in every if s != slash]
    for pattern in items:
        start[at // 64] |= np.uint64(1 << (at % 64))
        for x in pattern:
            if x == "**":
                mark(stay, every, at)
            elif x == "*":
                mark(stay, inside, at)
            else:
                mark(step, inside if x == "?" else [symbols[x]], at)
                at += 1
        final.append((at // 64, at % 64))
        at += 1
    return Automaton(symbols, step, stay, start, np.array(final, dtype=np.int64).reshape(-1, 2))


def match(automaton: Automaton, texts: list[str]) -> np.ndarray:
    """Whether each text (row) is matched as a whole by each pattern (column).

    All texts are read a character at a time, longest first, so that those still being
    read are the first rows.
    """
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    ends = lengths[order]
    state = np.tile(automaton.start, (len(texts), 1))
    codes = [
        np.fromiter((automaton.symbols.get(c, 0) for c in texts[i]), np.int32, lengths[i])
        for i in order
    ]
    flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
    begins = np.concatenate([[0], np.cumsum(ends)[:-1]]) if len(ends) else ends
    for t in range(int(ends[0]) if len(ends) else 0):
        alive = int(np.searchsorted(-ends, -t, side="left"))
        read = flat[begins[:alive] + t]
        now = state[:alive]
        moved = now & automaton.step[read]
        shifted = moved << np.uint64(1)
        shifted[:, 1:] |= moved[:, :-1] >> np.uint64(63)
        state[:alive] = shifted | (now & automaton.stay[read])
    word, bit = automaton.final[:, 0], automaton.final[:, 1].astype(np.uint64)
    found = (state[:, word] >> bit) & np.uint64(1)
    result = np.empty((len(texts), len(word)), bool)
    result[order] = found.astype(bool)
    return result


def judge_urls(
    url: Column,
    rules: list[tuple[str, str, str]] = HOST_RULES,
    block: list[str] = BLOCK_GLOBS,
) -> Column:
    """A struct of ``host``, ``path``, ``rule`` (host and path of the longest rule that fits,
    or null) and ``verdict`` (the rule's, or else by the globs).

    A rule fits its host and all hosts below it, if the path starts with its path. Of rules
    of one length the first in the list wins. A null, empty or odd URL has empty host and
    path, which no rule or glob fits: it is allowed. Equal URLs are judged once a batch.
    """
    names = [host + path for _, host, path in rules]
    globs = [g for n in names for g in (f"{n}**", f"*.{n}**")] + list(block)
    automaton = compile_globs(globs)
    ranking = sorted(range(len(names)), key=lambda i: -len(names[i]))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [canonical(u) for u in batch]
            distinct = list(dict.fromkeys(host + path for host, path in parts))
            found = match(automaton, distinct)
            verdicts = {}
            for text, row in zip(distinct, found, strict=True):
                fit = next((i for i in ranking if row[2 * i] or row[2 * i + 1]), None)
                if fit is not None:
                    verdicts[text] = (names[fit], rules[fit][0])
                else:
                    blocked = row[2 * len(names) :].any()
                    verdicts[text] = (None, "block" if blocked else "allow")
            rows = [(h, p, *verdicts[h + p]) for h, p in parts]
            yield pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return judged(url)
