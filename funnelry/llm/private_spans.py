"""Personal data in plain and disguised form, with spans in the original text.

Transducers rewrite a text step by step (lookalike characters, words for "at" and "dot",
spelled digits) and carry for each character the span of the source it came from. Detectors
run on the plain text and on the rewritten one; what they find in the latter is mapped back.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ["email", "ip", "card", "phone"]

# The local part is found backwards from its @, and an address cannot begin inside a run of
# digits that it begins before: both keep the search linear in long runs.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    total = sum(map(int, digits[-1::-2]))
    total += sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            after = found.end()
        else:
            after = at + 1
        at = text.find("@", after)


def detect(text: str) -> list[tuple[int, int, int]]:
    """Plain matches as (kind, start, end): of each kind leftmost and not overlapping."""
    spans = [(0, *span) for span in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") or "0" for p in m[0].split("."))
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                spans.append((3, *m.span()))
    return spans


#: Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕһԁӏԛԝАВЕКМНОРСТХІЈЅαοικνρτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijshdlqwABEKMHOPCTXIJSaoikvptuxABEZHIKMNOPTYX",
        strict=True,
    )
)
#: Characters without width, left out.
INVISIBLE = "­​‌‍⁠﻿"


@lru_cache(maxsize=1)
def _homoglyphs() -> dict[str, str]:
    """Lookalikes, invisible characters, and what compatibility forms (wide, bold, circled)
    and digits of other scripts stand for; ordinal and superscript signs stay."""
    table = dict(LOOKALIKES) | dict.fromkeys(INVISIBLE, "")
    for code in range(0xA1, 0x1FBFA):
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char)
        digit = unicodedata.decimal(char, None)
        if digit is not None:
            table[char] = str(digit)
        elif len(plain) == 1 and " " < plain < "\x7f" and char not in "ªº":
            if not unicodedata.decomposition(char).startswith("<super>"):
                table.setdefault(char, plain)
    return table


#: Digits as words in four languages.
DIGIT_WORDS = {
    word: str(value % 10)
    for line in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for value, word in enumerate(line.split())
}
_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_OPEN, _CLOSE = r"\s{0,4}[\[({<]\s{0,4}", r"\s{0,4}[\])}>]\s{0,4}"
_DOTS = ("dot", "punto", "punkt", "point")
_SIGN_HINT = re.compile(rf"{_OPEN}(?:at|arroba|@|dot|punto|punkt|point|\.){_CLOSE}".removeprefix(r"\s{0,4}"))
_AT_SIGN = re.compile(rf"{_OPEN}(?:at|arroba|@){_CLOSE}", re.I)
_DOT_SIGN = re.compile(rf"{_OPEN}(?:dot|punto|punkt|point|\.){_CLOSE}", re.I)
_DOT_WORD = re.compile(r"(?<=[A-Za-z0-9])\s{1,4}(?:dot|punto|punkt|point)\s{1,4}(?=\w)", re.I)
# A bare "at" counts only before a dotted name in which a dot was disguised too.
_AT_WORD = re.compile(
    r"(?<=[A-Za-z0-9])(?:\s{1,4}|[_-])at(?=(\s{1,4}|[_-])[A-Za-z0-9-])", re.I
)
_NAME = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+")
_SPELLED = re.compile(
    rf"(?<![\w])(?:{_WORD}|[0-9]+)(?:(?:[ \t,-]{{1,3}}|\.)(?:{_WORD}|[0-9]+))+(?!\w)", re.I
)
_SPELLED_HINT = re.compile(rf"(?<!\w)(?:{_WORD})[ \t,.-]{{1,3}}(?:{_WORD}|[0-9])", re.I)
_PLUS_WORD = re.compile(r"(?<!\w)plus\s{1,4}(?=[0-9])", re.I)
_TOKEN = re.compile(r"\w+|\.")


class Rewritten:
    """A text and, for each of its characters, where it came from in the source."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1
        self.changed = np.zeros(len(text), bool)

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces (start, end, new), in order and apart, keeping track of the source."""
        if not edits:
            return
        texts, starts, ends, changed, gaps, at, length = [], [], [], [], [], 0, 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[at:a], new]
            starts.append(self.starts[at:a])
            ends.append(self.ends[at:a])
            changed.append(self.changed[at:a])
            if new:
                starts.append(np.full(len(new), self.starts[a]))
                ends.append(np.full(len(new), self.ends[b - 1]))
                changed.append(np.ones(len(new), bool))
            if a < b and not new:
                gaps.append(length + a - at)
            length += a - at + len(new)
            at = b
        self.text = "".join(texts)
        self.starts, self.ends = np.concatenate(starts), np.concatenate(ends)
        self.changed = np.concatenate(changed)
        # What follows something left out counts as changed.
        self.changed[[g for g in gaps if g < len(self.changed)]] = True


def _digits_of(m: re.Match[str]) -> str | None:
    """A spelled number as digits; None when it is too short to be an identifier."""
    tokens = _TOKEN.findall(m[0])
    spelled = sum(t.lower() in DIGIT_WORDS for t in tokens)
    if spelled < 2 or sum(t != "." for t in tokens) < 4:
        return None
    return "".join(DIGIT_WORDS.get(t.lower(), t) for t in tokens)


def _disguised(text: str) -> bool:
    """Whether any of the transducers after the first may find something; cheap checks first."""
    low = text.lower()
    if _SIGN_HINT.search(low) or (any(w in low for w in _DOTS) and _DOT_WORD.search(text)):
        return True
    words = low.replace("-", " ").replace(",", " ").replace(".", " ").split()
    return not DIGIT_WORDS.keys().isdisjoint(words) and bool(_SPELLED_HINT.search(text))


def _bare_ats(out: Rewritten) -> Iterator[tuple[int, int]]:
    """Each "at" before a name of which any dot was rewritten; linear in long names."""
    dots = [i for i in np.flatnonzero(out.changed).tolist() if out.text[i] == "."]
    if not dots:
        return
    reach = after = 0
    for m in _AT_WORD.finditer(out.text):
        start, end = m.start(), m.end(1)
        if end >= reach:
            reach = _NAME.match(out.text, end).end()
        at = bisect_left(dots, end)
        if start >= after and at < len(dots) and dots[at] < reach:
            yield start, end
            after = end


def rewrite(text: str) -> Rewritten | None:
    """The text after all transducers; None if none of them has anything to do."""
    out = None
    table = _homoglyphs()
    if not text.isascii() and not table.keys().isdisjoint(text):
        out = Rewritten(text)
        out.apply([(i, i + 1, table[c]) for i, c in enumerate(text) if c in table])
    if not _disguised(out.text if out else text):
        return out
    out = out or Rewritten(text)
    for pattern, new in ((_AT_SIGN, "@"), (_DOT_SIGN, "."), (_DOT_WORD, ".")):
        out.apply([(m.start(), m.end(), new) for m in pattern.finditer(out.text)])
    out.apply([(a, b, "@") for a, b in _bare_ats(out)])
    spelled = ((m, _digits_of(m)) for m in _SPELLED.finditer(out.text))
    out.apply([(m.start(), m.end(), new) for m, new in spelled if new])
    out.apply(
        [
            (m.start(), m.end(), "+")
            for m in _PLUS_WORD.finditer(out.text)
            if out.changed[m.end()]
        ]
    )
    return out


def private_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by start, then kind; code points, end exclusive.

    ``base`` spans are matches in the text as it is. The others have rewritten parts and lie
    within no base span of their kind; one that was disguised in part may overlap some.
    """
    if not text:
        return []
    base = detect(text)
    spans = [(start, kind, end, True) for kind, start, end in base]
    out = rewrite(text)
    if out is not None:
        for kind, a, b in detect(out.text):
            if not out.changed[a:b].any():
                continue
            start, end = int(out.starts[a]), int(out.ends[b - 1])
            if not any(k == kind and s <= start and end <= e for k, s, e in base):
                spans.append((start, kind, end, False))
    spans.sort()
    return [(KINDS[kind], start, end, plain) for start, kind, end, plain in spans]


def redact(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its kind's name."""
    parts, at, kind = [], 0, None
    reach = -1
    for name, start, end, _ in spans:
        if start < reach:
            reach = max(reach, end)
            continue
        if kind is not None:
            parts.append(f"[{kind.upper()}]")
            at = reach
        parts.append(text[at:start])
        kind, reach = name, end
    if kind is not None:
        parts.append(f"[{kind.upper()}]")
        at = reach
    return "".join([*parts, text[at:]])


SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("base", T.BooleanType())
)


@F.pandas_udf(SPANS)
def find_private(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Spans of every whole text; none for null and empty texts."""
    names = ("kind", "start", "end", "base")
    for batch in texts:
        rows = [
            [dict(zip(names, span, strict=True)) for span in private_spans(t)] for t in batch
        ]
        yield pd.Series(rows, dtype=object)


@F.pandas_udf(T.StringType())
def redact_private(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Every whole text without its personal data; a null text stays null."""
    for batch in texts:
        yield pd.Series(
            [t if not t else redact(t, private_spans(t)) for t in batch], dtype=object
        )
