"""Quality rules: a threshold table compiled into one projection of built-in expressions.

Words are runs of characters other than space and U+0009 to U+000D. All measures cover the
whole text in O(n log n): repeated windows are found by sorting them, not by comparing pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[ \t-\r]"

#: Frequent function words of the languages the rules are meant for.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "with", "for", "by",
    "der", "die", "das", "und", "von", "zu", "mit", "ist", "ein", "eine",
    "le", "la", "les", "de", "des", "et", "un", "une", "en", "du",
    "el", "los", "las", "que", "y", "por", "con", "se", "una", "al",
]


@dataclass(frozen=True)
class Rule:
    """``least * per <= 100 * measure <= most * per``; an open bound is None.

    ``per`` names another measure, or is None for plain bounds on the measure itself.
    """

    name: str
    measure: str
    per: str | None = None
    least: int | None = None
    most: int | None = None

    def failed(self, of: Column) -> Column:
        scale = F.lit(1) if self.per is None else 100
        value = of[self.measure] * scale
        unit = F.lit(1) if self.per is None else of[self.per]
        broken = F.lit(False)
        if self.least is not None:
            broken = broken | (value < self.least * unit)
        if self.most is not None:
            broken = broken | (value > self.most * unit)
        return broken


#: What every text must meet, whatever else is asked.
BASE_RULES = [
    Rule("too_short", "n_words", least=50),
    Rule("repeated_windows", "n_repeat_words", per="n_words", most=50),
]
#: The threshold table: percent of the unit, or plain counts.
RULES = [
    Rule("too_long", "n_words", most=1_000_000),
    Rule("word_length", "word_chars", per="n_words", least=200, most=1500),
    Rule("symbols", "n_symbols", per="n_words", most=10),
    Rule("exclamations", "n_exclamations", per="n_words", most=30),
    Rule("stop_words", "n_stop_words", per="n_words", least=2),
    Rule("repeated_lines", "n_dup_lines", per="n_lines", most=50),
]


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and names it in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words(words: str) -> str:
    """Words inside three-word windows that the array holds at least twice.

    The windows are sorted with their places; equal neighbours are repeats, and the places
    of repeats, in order, cover three words each less what they overlap.
    """
    windows = (
        "arrays_zip(slice(w, 1, n), slice(w, 2, n), slice(w, 3, n), slice(sequence(0, n), 1, n))"
    )

    def same(other: str) -> str:
        return " and ".join(f"x.`{k}` <=> get(s, {other}).`{k}`" for k in range(3))

    repeats = f"filter(s, (x, i) -> ({same('i - 1')}) or ({same('i + 1')}))"
    places = f"sort_array(transform({repeats}, x -> x.`3`))"
    covered = (
        "aggregate(p, named_struct('n', 0L, 'last', -3), (a, x) -> "
        "named_struct('n', a.n + least(3, x - a.last), 'last', x), a -> a.n)"
    )
    counted = _let("p", places, covered)
    body = _let("s", f"sort_array({windows})", counted)
    body = f"if(n > 1, {body}, 0L)"
    return _let("w", words, _let("n", "greatest(size(w) - 2, 0)", body))


def _measures(text: str) -> str:
    """SQL of a struct of all measures of a text that is not null."""
    words = f"array_remove(split({text}, '{SPACE}+'), '')"
    lines = f"filter(split({text}, '\\n'), x -> x rlike '[^ \\t-\\r]')"
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    per_words = (
        "named_struct("
        "'n_words', cast(size(w) as long), "
        f"'n_stop_words', cast(size(filter(w, x -> lower(x) in ({stop}))) as long), "
        f"'n_repeat_words', {_repeat_words('w')})"
    )
    per_lines = (
        "named_struct('n_lines', cast(size(l) as long), "
        "'n_dup_lines', cast(size(l) - size(array_distinct(l)) as long))"
    )
    spaceless = f"length(translate({text}, ' \\t\\n\\u000B\\u000C\\r', ''))"
    symbol_free = f"length(translate({text}, '#*$%&|<>', ''))"
    calm = f"length(translate({text}, '!', ''))"
    return (
        f"named_struct('of_words', {_let('w', words, per_words)}, "
        f"'of_lines', {_let('l', lines, per_lines)}, "
        f"'word_chars', cast({spaceless} as long), "
        f"'n_symbols', cast(length({text}) - {symbol_free} as long), "
        f"'n_exclamations', cast(length({text}) - {calm} as long))"
    )


MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_exclamations", "n_stop_words", "n_lines",
    "n_dup_lines", "n_repeat_words",
]


def quality_column(
    text: Column, rules: list[Rule] = RULES, base: list[Rule] = BASE_RULES
) -> Column:
    """A struct of the measures, ``base_failed``, ``failed`` (names) and ``kept``.

    One expression that works out every measure once, wherever the optimizer moves it: a
    filter on ``kept`` included. A null or empty text has zero for every measure and fails
    the base rules. Equal texts have equal results.
    """
    nested = {"n_words", "n_stop_words", "n_repeat_words"}
    lines = {"n_lines", "n_dup_lines"}

    def judged(counted: Column) -> Column:
        def field(name: str) -> Column:
            if name in nested:
                return counted["of_words"][name]
            return counted["of_lines"][name] if name in lines else counted[name]

        of = {name: field(name) for name in MEASURES}
        base_failed = F.lit(False)
        for rule in base:
            base_failed = base_failed | rule.failed(of)
        named = [F.when(r.failed(of), F.lit(r.name)) for r in [*base, *rules]]
        names = F.array_compact(F.array(*named))
        return F.struct(
            *[of[name].alias(name) for name in MEASURES],
            base_failed.alias("base_failed"),
            names.alias("failed"),
            (F.size(names) == 0).alias("kept"),
        )

    # Elements of one-row arrays: names for what is worked out once.
    texts = F.array(F.coalesce(text, F.lit("")))
    measured = F.call_function("transform", texts, F.expr(f"t -> {_measures('t')}"))
    return F.transform(measured, judged)[0]


def quality_rules(
    df: DataFrame,
    text: str = "text",
    rules: list[Rule] = RULES,
    base: list[Rule] = BASE_RULES,
    into: str = "quality",
) -> DataFrame:
    """Adds a struct ``into`` of :func:`quality_column`.

    Every row stays, in place; no shuffle. A column named like ``into`` is replaced; all
    other columns are passed on.
    """
    return df.withColumn(into, quality_column(F.col(text), rules, base))
