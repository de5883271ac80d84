"""Object text that is not quite JSON, rewritten token by token.

Sources deliver objects as their language prints them: single-quoted strings, ``None``,
``True``, apostrophes and quotes inside strings. One regular expression cuts the text into
strings, words and the rest, so that a quote is taken for what it is where it stands; each
token is then written as JSON. All of it is built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelry.functions import values

#: A double-quoted string; a single-quoted one, in which a quote ends the string only before
#: a comma, colon, closing bracket or the end; a word; anything else. Quantifiers are
#: possessive: matching is linear and needs no stack, however long a string is.
_DOUBLE = r'"(?:[^"\\]++|\\.)*+"'
_SINGLE = r"'(?:[^'\\]++|\\.|'(?!\s*+(?:[,:}\]]|$)))*+'"
TOKEN = rf"(?s){_DOUBLE}|{_SINGLE}|[A-Za-z_][A-Za-z_0-9]*+|[^'\"A-Za-z_]++|."
#: An even number of backslashes before what is looked for.
_UNESCAPED = r"(?<!\\)((?:\\\\)*+)"
WORDS = {"None": "null", "True": "true", "False": "false", "nan": "null", "NaN": "null"}
CONTROLS = {"\n": r"\\n", "\r": r"\\r", "\t": r"\\t"}


def _string(inner: Column) -> Column:
    """The inside of a string of either kind as the inside of a JSON string."""
    out = F.regexp_replace(inner, rf"{_UNESCAPED}\\'", "$1'")
    out = F.regexp_replace(out, rf'{_UNESCAPED}"', r'$1\\"')
    out = F.regexp_replace(out, rf"{_UNESCAPED}\\x([0-9A-Fa-f]{{2}})", r"$1\\u00$2")
    for raw, written in CONTROLS.items():
        out = F.regexp_replace(out, raw, written)
    return F.concat(F.lit('"'), out, F.lit('"'))


def _token(token: Column) -> Column:
    quote = F.substring(token, 1, 1)
    closed = (F.length(token) > 1) & quote.isin("'", '"')
    word = token
    for python, json in WORDS.items():
        word = F.when(token == python, json).otherwise(word)
    return F.when(closed, _string(F.substring(token, F.lit(2), F.length(token) - 2))).otherwise(word)


def json_text(text: str | Column) -> Column:
    """The text with every token written as JSON; NULL stays NULL."""
    tokens = F.regexp_extract_all(values.col(text), F.lit(TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, _token), "")


def repair_json(text: str | Column) -> Column:
    """Text parsed as JSON, if need be after it is rewritten; NULL if still unreadable."""
    return F.coalesce(F.try_parse_json(values.col(text)), F.try_parse_json(json_text(text)))


def field_text(text: str | Column, field: str) -> Column:
    """A field's value found in text that cannot be parsed as a whole.

    The string or bare value after the quoted name; NULL if there is none or it is a null.
    """
    value = rf"(?s)['\"]\Q{field}\E['\"]\s*:\s*({_DOUBLE}|{_SINGLE}|[^\s,}}\]'\"]++)"
    written = _token(values.capture(text, value))
    found = F.try_parse_json(written)
    return F.coalesce(F.try_variant_get(found, "$", "string"), F.when(found.isNull(), written))


def read_objects(rows: DataFrame, text: str, fields: Sequence[str], into: str) -> DataFrame:
    """Adds a struct: the fields as text, and ``how`` they were read.

    ``parsed`` as they came, ``repaired`` after rewriting, ``by_field`` where only single
    fields could be found, ``failed`` where none could, ``blank`` where there was no text. A
    text that is JSON but no object fails. Fields that are absent or null are NULL.
    """
    strict, again = F.try_parse_json(values.col(text)), F.try_parse_json(json_text(text))

    def is_object(document: Column) -> Column:
        return F.coalesce(F.startswith(F.schema_of_variant(document), F.lit("OBJECT")), F.lit(False))

    document = F.coalesce(F.when(is_object(strict), strict), F.when(is_object(again), again))
    read = [F.try_variant_get(document, f'$["{f}"]', "string").alias(f) for f in fields]
    loose = [field_text(text, f).alias(f) for f in fields]
    any_loose = F.coalesce(*[field_text(text, f) for f in fields]).isNotNull()
    how = (
        F.when(~F.coalesce(values.not_blank(text), F.lit(False)), "blank")
        .when(is_object(strict), "parsed")
        .when(is_object(again), "repaired")
        .when(any_loose & strict.isNull(), "by_field")
        .otherwise("failed")
    )
    found = F.when(how == "by_field", F.struct(*loose)).otherwise(F.struct(*read))
    return rows.withColumn(into, F.struct(*[found[f].alias(f) for f in fields], how.alias("how")))


def repair_profile(read: DataFrame, into: str) -> DataFrame:
    """How many texts were read in which way, failures included, as one row."""
    ways = ["blank", "parsed", "repaired", "by_field", "failed"]
    return read.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(f"{into}.how") == way).alias(f"n_{way}") for way in ways],
    )
