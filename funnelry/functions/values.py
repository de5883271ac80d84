"""Column helpers for text, money, time, ratios and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- text ---------------------------------------------------------------------------


def not_blank(value: str | Column) -> Column:
    return col(value).isNotNull() & (F.trim(value) != "")


def blank_label(value: str | Column, label: str = "[blank]") -> Column:
    return F.coalesce(F.nullif(col(value), F.lit("")), F.lit(label))


def capture(value: str | Column, pattern: str, group: int = 1) -> Column:
    """One regex group of the first match, NULL (not '') where nothing matches."""
    return F.when(
        F.regexp_like(value, F.lit(pattern)), F.regexp_extract(value, pattern, group)
    )


def all_matches(value: str | Column, pattern: str) -> Column:
    """Every whole match as an array; empty where nothing matches."""
    return F.regexp_extract_all(value, F.lit(pattern), F.lit(0))


def full_name(first: str, last: str) -> Column:
    return F.trim(
        F.concat(F.coalesce(col(first), F.lit("")), F.lit(" "), F.coalesce(col(last), F.lit("")))
    )


# Fixed patterns: how list text is written (brackets around, quotes, commas between) and
# what an amount may consist of.
LIST_ENDS, LIST_QUOTE, LIST_COMMA = r"^\[|\]$", '"', r"\s*,\s*"
NOT_AMOUNT = "[^0-9.-]"


def split_list_text(value: str | Column) -> Column:
    """Array-like text such as ``["a", "b"]`` or ``a, b`` as its trimmed parts."""
    inner = F.regexp_replace(value, LIST_ENDS, "")
    bare = F.trim(F.regexp_replace(inner, LIST_QUOTE, ""))
    return F.transform(F.split(bare, LIST_COMMA), lambda part: F.trim(part))


# --- money and ratios ---------------------------------------------------------------


def money(value: str | Column) -> Column:
    """Amount text with currency signs and separators removed; NULL if no number is left."""
    digits = F.nullif(F.regexp_replace(value, NOT_AMOUNT, ""), F.lit(""))
    return digits.try_cast(MONEY)


def ratio(part: str | Column, whole: str | Column, digits: int) -> Column:
    """Rounded part / whole, NULL where the whole is zero."""
    return F.round(col(part) / F.nullif(col(whole), F.lit(0)), digits)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """part / whole of two sums, 0 where the whole is zero or missing."""
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.coalesce(share, F.lit(0.0))


# --- time ---------------------------------------------------------------------------


def timestamp(value: str | Column) -> Column:
    """Wall-clock timestamp, NULL for blank or unreadable text; an offset is dropped."""
    return col(value).try_cast("timestamp_ntz")


def strict_timestamp(value: str | Column) -> Column:
    """Instant read from text: blank is NULL, anything unreadable raises."""
    return F.nullif(col(value), F.lit("")).cast("timestamp")


def utc_date(value: str | Column) -> Column:
    return F.to_date(col(value))


def local_date(value: str | Column, zone: str) -> Column:
    """Calendar date of a UTC wall-clock timestamp in another zone, DST included."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), col(value)))


# --- keys ---------------------------------------------------------------------------


def joined_key(*values: Column) -> Column:
    """md5 of the values joined by '|'; NULL if any of them is NULL."""
    parts: list[Column] = []
    for value in values:
        parts += [F.lit("|"), value]
    return F.md5(F.concat(*parts[1:]))


def row_hash(*columns: str) -> Column:
    """md5 of a row's values, NULLs told apart from empty text."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def is_true(flag: str | Column) -> Column:
    """A flag that counts as false where it is missing."""
    return F.coalesce(col(flag), F.lit(False))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; its max() tells whether any row qualified."""
    return F.when(condition, 1).otherwise(0)
