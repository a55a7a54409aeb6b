"""Text functions, all Column in and Column out."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Replace only the first match of ``pattern``; no match leaves the text."""
    if re.compile(pattern).groups:
        raise ValueError("the pattern must not hold capturing groups")
    return F.regexp_replace(text, f"(?s)^(.*?)(?:{pattern})", "$1" + replacement.replace("$", "\\$"))


def count_matches(text: Column, pattern: str) -> Column:
    """Number of non-overlapping matches of ``pattern``."""
    return F.regexp_count(text, F.lit(pattern))


def pad_after_last(text: Column, mark: str, total: int) -> Column:
    """Insert ``mark`` after its last occurrence until ``total`` are present.

    Without any ``mark`` the padding goes in front of the text.  A text that
    already holds ``total`` or more is kept.
    """
    missing = F.greatest(F.lit(total) - count_matches(text, re.escape(mark)), F.lit(0))
    tail = F.substring_index(text, mark, -1)
    head = F.substring(text, F.lit(1), F.length(text) - F.length(tail))
    return F.concat(head, F.repeat(F.lit(mark), missing), tail)


def up_to_second(text: Column, mark: str) -> Column:
    """Text before the second ``mark``; the whole text when there are fewer."""
    return F.substring_index(F.trim(text), mark, 2)


def holds(text: Column, part: str) -> Column:
    """1.0 when ``part`` occurs in the text, else 0.0."""
    return F.contains(text, F.lit(part)).cast("double")


def matches_fully(text: Column, pattern: str) -> Column:
    """True when the whole text matches ``pattern``."""
    return F.rlike(text, F.lit(f"^(?:{pattern})$"))


def standard_phone(phone: Column) -> Column:
    """One spelling for phone numbers written with a slash.

    Only numbers that hold ``/`` change: ``/`` and ``- `` become ``-`` and a
    doubled dash becomes a single one.
    """
    cleaned = F.replace(F.replace(F.replace(phone, F.lit("/"), F.lit("-")),
                                  F.lit("- "), F.lit("-")), F.lit("--"), F.lit("-"))
    return F.when(F.contains(phone, F.lit("/")), cleaned).otherwise(phone)


def last_segment(path: Column, mark: str = "/") -> Column:
    """Part after the last ``mark``."""
    return F.substring_index(path, mark, -1)


def split_part_at(text: Column, pattern: str, index: int) -> Column:
    """0-based part of the trimmed text; null when there are too few parts."""
    return F.get(F.split(F.trim(text), pattern), F.lit(index))


def words(text: Column, pattern: str = "[a-z]+") -> Column:
    """All lower-case tokens matching ``pattern``."""
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
