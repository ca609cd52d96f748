"""Text measures (T1-T11) as code-point exact column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import WS_CHARS, py_split

# The literal counted for T7.
BULLET_LABEL = "Bullet Point"


def char_length(c: Column) -> Column:
    """Code points, NULL -> 0."""
    return F.length(F.coalesce(c, F.lit(""))).cast("bigint")


def word_count(c: Column) -> Column:
    """Whitespace tokens (``'' -> 0``)."""
    return F.size(py_split(F.coalesce(c, F.lit("")))).cast("bigint")


def unique_words(c: Column) -> Column:
    """T4: distinct lower-cased whitespace tokens."""
    return F.size(F.array_distinct(py_split(F.lower(F.coalesce(c, F.lit("")))))).cast("bigint")


def per_word_plus_one(numerator: Column, words: Column) -> Column:
    """``x / (word_count + 1)`` (the +1 is part of the rule)."""
    return numerator.cast("double") / (words + F.lit(1)).cast("double")


def bullet_points(text: Column) -> Column:
    """Case-sensitive occurrences of ``Bullet Point``."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(BULLET_LABEL)).cast("bigint")


def special_chars(c: Column) -> Column:
    """Characters that are neither alphanumeric nor whitespace (``_`` counts)."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(f"[^\\p{{L}}\\p{{N}}{WS_CHARS}]")).cast("bigint")


def digit_count(c: Column) -> Column:
    """Unicode decimal digits."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"\p{Nd}")).cast("bigint")


def uppercase_count(c: Column) -> Column:
    """Upper-case letters."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"\p{Lu}")).cast("bigint")


def words_per_sentence(c: Column) -> Column:
    """T11 (report-only measure): words / (sentence-end groups ``[.!?]+`` + 1)."""
    text = F.coalesce(c, F.lit(""))
    return word_count(text).cast("double") / (F.regexp_count(text, F.lit(r"[.!?]+")) + F.lit(1)).cast("double")
