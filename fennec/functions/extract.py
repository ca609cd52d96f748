"""Structured extraction from labelled catalog text.

Catalog text is newline separated ``Label: value`` lines (``Item Name:``,
``Bullet Point n:``, ``Value:``, ``Unit:``) with ``Pack of N`` anywhere.  Two
rule sets exist and disagree; both are kept and chosen by ``variant``:

* ``"A"`` -- the richer rules (normalised unit, 8 pack patterns with a cap,
  normalised brand)
* ``"B"`` -- the plain rules (raw unit, ``Pack of N`` only, raw brand)

All functions are pure column expressions (JVM regexes, no UDFs).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import nullif_empty, py_regex, py_split, py_strip, search_group

# ---------------------------------------------------------------------------
# These must equal the catalog rules exactly (Python syntax).
VALUE_PATTERN = r"Value:\s*([\d.]+)"
UNIT_PATTERN = r"Unit:\s*([^\n]+)"
ITEM_NAME_PATTERN = r"Item Name:\s*([^\n]+)"
# unit normalisation, first substring hit wins, in this order
UNIT_MAP = [
    ("fluid ounce", "fl_oz"),
    ("ounce", "oz"),
    ("pound", "lb"),
    ("count", "count"),
    ("gram", "g"),
    ("kilogram", "kg"),
    ("milliliter", "ml"),
    ("liter", "l"),
]
UNIT_TRUNCATE = 20
# pack quantity patterns (variant A), case-insensitive, first pattern that matches wins
PACK_PATTERNS = [
    r"Pack of (\d+)",
    r"\(Pack of (\d+)\)",
    r"(\d+)[- ]Pack",
    r"(\d+) ct",
    r"(\d+) Count",
    r"(\d+)-Count",
    r"(\d+) Pack",
    r"(\d+)pk",
]
PACK_CAP = 100
# pack quantity patterns (variant B)
PACK_PATTERNS_SIMPLE = [r"Pack of (\d+)", r"\(Pack of (\d+)\)"]
BRAND_PREFIX_PATTERN = r"^(The|A|An)\s+"
# ---------------------------------------------------------------------------


def value(text: Column, strict: bool = False) -> Column:
    """First ``Value:`` number as DOUBLE; NULL when absent.

    A captured string that is not a number (``12.5.3``, ``.``) is NULL by
    default (the tolerant rule); ``strict=True`` makes the query fail on it,
    as the strict rule does (ANSI cast error).
    """
    digits = search_group(text, VALUE_PATTERN)
    return digits.cast("double") if strict else digits.try_cast("double")


def unit_raw(text: Column) -> Column:
    """E3 (B): stripped ``Unit:`` line, case kept; ``'Unknown'`` when absent/blank."""
    return F.coalesce(nullif_empty(py_strip(F.regexp_extract(text, py_regex(UNIT_PATTERN), 1))), F.lit("Unknown"))


def unit_normalized(text: Column) -> Column:
    """E4 (A): lower-cased unit mapped by first substring hit, else its first 20 chars.

    A matched-but-blank unit gives ``''``; no match or NULL text gives ``'unknown'``.
    """
    u = F.lower(py_strip(F.regexp_extract(text, py_regex(UNIT_PATTERN), 1)))
    mapped = F.when(F.lit(False), F.lit(None))
    for key, code in UNIT_MAP:
        mapped = mapped.when(u.contains(key), F.lit(code))
    mapped = mapped.otherwise(F.substring(u, 1, UNIT_TRUNCATE))
    has = F.coalesce(text.rlike(py_regex(UNIT_PATTERN)), F.lit(False))
    return F.when(has, mapped).otherwise(F.lit("unknown"))


def item_name(text: Column) -> Column:
    """E5: stripped ``Item Name:`` line; ``''`` when absent."""
    return F.coalesce(py_strip(F.regexp_extract(text, py_regex(ITEM_NAME_PATTERN), 1)), F.lit(""))


def _first_capture(text: Column, patterns: list[str]) -> Column:
    return F.coalesce(*[search_group(text, p, 1, flags="i") for p in patterns])


def pack_digits(text: Column, variant: str = "A") -> Column:
    """Digits captured by the first matching pack pattern (NULL if none)."""
    return _first_capture(text, PACK_PATTERNS if variant == "A" else PACK_PATTERNS_SIMPLE)


def pack_from_digits(digits: Column, variant: str = "A") -> Column:
    """E6 (A): ``min(N, 100)``, default 1, any length of digits; E7 (B): N uncapped as DOUBLE."""
    if variant == "A":
        significant = F.regexp_replace(digits, "^0+", "")
        return (
            F.when(digits.isNull(), F.lit(1))
            .when(F.length(significant) > 3, F.lit(PACK_CAP))
            .otherwise(F.least(digits.cast("int"), F.lit(PACK_CAP)))
        )
    return F.coalesce(digits.try_cast("double"), F.lit(1.0))


def pack_quantity(text: Column, variant: str = "A") -> Column:
    return pack_from_digits(pack_digits(text, variant), variant)


def brand_raw(name: Column) -> Column:
    """E8 (B): first whitespace token without ``[^\\w\\s]``; ``'Unknown'`` when empty."""
    first = F.get(py_split(name), 0)
    cleaned = F.regexp_replace(first, py_regex(r"[^\w\s]"), "")
    return F.coalesce(nullif_empty(cleaned), F.lit("Unknown"))


def brand_normalized(name: Column) -> Column:
    """E9 (A): drop one leading The/A/An + space, first token, lower, keep [a-z0-9]."""
    stripped = py_strip(F.coalesce(name, F.lit("")))
    no_prefix = F.regexp_replace(stripped, "(?i)" + py_regex(BRAND_PREFIX_PATTERN), "")
    first = F.lower(F.get(py_split(no_prefix), 0))
    cleaned = F.regexp_replace(first, "[^a-z0-9]", "")
    return F.coalesce(nullif_empty(cleaned), F.lit("unknown"))
