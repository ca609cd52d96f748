"""Keyword and category flags (K1-K23): 0/1 INT columns from unanchored regex
search over the lower-cased catalog text.  The rule set is a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .regex import py_regex

# Keyword rules (column suffix -> Python pattern), in order.
PREMIUM_KEYWORDS = {
    "organic": r"organic",
    "premium": r"premium",
    "natural": r"natural",
    "gourmet": r"gourmet",
    "gluten_free": r"gluten.free",
    "non_gmo": r"non.gmo",
    "kosher": r"kosher",
    "vegan": r"vegan",
    "sugar_free": r"sugar.free",
    "family": r"family",
    "luxury": r"luxury|deluxe",
    "artisan": r"artisan",
    "imported": r"imported",
    "certified": r"certified",
    "fresh": r"fresh",
    "pure": r"pure",
}
# Category rules (column suffix -> Python pattern), in order.
CATEGORIES = {
    "food": r"food|snack|meal",
    "beverage": r"beverage|drink|juice",
    "health": r"health|vitamin|supplement",
    "beauty": r"beauty|cosmetic|skin",
    "baby": r"baby|infant",
    "pet": r"pet|dog|cat",
    "household": r"cleaning|detergent|soap",
}


def default_rules() -> dict[str, str]:
    rules = {f"has_{k}": p for k, p in PREMIUM_KEYWORDS.items()}
    rules.update({f"cat_{k}": p for k, p in CATEGORIES.items()})
    return rules


def flag(lowered: Column, pattern: str) -> Column:
    return lowered.rlike(py_regex(pattern)).cast("int")


def flag_columns(text: Column, rules: dict[str, str] | None = None) -> dict[str, Column]:
    """``{name: 0/1 column}`` for each rule; NULL text counts as ''."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return {name: flag(lowered, p) for name, p in (rules or default_rules()).items()}
