"""Numeric scalars: IEEE division, value transforms (N3-N17) and matrix
cleaning expressions (N18).  NULL plays the role of pandas' NaN throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def _pos_inf() -> Column:
    return F.lit(float("inf"))


def _neg_inf() -> Column:
    return F.lit(float("-inf"))


def ieee_divide(a: Column, b: Column) -> Column:
    """``a / b`` with float semantics: x/0 -> +-inf, 0/0 -> NULL (NaN), NULL in -> NULL.

    Spark's ANSI mode would raise on x/0, so the zero divisor is handled first.
    """
    a = a.cast("double")
    b = b.cast("double")
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(b != 0, a / b)
        .when(a > 0, _pos_inf())
        .when(a < 0, _neg_inf())
        .otherwise(F.lit(None).cast("double"))
    )


def finite_or_zero(c: Column) -> Column:
    """NULL -> 0 and +-inf -> 0 (the ``fillna(0).replace([inf,-inf], 0)`` rule)."""
    d = c.cast("double")
    return F.when(d.isNull() | F.isnan(d) | (F.abs(d) == _pos_inf()), F.lit(0.0)).otherwise(d)


def missing_indicator(c: Column) -> Column:
    """1 when the value is missing."""
    return c.isNull().cast("int")


def value_transforms(v: Column, pack: Column) -> dict[str, Column]:
    """N4-N9 for variant A (``v`` is the imputed value, ``pack`` the pack quantity)."""
    return {
        "value_per_pack": ieee_divide(v, pack),
        "value_squared": v * v,
        "value_log": F.log1p(v),
        "value_sqrt": F.sqrt(v),
        "value_cubed": v * v * v,
        "pack_value_interaction": pack * v,
    }


def interactions(v: Column, pack: Column, unit_mean: Column, brand_mean: Column, global_mean: Column) -> dict[str, Column]:
    """N9-N16 for variant A, in their fixed order (duplicated products kept by name)."""
    return {
        "value_x_unit_mean": v * unit_mean,
        "brand_x_unit_mean": brand_mean * unit_mean,
        "pack_x_value": pack * v,
        "value_x_brand": v * brand_mean,
        "unit_brand_interaction": unit_mean * brand_mean,
        "estimated_unit_price": ieee_divide(unit_mean, v + F.lit(1)),
        "estimated_brand_premium": ieee_divide(brand_mean, global_mean + F.lit(1)),
        "brand_to_unit_ratio": ieee_divide(brand_mean, unit_mean + F.lit(1)),
        "value_to_pack_ratio": ieee_divide(v, pack + F.lit(1)),
    }
