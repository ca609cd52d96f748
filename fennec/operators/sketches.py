"""Medians of columns from mergeable quantile sketches (KLL).

A sketch of a part of the rows is one binary value of bounded size; sketches of
parts merge to one of the whole, however the rows were parted.  While a column
has no more than about ``k`` values, its sketch holds them all and the median is
exact; beyond, the rank of the value given is off by at most ``RANK_ERROR`` of the
rows with a probability of 99%.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: its normalised rank error is about 2.3 / k ** 0.9.
K = 4096
RANK_ERROR = 0.0013


def column_sketches(df: DataFrame, cols: list[str], k: int = K) -> DataFrame:
    """``(name, sketch)``, one row per column: its values in ``df`` (NULL and NaN are skipped)."""
    value = {c: F.col(f"`{c}`").cast("double") for c in cols}
    one = df.agg(*[F.kll_sketch_agg_double(F.when(~F.isnan(v), v), F.lit(k)).alias(f"s{i}") for i, v in enumerate(value.values())])
    rows = F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)])
    return one.select(F.explode(rows).alias("r")).select("r.name", "r.sketch")


def merge_sketches(sketches: DataFrame, k: int = K) -> DataFrame:
    """``(name, sketch)`` of all rows of equal name."""
    return sketches.where(F.col("sketch").isNotNull()).groupBy("name").agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_medians(sketches: DataFrame) -> dict[str, float]:
    """Lower median by name (one number per column); columns without values are absent."""
    some = sketches.where(F.col("sketch").isNotNull()).where(F.kll_sketch_get_n_double("sketch") > 0)
    return {r["name"]: r["m"] for r in some.select("name", F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("m")).collect()}
