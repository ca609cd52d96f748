"""Grouped target statistics (A1-A3, A8) and the in-sample stats encoder.

``mean / median / std / count`` follow pandas: sample std (NULL for a
single row), count of non-null targets, exact interpolated median.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import fitted_table, join_dim
from .quantiles import column_medians, group_median


def median_of(c: Column, approx: bool = False) -> Column:
    """Exact interpolated median; ``approx=True`` gives a bounded-memory sketch
    (``percentile_approx``) for groups too large for an exact value map."""
    return F.percentile_approx(c, 0.5, 100_000).cast("double") if approx else F.median(c)


def stat_columns(target: str, names: tuple[str, str, str, str], approx: bool = False) -> list[Column]:
    t = F.col(target).cast("double")
    return [
        F.avg(t).alias(names[0]),
        median_of(t, approx).alias(names[1]),
        F.stddev_samp(t).alias(names[2]),
        F.count(t).alias(names[3]),
    ]


def group_stats(df: DataFrame, key: str | list[str], target: str = "price", names=("mean", "median", "std", "cnt"),
                approx: bool = False, quantiles: str | None = None, written_input: bool = False) -> DataFrame:
    """A1/A2: one row per category with the four statistics.

    Mean/std/count are one partial-aggregated shuffle; the exact median comes
    from ``group_median`` (histogram refinement by default, so a hot category
    is never gathered in one task).  Keys must be non-NULL.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if approx or quantiles == "aggregate":
        return df.groupBy(*keys).agg(*stat_columns(target, names, approx))
    t = F.col(target).cast("double")
    moments = df.groupBy(*keys).agg(F.avg(t).alias(names[0]), F.stddev_samp(t).alias(names[2]), F.count(t).alias(names[3]))
    med = group_median(df, target, keys, names[1], quantiles, write_input=not written_input)
    return moments.join(med, keys, "left").select(*keys, *names)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """A4: the distinct categories of a column (one partial-aggregated shuffle)."""
    return df.select(col).distinct()


def global_stats(df: DataFrame, target: str = "price", quantiles: str | None = None) -> DataFrame:
    """A3: one-row ``(global_mean, global_median)``."""
    med = column_medians(df, [target], quantiles)[target]
    return df.agg(F.avg(F.col(target).cast("double")).alias("global_mean"), F.lit(med).cast("double").alias("global_median"))


def fill_with_frame_median(df: DataFrame, cols: list[str], quantiles: str | None = None, written_input: bool = False) -> DataFrame:
    """NULL -> median of that column in the *current* frame.

    The medians are computed once (exact, bounded per task) and applied as
    literals: one number per column.
    """
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    return fill_with(df, column_medians(df, present, quantiles, written_input), present)


def fill_with(df: DataFrame, medians: dict[str, float | None], cols: list[str]) -> DataFrame:
    """NULL -> the given median of the column; columns without one stay."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(medians[c]).cast("double")) for c in cols
                           if c in df.columns and medians.get(c) is not None})


def stats_names(key: str) -> tuple[str, str, str, str]:
    """Variant B column names."""
    return (f"{key}_price_mean", f"{key}_price_median", f"{key}_price_std", f"{key}_count")


@dataclass
class GroupStatsModel:
    keys: tuple[str, ...]
    tables: dict[str, DataFrame]
    rows: dict[str, int | None] = field(default_factory=dict)

    def transform(self, df: DataFrame, fill: bool = True) -> DataFrame:
        """Left-join each key's table, then A8 median fill over this frame."""
        out = df
        filled: list[str] = []
        for k in self.keys:
            out = join_dim(out, self.tables[k], k, "left", known_rows=self.rows.get(k))
            filled += list(stats_names(k))
        return fill_with_frame_median(out, filled) if fill else out


@dataclass
class GroupStatsEncoder:
    """Plain (in-sample) target statistics per category.

    ``fit(train).transform(train)`` is the leaky in-sample encoding; on new rows
    the stored tables are looked up and misses fall back to the frame median.
    """

    keys: tuple[str, ...] = ("unit", "brand")
    target: str = "price"
    approx: bool = False
    quantiles: str | None = None

    def fit(self, df: DataFrame) -> GroupStatsModel:
        from ..sources.files import materialize

        narrow = materialize(df.select(*self.keys, self.target), "group_stats_fit")
        tables, rows = {}, {}
        for k in self.keys:
            tables[k], rows[k] = fitted_table(group_stats(narrow, k, self.target, stats_names(k), self.approx, self.quantiles, True), f"stats_{k}")
        return GroupStatsModel(self.keys, tables, rows)
