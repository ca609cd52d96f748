"""Dimension joins with a checked broadcast.

A side is broadcast only when its row count is *known* (fitted state records
its count when it is written) and below ``max_rows``.  Otherwise the join is
left to the planner: a shuffle join, which AQE may still turn into a
broadcast once it has measured the side at run time
(``spark.sql.adaptive.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# rows of state tables are a few numbers and a category: 250,000 stay under 100 MB with categories of 300 characters
DEFAULT_BROADCAST_ROWS = 250_000


def join_dim(
    fact: DataFrame,
    dim: DataFrame,
    on: str | list[str] | Column,
    how: str = "left",
    known_rows: int | None = None,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    if known_rows is not None and known_rows <= max_rows:
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)


def join_rows(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the input: neither is broadcast.
    (The planner would go by the size of compressed files, a small part of what
    the rows take in memory.)"""
    return left.join(right.hint("merge"), on, how)


def fitted_table(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write a piece of fitted state once (shared checkpoint folder) and count
    it: later joins read the files and know the size before choosing a
    broadcast."""
    from ..sources.files import materialize

    t = materialize(df, name)
    return t, t.count()
