"""Label encoding (C1 fit, C2 transform with unseen -> -1).

Codes are 0..n-1 in ascending order of the distinct values.  The index is
computed without a single-task window: the distinct values are range-sorted
across partitions, each row's position inside its partition comes from
``monotonically_increasing_id`` (partition id in the upper 31 bits, record
number in the lower 33, as documented), and partition offsets are a prefix sum
over one row per partition.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import materialize
from .joins import fitted_table, join_dim

_LOW33 = (1 << 33) - 1


def global_position(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` with ``out`` = position of the row (from 0) in the order of ``order``."""
    mid = F.monotonically_increasing_id()
    d = df.orderBy(*order).withColumns({"_pid": F.shiftright(mid, 33), "_pos": mid.bitwiseAND(F.lit(_LOW33))})
    # written once: offsets and positions must come from the very same partitions
    d = materialize(d, "sorted_values")
    counts = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: a bound set by the partition count
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return d.join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off")


def dense_index(values: DataFrame, col: str, out: str = "code") -> DataFrame:
    """``(col, out)`` with ``out`` = rank of the value among the distinct values, from 0."""
    d = global_position(values.select(col).where(F.col(col).isNotNull()).distinct(), [col], out)
    return d.select(col, F.col(out).cast("int").alias(out))


@dataclass
class LabelEncoderModel:
    cols: tuple[str, ...]
    codes: dict[str, DataFrame]
    rows: dict[str, int | None] = field(default_factory=dict)
    fill: str = "Unknown"

    def transform(self, df: DataFrame, suffix: str = "_encoded") -> DataFrame:
        out = df
        for c in self.cols:
            key = f"_lk_{c}"
            codes = self.codes[c].withColumnRenamed(c, key).withColumnRenamed("code", f"_code_{c}")
            out = out.withColumn(key, F.coalesce(F.col(c), F.lit(self.fill)))
            out = join_dim(out, codes, key, "left", known_rows=self.rows.get(c))
            out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"_code_{c}"), F.lit(-1))).drop(key, f"_code_{c}")
        return out


@dataclass
class LabelEncoder:
    cols: tuple[str, ...] = ("unit", "brand")
    fill: str = "Unknown"

    def fit(self, df: DataFrame) -> LabelEncoderModel:
        codes, rows = {}, {}
        for c in self.cols:
            codes[c], rows[c] = fitted_table(dense_index(df.select(F.coalesce(F.col(c), F.lit(self.fill)).alias(c)), c), f"codes_{c}")
        return LabelEncoderModel(self.cols, codes, rows, fill=self.fill)
