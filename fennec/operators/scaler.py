"""Robust scaling (A9 + C5): ``(x - q50) / (q75 - q25)``, an IQR of 0 divides by 1.

Quartiles are exact and interpolated (MLlib's RobustScaler uses approximate
quantiles and does not centre by default, so it is not used).  All features
are fitted together in long form ``(feature, value)`` by the exact quantile
operator, so no feature's values are gathered in one task; the fitted state is
three numbers per feature, applied as literals.  ``approx=True`` uses
``percentile_approx`` instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import column_quantiles


@dataclass
class RobustScalerModel:
    features: list[str]
    quartiles: dict[str, list[float] | None]  # feature -> [q25, q50, q75]; at most len(features) numbers x 3

    def table(self, spark) -> DataFrame:
        """``(feature, q25, q50, q75)``: the fitted state as a table."""
        rows = [(f, *(self.quartiles[f] or [None, None, None])) for f in self.features]
        return spark.createDataFrame(rows, "feature string, q25 double, q50 double, q75 double")

    def transform(self, df: DataFrame) -> DataFrame:
        cols = {}
        for f in self.features:
            q = self.quartiles[f]
            if q is None:
                continue
            iqr = q[2] - q[0]
            scale = 1.0 if iqr == 0 else iqr
            cols[f] = (F.col(f"`{f}`").cast("double") - F.lit(q[1])) / F.lit(scale)
        return df.withColumns(cols)


@dataclass
class RobustScaler:
    features: list[str]
    approx: bool = False
    quantiles: str | None = None

    def fit(self, df: DataFrame) -> RobustScalerModel:
        probs = [0.25, 0.5, 0.75]
        if self.approx:
            row = df.agg(*[F.percentile_approx(F.col(f"`{f}`").cast("double"), probs, 100_000).alias(f) for f in self.features]).first()
            return RobustScalerModel(list(self.features), {f: row[f] for f in self.features})
        return RobustScalerModel(list(self.features), column_quantiles(df, list(self.features), probs, self.quantiles))
