"""Variant A feature plan (P1): extraction, measures, imputation, value
transforms, keyword/category flags, out-of-fold target encoding and
interactions -- one lazy DataFrame plan per frame.

``AdvancedFeatures().fit_transform(train)`` returns the training features
(out-of-fold encodings) and a model; ``model.transform(test)`` applies the
training medians and statistics.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import measures as M
from ..functions.flags import default_rules, flag_columns
from ..functions.numeric import interactions, missing_indicator, value_transforms
from ..operators.quantiles import column_medians
from ..sources.files import materialize
from ..operators.target_encoding import KFoldTargetEncoder, KFoldTargetEncoderModel

# The numeric feature list of variant A, in order.
NUMERIC_COLS = [
    "value_filled", "value_missing", "pack_qty", "catalog_length", "name_length",
    "word_count", "unique_words", "avg_word_length", "unique_ratio",
    "bullet_points", "special_chars", "digit_count", "uppercase_count",
    "value_per_pack", "value_squared", "value_log", "value_sqrt", "value_cubed",
    "pack_value_interaction",
    "unit_mean_price", "unit_median_price", "unit_std_price", "unit_count",
    "brand_mean_price", "brand_median_price", "brand_std_price", "brand_count",
    "pack_qty_mean_price", "pack_qty_median_price", "pack_qty_std_price", "pack_qty_count",
    "value_x_unit_mean", "brand_x_unit_mean", "pack_x_value", "value_x_brand",
    "unit_brand_interaction", "estimated_unit_price", "estimated_brand_premium",
    "brand_to_unit_ratio", "value_to_pack_ratio",
]
ENCODED_COLS = ("unit", "brand", "pack_qty")


def extract(df: DataFrame, text_col: str = "catalog_content") -> DataFrame:
    """E1, E4, E5, E6, E9 then T1-T10 (each regex result is projected once)."""
    c = F.col(text_col)
    out = df.withColumns(
        {
            "value": X.value(c),
            "unit": X.unit_normalized(c),
            "item_name": X.item_name(c),
            "_pack_digits": X.pack_digits(c, "A"),
        }
    )
    out = out.withColumns(
        {"pack_qty": X.pack_from_digits(F.col("_pack_digits"), "A"), "brand": X.brand_normalized(F.col("item_name"))}
    ).drop("_pack_digits")
    name = F.col("item_name")
    out = out.withColumns(
        {
            "catalog_length": M.char_length(c),
            "name_length": M.char_length(name),
            "word_count": M.word_count(name),
            "unique_words": M.unique_words(name),
        }
    )
    return out.withColumns(
        {
            "avg_word_length": M.per_word_plus_one(F.col("name_length"), F.col("word_count")),
            "unique_ratio": M.per_word_plus_one(F.col("unique_words"), F.col("word_count")),
            "bullet_points": M.bullet_points(c),
            "special_chars": M.special_chars(name),
            "digit_count": M.digit_count(name),
            "uppercase_count": M.uppercase_count(name),
        }
    )


def impute_and_transform(df: DataFrame, value_median) -> DataFrame:
    """N1 + N3 + N4-N9, ``value_median`` a Column (scalar subquery or literal)."""
    out = df.withColumns({"value_filled": F.coalesce(F.col("value"), value_median), "value_missing": missing_indicator(F.col("value"))})
    return out.withColumns(value_transforms(F.col("value_filled"), F.col("pack_qty")))


def add_flags(df: DataFrame, text_col: str = "catalog_content", rules: dict[str, str] | None = None) -> DataFrame:
    return df.withColumns(flag_columns(F.col(text_col), rules))


def add_interactions(df: DataFrame, global_mean) -> DataFrame:
    return df.withColumns(
        interactions(F.col("value_filled"), F.col("pack_qty"), F.col("unit_mean_price"), F.col("brand_mean_price"), global_mean)
    )


@dataclass
class AdvancedFeaturesModel:
    text_col: str
    rules: dict[str, str]
    value_median: DataFrame  # one row: value_median
    encoder: KFoldTargetEncoderModel

    def _base(self, df: DataFrame) -> DataFrame:
        return self._complete(extract(df, self.text_col))

    def _complete(self, base: DataFrame) -> DataFrame:
        """What follows the extraction."""
        base = impute_and_transform(base, self.value_median.select("value_median").scalar())
        return add_flags(base, self.text_col, self.rules)

    def transform(self, df: DataFrame) -> DataFrame:
        enc = self.encoder.transform(self._base(df))
        gm = self.encoder.scalars.select("global_mean").scalar()
        return add_interactions(enc, gm)


@dataclass
class AdvancedFeatures:
    text_col: str = "catalog_content"
    target: str = "price"
    key: str = "sample_id"
    n_folds: int = 5
    seed: int = 42
    smoothing: float = 10.0
    rules: dict[str, str] = field(default_factory=default_rules)
    approx_median: bool = False

    def fit_transform(self, train: DataFrame) -> tuple[DataFrame, AdvancedFeaturesModel]:
        # extracted once, written once: the fitted statistics read a few narrow columns of it, the features all
        whole = materialize(extract(train, self.text_col), "features_a_fit")
        extracted = whole.select(self.key, self.target, "value", *ENCODED_COLS)
        vmed = column_medians(extracted, ["value"], written_input=True)["value"]
        vm = train.sparkSession.createDataFrame([(vmed,)], "value_median double")
        enc = KFoldTargetEncoder(ENCODED_COLS, self.target, self.key, self.n_folds, self.seed, self.smoothing, self.approx_median)
        # encoder statistics only need the three keys and the target
        model = AdvancedFeaturesModel(self.text_col, self.rules, vm, enc.fit(extracted.select(*ENCODED_COLS, self.target)))
        stats, fold_means = enc.oof_stats(extracted)
        oof = enc.apply_oof(model._complete(whole), stats, fold_means)
        gm = model.encoder.scalars.select("global_mean").scalar()
        return add_interactions(oof.drop("fold"), gm), model
