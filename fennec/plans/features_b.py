"""Variant B feature plan (P2-P10): the extractor object API.

``ProductFeatureExtractor`` keeps fitted state as DataFrames (stats tables,
label codes, TF-IDF vocabulary); ``transform`` before ``fit_transform`` raises.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions import measures as M
from ..functions.numeric import ieee_divide
from ..operators.assemble import align_columns, clean_median
from ..operators.label_encoder import LabelEncoder, LabelEncoderModel
from ..operators.quantiles import column_medians
from ..operators.stats import GroupStatsEncoder, GroupStatsModel, fill_with, stats_names
from ..operators.tfidf import TfidfModel, TfidfVectorizer
from ..sources.files import materialize

# Base feature list of variant B, in order.
BASE_FEATURES = [
    "value_filled", "pack_quantity", "catalog_length", "item_name_length",
    "item_name_word_count", "value_pack_ratio", "avg_word_length",
    "unit_encoded", "brand_encoded",
    "unit_price_mean", "unit_price_median", "unit_price_std", "unit_count",
    "brand_price_mean", "brand_price_median", "brand_price_std", "brand_count",
]


def extract_catalog_features(df: DataFrame, text_col: str = "catalog_content", medians: dict[str, float] | None = None) -> DataFrame:
    """E2, E3, E5, E8, T1-T3, E7 and N2 (median of *this* frame, unless ``medians`` are given)."""
    c = F.col(text_col)
    out = df.withColumns({"value": X.value(c), "unit": X.unit_raw(c), "item_name": X.item_name(c)})
    name = F.col("item_name")
    out = out.withColumns(
        {
            "brand": X.brand_raw(name),
            "catalog_length": M.char_length(c),
            "item_name_length": M.char_length(name),
            "item_name_word_count": M.word_count(name),
            "pack_quantity": X.pack_quantity(c, "B"),
        }
    )
    if medians is None:
        out = materialize(out, "extracted")  # the median's rounds and all that follows read it
        med = column_medians(out, ["value"], written_input=True)["value"]
    else:
        med = medians.get("value")
    return out.withColumn("value_filled", F.coalesce(F.col("value"), F.lit(med).cast("double")))


def create_ratio_features(df: DataFrame) -> DataFrame:
    """N4 (inf kept), T5, N17."""
    return df.withColumns(
        {
            "value_pack_ratio": ieee_divide(F.col("value_filled"), F.col("pack_quantity")),
            "avg_word_length": M.per_word_plus_one(F.col("item_name_length"), F.col("item_name_word_count")),
            "unit_brand": F.concat_ws("_", F.col("unit"), F.col("brand")),
        }
    )


@dataclass
class ProductFeatureExtractor:
    key: str = "sample_id"
    text_col: str = "catalog_content"
    stats: GroupStatsModel | None = None
    labels: LabelEncoderModel | None = None
    tfidf: TfidfModel | None = None
    fitted: bool = False
    tfidf_params: dict = field(default_factory=dict)

    def fit_transform(self, df: DataFrame, target_col: str = "price", use_tfidf: bool = True, max_tfidf_features: int = 100) -> DataFrame:
        """Fit every piece of state on ``df`` and return its features.

        The extracted frame is written (in ``extract_catalog_features``); statistics, medians, codes and
        the vocabulary all read the files instead of extracting again."""
        base = extract_catalog_features(df, self.text_col)
        self.stats = GroupStatsEncoder(("unit", "brand"), target_col).fit(base)
        out = create_ratio_features(self.stats.transform(base))
        self.labels = LabelEncoder(("unit", "brand")).fit(out)
        out = self.labels.transform(out)
        if use_tfidf:
            params = dict(max_features=max_tfidf_features, ngram_range=(1, 2), min_df=5, max_df=1.0, strip_accents=False, stop_words="english", sublinear_tf=False)
            params.update(self.tfidf_params)
            # the vocabulary fit reads its input several times: write the two
            # columns it needs once (the returned frame keeps every column)
            fit_input = materialize(out.select(self.key, "item_name"), "extractor_tfidf_fit")
            self.tfidf = TfidfVectorizer(**params).fit(fit_input, self.key, "item_name")
            out, _ = self.tfidf.transform_columns(out, self.key, "item_name", prefix="tfidf_")
        self.fitted = True
        return out

    def transform(self, df: DataFrame, use_tfidf: bool = True, medians: dict[str, float] | None = None) -> DataFrame:
        """Apply the fitted state (stats lookups, codes, vocabulary).

        What is missing gets the median of this frame or, where ``df`` is a part
        of a larger input, the given ``medians`` of the columns of ``median_inputs``."""
        if not self.fitted:
            raise ValueError("transform needs fitted state; call fit_transform before it")
        base = extract_catalog_features(df, self.text_col, medians)
        out = create_ratio_features(self.stats.transform(base, fill=medians is None))
        if medians is not None:
            out = fill_with(out, medians, BASE_FEATURES)
        out = self.labels.transform(out)
        if use_tfidf:
            if self.tfidf is None:
                raise ValueError("the extractor was fitted without TF-IDF")
            out, _ = self.tfidf.transform_columns(out, self.key, "item_name", prefix="tfidf_")
        return out

    def median_inputs(self, df: DataFrame) -> DataFrame:
        """The columns whose medians ``transform`` needs, nothing filled: the parsed
        ``value`` and the joined statistics."""
        base = extract_catalog_features(df, self.text_col, medians={})
        out = self.stats.transform(base, fill=False)
        return out.select("value", *[n for k in self.stats.keys for n in stats_names(k)])

    def get_feature_names(self, use_tfidf: bool = True) -> list[str]:
        """P9."""
        names = list(BASE_FEATURES)
        if use_tfidf and self.tfidf is not None:
            names += [f"tfidf_{i}" for i in range(self.tfidf.size())]
        return names


def prepare_features_for_modeling(df: DataFrame, extractor: ProductFeatureExtractor, target_col: str = "price", is_train: bool = True):
    """P10: ``(X, y, features)``; X = key + aligned feature columns with NULLs
    filled by the frame median (N19-N21), y = key + target (train only)."""
    feats = extractor.fit_transform(df, target_col=target_col) if is_train else extractor.transform(df)
    names = extractor.get_feature_names()
    # the aligned matrix is the model input: write it once, then fill from the files
    X_ = clean_median(materialize(align_columns(feats, names, keep=[extractor.key]), "model_matrix"), names, written_input=True)
    # the target passes through the features unchanged: read it from the input
    # (a scan) rather than from the feature plan
    y = df.select(extractor.key, target_col) if is_train and target_col in df.columns else None
    return X_, y, feats
