"""Fitted state persistence (S6, S7): every piece of state is a small table
written as parquet; models use MLlib persistence.  Loading counts each table
once so that joins can broadcast only tables of a known, bounded size."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..operators.label_encoder import LabelEncoderModel
from ..operators.stats import GroupStatsModel
from ..operators.tfidf import TfidfModel, TfidfVectorizer
from ..plans.features_b import ProductFeatureExtractor


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_extractor(ex: ProductFeatureExtractor, path: str) -> None:
    if not ex.fitted:
        raise ValueError("nothing to save: the extractor has no fitted state")
    meta = {"key": ex.key, "text_col": ex.text_col, "stats_keys": list(ex.stats.keys), "label_cols": list(ex.labels.cols),
            "label_fill": ex.labels.fill, "tfidf": None}
    for k in ex.stats.keys:
        _write(ex.stats.tables[k], f"{path}/stats/{k}")
    for c in ex.labels.cols:
        _write(ex.labels.codes[c], f"{path}/labels/{c}")
    if ex.tfidf is not None:
        p = ex.tfidf.params
        meta["tfidf"] = {"max_features": p.max_features, "ngram_range": list(p.ngram_range), "min_df": p.min_df,
                         "max_df": p.max_df, "strip_accents": p.strip_accents,
                         "stop_words": p.stop_words if isinstance(p.stop_words, (str, type(None))) else list(p.stop_words),
                         "sublinear_tf": p.sublinear_tf, "lowercase": p.lowercase}
        _write(ex.tfidf.vocab, f"{path}/tfidf_vocab")
    spark = ex.stats.tables[ex.stats.keys[0]].sparkSession
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").text(f"{path}/meta")


def load_extractor(spark: SparkSession, path: str) -> ProductFeatureExtractor:
    try:
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    except Exception as ex:  # noqa: BLE001
        print(f"Error: fitted extractor not found in {path}")
        raise FileNotFoundError(path) from ex
    tables, rows = {}, {}
    for k in meta["stats_keys"]:
        tables[k] = spark.read.parquet(f"{path}/stats/{k}")
        rows[k] = tables[k].count()
    codes, crow = {}, {}
    for c in meta["label_cols"]:
        codes[c] = spark.read.parquet(f"{path}/labels/{c}")
        crow[c] = codes[c].count()
    ex = ProductFeatureExtractor(key=meta["key"], text_col=meta["text_col"])
    ex.stats = GroupStatsModel(tuple(meta["stats_keys"]), tables, rows)
    ex.labels = LabelEncoderModel(tuple(meta["label_cols"]), codes, crow, meta["label_fill"])
    if meta["tfidf"] is not None:
        t = dict(meta["tfidf"])
        t["ngram_range"] = tuple(t["ngram_range"])
        if isinstance(t["stop_words"], list):
            t["stop_words"] = tuple(t["stop_words"])
        vocab = spark.read.parquet(f"{path}/tfidf_vocab")
        model = TfidfModel(TfidfVectorizer(**t), vocab, bounded=t["max_features"] is not None)
        ex.tfidf = model.materialize() if model.bounded else model
    ex.fitted = True
    return ex


def save_weights(spark: SparkSession, weights: dict[str, float], path: str) -> None:
    spark.createDataFrame([tuple(float(v) for v in weights.values())], ", ".join(f"{k} double" for k in weights)) \
        .write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str) -> dict[str, float]:
    return spark.read.parquet(path).first().asDict()
