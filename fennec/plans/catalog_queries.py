"""Registered queries: one per operator family, each over the driver's
tables (``catalog`` is derived from ``part`` + ``lineitem``), with the DuckDB
oracle SQL next to it.  Doubles are rounded to 6 places on both sides and
counts are BIGINT, so results compare by value.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.flags import CATEGORIES, PREMIUM_KEYWORDS, flag_columns
from ..functions.numeric import finite_or_zero, ieee_divide
from ..operators import ensemble as E
from ..operators import evaluation as V
from ..operators import images as I
from ..operators.joins import fitted_table, join_dim, join_rows
from ..operators.label_encoder import LabelEncoder
from ..operators.models import with_log_label
from ..operators.scaler import RobustScaler
from ..operators.splits import hash_fold, holdout_flag, stratified_folds
from ..operators.quantiles import column_medians
from ..operators.stats import GroupStatsEncoder, fill_with_frame_median, global_stats, group_stats
from ..operators.target_encoding import KFoldTargetEncoder, te_names
from ..operators.tfidf import TfidfVectorizer
from ..sources.catalog import catalog
from ..sources.files import materialize
from ..sources.tables import table
from . import features_a as FA
from . import features_b as FB
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, Callable[[], str]] = {}


def register(name: str, sql: Callable[[], str] | None = None):
    """Register a query; ``sql`` builds its oracle only when it is asked for,
    so that no oracle can keep the queries from being imported."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def oracle_sql() -> dict[str, str]:
    return {name: O.portable_rounding(sql()) for name, sql in ORACLE.items()}


def rnd(c: Column | str, digits: int = 6) -> Column:
    """``floor(x * 10^d + 0.5) / 10^d`` for |x| < 1e9: the same float steps as the
    oracle, so both engines emit identical doubles."""
    x = F.col(c) if isinstance(c, str) else c
    q = float(10 ** digits)
    return F.when(F.abs(x) < F.lit(1e9), F.floor(x * F.lit(q) + F.lit(0.5)) / F.lit(q)).otherwise(x.cast("double"))


def r6(c: Column | str) -> Column:
    return rnd(c, 6)


def _rounded(df: DataFrame, keep: list[str], doubles: list[str]) -> DataFrame:
    return df.select(*keep, *[r6(c).alias(c) for c in doubles])


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CAT = O.catalog_cte()
CAT_A = O.extract_a_cte()
CAT_B = O.extract_b_cte()

MEASURE_COLS = ["catalog_length", "name_length", "word_count", "unique_words", "avg_word_length", "unique_ratio",
                "bullet_points", "special_chars", "digit_count", "uppercase_count"]
MEASURE_DOUBLES = {"avg_word_length", "unique_ratio"}


def _sel(cols: list[str], doubles: set[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in doubles else c for c in cols)


# --- E: extraction -----------------------------------------------------------

@register("extract_basic", lambda: _with(CAT, CAT_B) + """
SELECT sample_id, round(value, 6) AS value, unit, item_name, brand, catalog_length, item_name_length,
       item_name_word_count, round(pack_quantity, 6) AS pack_quantity, round(value_filled, 6) AS value_filled
FROM cat_b""")
def q_extract_basic(spark, sf):
    f = FB.extract_catalog_features(catalog(spark, sf, with_price=False))
    return _rounded(f, ["sample_id"], ["value"]).join(
        f.select("sample_id", "unit", "item_name", "brand", "catalog_length", "item_name_length", "item_name_word_count",
                 r6("pack_quantity").alias("pack_quantity"), r6("value_filled").alias("value_filled")), "sample_id")


@register("extract_advanced", lambda: _with(CAT, CAT_A) + f"""
SELECT sample_id, round(value, 6) AS value, unit, item_name, pack_qty, brand, {_sel(MEASURE_COLS, MEASURE_DOUBLES)}
FROM cat_a""")
def q_extract_advanced(spark, sf):
    f = FA.extract(catalog(spark, sf, with_price=False))
    return f.select("sample_id", r6("value").alias("value"), "unit", "item_name", "pack_qty", "brand",
                    *[r6(c).alias(c) if c in MEASURE_DOUBLES else F.col(c) for c in MEASURE_COLS])


# --- T / K: text measures and flags over documents ------------------------------

_DOC_M = O.measures_a("text", "text")


@register("text_measures", lambda: "SELECT doc_id, " + ", ".join(
    (f"round({v}, 6) AS {k}" if k in MEASURE_DOUBLES else f"{v} AS {k}") for k, v in _DOC_M.items())
    + ", round(CAST(len(regexp_extract_all(COALESCE(text, ''), " + O.lit("[^" + O.WS_CHARS + "]+") + ")) AS DOUBLE) / "
    "CAST(len(regexp_extract_all(COALESCE(text, ''), '[.!?]+')) + 1 AS DOUBLE), 6) AS words_per_sentence FROM documents")
def q_text_measures(spark, sf):
    d = table(spark, sf, "documents")
    t = F.col("text")
    cols = {
        "catalog_length": M.char_length(t), "name_length": M.char_length(t), "word_count": M.word_count(t),
        "unique_words": M.unique_words(t), "bullet_points": M.bullet_points(t), "special_chars": M.special_chars(t),
        "digit_count": M.digit_count(t), "uppercase_count": M.uppercase_count(t),
    }
    out = d.select("doc_id", *[v.alias(k) for k, v in cols.items()], r6(M.words_per_sentence(t)).alias("words_per_sentence"))
    out = out.withColumns({
        "avg_word_length": r6(M.per_word_plus_one(F.col("name_length"), F.col("word_count"))),
        "unique_ratio": r6(M.per_word_plus_one(F.col("unique_words"), F.col("word_count"))),
    })
    return out.select("doc_id", *MEASURE_COLS, "words_per_sentence")


def _flags_sql(rules):
    return "SELECT doc_id, " + ", ".join(f"{v} AS {k}" for k, v in O.flags("text", rules).items()) + " FROM documents"


_KW = {f"has_{k}": p for k, p in PREMIUM_KEYWORDS.items()}
_CT = {f"cat_{k}": p for k, p in CATEGORIES.items()}


@register("keyword_flags", lambda: _flags_sql(_KW))
def q_keyword_flags(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", *[c.alias(k) for k, c in flag_columns(F.col("text"), _KW).items()])


@register("category_flags", lambda: _flags_sql(_CT))
def q_category_flags(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", *[c.alias(k) for k, c in flag_columns(F.col("text"), _CT).items()])


# --- N: imputation and numerics ----------------------------------------------

HOLD = O.holdout("sample_id")


@register("impute_train_median", lambda: _with(CAT, CAT_A) + f"""
SELECT sample_id, round(COALESCE(value, (SELECT median(value) FROM cat_a WHERE NOT {HOLD})), 6) AS value_filled,
       CAST(value IS NULL AS INTEGER) AS value_missing
FROM cat_a""")
def q_impute_train_median(spark, sf):
    f = FA.extract(catalog(spark, sf, with_price=False))
    med = F.lit(column_medians(f.where(~holdout_flag(F.col("sample_id"))), ["value"])["value"]).cast("double")
    return f.select("sample_id", r6(F.coalesce(F.col("value"), med)).alias("value_filled"),
                    F.col("value").isNull().cast("int").alias("value_missing"))


@register("impute_self", lambda: _with(CAT, CAT_A, f"s AS (SELECT *, CAST({HOLD} AS INTEGER) AS is_holdout FROM cat_a)") + """
SELECT sample_id, is_holdout,
       round(COALESCE(value, median(value) OVER (PARTITION BY is_holdout)), 6) AS value_filled
FROM s""")
def q_impute_self(spark, sf):
    f = FA.extract(catalog(spark, sf, with_price=False)).withColumn("is_holdout", holdout_flag(F.col("sample_id")).cast("int"))
    parts = []
    for h in (0, 1):
        part = f.where(F.col("is_holdout") == h)
        med = F.lit(column_medians(part, ["value"])["value"]).cast("double")
        parts.append(part.select("sample_id", "is_holdout", r6(F.coalesce(F.col("value"), med)).alias("value_filled")))
    return parts[0].unionByName(parts[1])


_VT = ["value_per_pack", "value_squared", "value_log", "value_sqrt", "value_cubed", "pack_value_interaction"]


@register("numeric_transforms", lambda: _with(CAT, CAT_A, "f AS (SELECT *, COALESCE(value, (SELECT median(value) FROM cat_a)) AS v FROM cat_a)") + f"""
SELECT sample_id, round({O.ieee_divide('v', 'pack_qty')}, 6) AS value_per_pack, round(v * v, 6) AS value_squared,
       round(ln(1 + v), 6) AS value_log, round(sqrt(v), 6) AS value_sqrt, round(v * v * v, 6) AS value_cubed,
       round(pack_qty * v, 6) AS pack_value_interaction
FROM f""")
def q_numeric_transforms(spark, sf):
    f = FA.extract(catalog(spark, sf, with_price=False))
    med = F.lit(column_medians(f, ["value"])["value"]).cast("double")
    out = FA.impute_and_transform(f, med)
    return _rounded(out, ["sample_id"], _VT)


_CLEAN = ["value", "value_pack_ratio"]


@register("matrix_clean_zero", lambda: _with(CAT, CAT_B) + f"""
SELECT sample_id, round(CASE WHEN value IS NULL THEN 0.0 ELSE value END, 6) AS value,
       round(CASE WHEN r IS NULL OR isinf(r) THEN 0.0 ELSE r END, 6) AS value_pack_ratio
FROM (SELECT sample_id, value, {O.ieee_divide('value', 'pack_quantity')} AS r FROM cat_b)""")
def q_matrix_clean_zero(spark, sf):
    f = FB.extract_catalog_features(catalog(spark, sf, with_price=False))
    f = f.withColumn("value_pack_ratio", ieee_divide(F.col("value"), F.col("pack_quantity")))
    return f.select("sample_id", *[r6(finite_or_zero(F.col(c))).alias(c) for c in _CLEAN])


@register("matrix_clean_median", lambda: _with(CAT, CAT_B, f"r AS (SELECT sample_id, value, {O.ieee_divide('value', 'pack_quantity')} AS value_pack_ratio FROM cat_b)") + """
SELECT sample_id, round(COALESCE(value, (SELECT median(value) FROM r)), 6) AS value,
       round(COALESCE(value_pack_ratio, (SELECT median(value_pack_ratio) FROM r)), 6) AS value_pack_ratio
FROM r""")
def q_matrix_clean_median(spark, sf):
    f = FB.extract_catalog_features(catalog(spark, sf, with_price=False))
    f = f.select("sample_id", "value", ieee_divide(F.col("value"), F.col("pack_quantity")).alias("value_pack_ratio"))
    return _rounded(fill_with_frame_median(f, _CLEAN), ["sample_id"], _CLEAN)


# --- A: grouped statistics ---------------------------------------------------

def _stats_sql(key: str) -> str:
    return _with(CAT, CAT_A) + f"""
SELECT CAST({key} AS VARCHAR) AS {key}, round(avg(price), 6) AS mean, round(median(price), 6) AS median,
       round(stddev_samp(price), 6) AS std, count(price) AS cnt
FROM cat_a GROUP BY {key}"""


def _stats_query(key: str):
    def q(spark, sf):
        # written once: the statistics read it several times
        f = materialize(FA.extract(catalog(spark, sf)).select(key, "price"), "group_stats_input")
        s = group_stats(f, key, "price", written_input=True)
        return s.select(F.col(key).cast("string").alias(key), r6("mean").alias("mean"), r6("median").alias("median"),
                        r6("std").alias("std"), "cnt")
    return q


for _k, _n in (("unit", "group_stats_unit"), ("brand", "group_stats_brand"), ("pack_qty", "group_stats_pack")):
    register(_n, functools.partial(_stats_sql, _k))(_stats_query(_k))


@register("global_stats", lambda: _with(CAT) + "SELECT round(avg(price), 6) AS global_mean, round(median(price), 6) AS global_median FROM catalog")
def q_global_stats(spark, sf):
    g = global_stats(catalog(spark, sf), "price")
    return g.select(r6("global_mean").alias("global_mean"), r6("global_median").alias("global_median"))


@register("group_mean_smape", lambda: _with(CAT, CAT_A, "s AS (SELECT unit, avg(price) AS m FROM cat_a GROUP BY unit)") + """
SELECT round(100 * avg(CASE WHEN (abs(price) + abs(m)) / 2 = 0 THEN 0
                            ELSE abs(price - m) / ((abs(price) + abs(m)) / 2) END), 6) AS smape
FROM cat_a JOIN s USING (unit)""")
def q_group_mean_smape(spark, sf):
    """The minimum end-to-end slice: predict the unit group mean, score in-sample."""
    f = FA.extract(catalog(spark, sf))
    s = f.groupBy("unit").agg(F.avg("price").alias("m"))
    return f.join(s, "unit").agg(r6(F.lit(100.0) * F.avg(E.smape_term(F.col("price"), F.col("m")))).alias("smape"))


_B8 = ["unit_price_mean", "unit_price_median", "unit_price_std", "unit_count",
       "brand_price_mean", "brand_price_median", "brand_price_std", "brand_count"]
_B8D = {c for c in _B8 if not c.endswith("_count")}


def _b8_ctes(train_where: str, rows_where: str) -> list[str]:
    """CTEs ending in ``j(sample_id, <8 stat columns>)``: stats of the train rows
    left-joined to the scored rows."""
    ctes = [CAT, CAT_B]
    for k in ("unit", "brand"):
        ctes.append(
            f"s_{k} AS (SELECT {k}, avg(price) AS {k}_price_mean, median(price) AS {k}_price_median, "
            f"stddev_samp(price) AS {k}_price_std, count(price) AS {k}_count FROM cat_b WHERE {train_where} GROUP BY {k})"
        )
    ctes.append("j AS (SELECT r.sample_id, " + ", ".join(_B8) + f" FROM (SELECT * FROM cat_b WHERE {rows_where}) r "
                "LEFT JOIN s_unit USING (unit) LEFT JOIN s_brand USING (brand))")
    return ctes


def _b8_sql(train_where: str, rows_where: str) -> str:
    sel = ", ".join(
        f"round(COALESCE({c}, (SELECT median({c}) FROM j)), 6) AS {c}" if c in _B8D
        else f"CAST(COALESCE(CAST({c} AS DOUBLE), (SELECT median({c}) FROM j)) AS DOUBLE) AS {c}"
        for c in _B8
    )
    return _with(*_b8_ctes(train_where, rows_where)) + f"SELECT sample_id, {sel} FROM j"


def _b8_out(df):
    return df.select("sample_id", *[r6(c).alias(c) if c in _B8D else F.col(c).cast("double").alias(c) for c in _B8])


@register("group_stats_join", lambda: _b8_sql("true", "true"))
def q_group_stats_join(spark, sf):
    f = FB.extract_catalog_features(catalog(spark, sf))
    return _b8_out(GroupStatsEncoder(("unit", "brand")).fit(f).transform(f))


@register("group_stats_lookup", lambda: _b8_sql(f"NOT {HOLD}", HOLD))
def q_group_stats_lookup(spark, sf):
    f = FB.extract_catalog_features(catalog(spark, sf))
    h = holdout_flag(F.col("sample_id"))
    model = GroupStatsEncoder(("unit", "brand")).fit(f.where(~h))
    return _b8_out(model.transform(f.where(h).drop("price")))


# --- C: splits and encoders -----------------------------------------------------

@register("kfold_assign", lambda: f"SELECT p_partkey AS sample_id, {O.fold('p_partkey')} AS fold FROM part")
def q_kfold_assign(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("sample_id"), hash_fold(F.col("p_partkey")).alias("fold"))


@register("holdout_split", lambda: f"SELECT p_partkey AS sample_id, CAST({O.holdout('p_partkey')} AS INTEGER) AS is_holdout FROM part")
def q_holdout_split(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("sample_id"), holdout_flag(F.col("p_partkey")).cast("int").alias("is_holdout"))


@register("stratified_folds", lambda: _with(CAT, "cuts AS (SELECT quantile_cont(price, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS c FROM catalog)") + f"""
SELECT sample_id, stratum, CAST((row_number() OVER (ORDER BY stratum, {O.key_hash('sample_id', ':42')}, sample_id) - 1) % 5 AS INTEGER) AS fold
FROM (SELECT sample_id, CAST(len(list_filter(c, lambda x: x < price)) AS INTEGER) AS stratum FROM catalog, cuts)""")
def q_stratified_folds(spark, sf):
    return stratified_folds(catalog(spark, sf), "sample_id", "price").select("sample_id", "stratum", "fold")


_TE = [n for c in FA.ENCODED_COLS for n in te_names(c)]
_TED = {n for n in _TE if not n.endswith("_count")}


def _te_out(df):
    return df.select("sample_id", *[r6(c).alias(c) if c in _TED else F.col(c) for c in _TE])


def _oof_parts(rounded: bool = True) -> tuple[list[str], str]:
    """``(ctes, select)`` of the out-of-fold encoding over ``fo`` (fold-tagged rows)."""
    R = (lambda e: f"round({e}, 6)") if rounded else (lambda e: e)
    ctes = [CAT, CAT_A, f"fo AS (SELECT *, {O.fold('sample_id')} AS fold FROM cat_a)",
            "hs AS (SELECT * FROM range(5) t(h))",
            "rep AS (SELECT hs.h, fo.* FROM fo JOIN hs ON fo.fold <> hs.h)",
            "gm AS (SELECT h, avg(price) AS g FROM rep GROUP BY h)"]
    sel = []
    joins = []
    for c in FA.ENCODED_COLS:
        ctes.append(
            f"st_{c} AS (SELECT h, CAST({c} AS VARCHAR) AS cat, avg(price) AS m, median(price) AS md, "
            f"stddev_samp(price) AS sd, count(price) AS n FROM rep GROUP BY h, CAST({c} AS VARCHAR))"
        )
        joins.append(f"LEFT JOIN st_{c} ON st_{c}.h = fo.fold AND st_{c}.cat = CAST(fo.{c} AS VARCHAR)")
        mean, med, std, cnt = te_names(c)
        sel += [
            f"{R(f'COALESCE((st_{c}.m * st_{c}.n + gm.g * 10.0) / (st_{c}.n + 10.0), 0.0)')} AS {mean}",
            f"{R(f'COALESCE(st_{c}.md, 0.0)')} AS {med}",
            f"{R(f'COALESCE(st_{c}.sd, 0.0)')} AS {std}",
            f"CAST(COALESCE(st_{c}.n, 0) AS BIGINT) AS {cnt}",
        ]
    return ctes, ", ".join(sel) + " FROM fo LEFT JOIN gm ON gm.h = fo.fold " + " ".join(joins)


def _oof_sql(rounded: bool = True) -> str:
    ctes, select = _oof_parts(rounded)
    return _with(*ctes) + "SELECT fo.sample_id, " + select


@register("target_encode_oof", lambda: _oof_sql())
def q_target_encode_oof(spark, sf):
    f = FA.extract(catalog(spark, sf))
    out, _ = KFoldTargetEncoder().fit_transform(f)
    return _te_out(out)


def _te_test_sql() -> str:
    ctes = [CAT, CAT_A, f"tr AS (SELECT * FROM cat_a WHERE NOT {HOLD})", f"te AS (SELECT * FROM cat_a WHERE {HOLD})",
            "g AS (SELECT avg(price) AS gm, median(price) AS gmed FROM tr)"]
    sel, joins = [], []
    for c in FA.ENCODED_COLS:
        ctes.append(
            f"st_{c} AS (SELECT CAST({c} AS VARCHAR) AS cat, avg(price) AS m, median(price) AS md, "
            f"stddev_samp(price) AS sd, count(price) AS n FROM tr GROUP BY CAST({c} AS VARCHAR))"
        )
        joins.append(f"LEFT JOIN st_{c} ON st_{c}.cat = CAST(te.{c} AS VARCHAR)")
        mean, med, std, cnt = te_names(c)
        sel += [
            f"round(CASE WHEN st_{c}.n IS NULL THEN g.gm ELSE (st_{c}.m * st_{c}.n + g.gm * 10.0) / (st_{c}.n + 10.0) END, 6) AS {mean}",
            f"round(CASE WHEN st_{c}.n IS NULL THEN g.gmed ELSE st_{c}.md END, 6) AS {med}",
            f"round(COALESCE(st_{c}.sd, 0.0), 6) AS {std}",
            f"CAST(COALESCE(st_{c}.n, 0) AS BIGINT) AS {cnt}",
        ]
    return _with(*ctes) + "SELECT te.sample_id, " + ", ".join(sel) + " FROM te, g " + " ".join(joins)


@register("target_encode_test", lambda: _te_test_sql())
def q_target_encode_test(spark, sf):
    f = FA.extract(catalog(spark, sf))
    h = holdout_flag(F.col("sample_id"))
    model = KFoldTargetEncoder().fit(f.where(~h))
    return _te_out(model.transform(f.where(h).drop("price")))


# products of two group means (~1e5..1e7): 2 decimals still keep 9+ significant
# digits, and stay clear of last-bit differences between the engines' sums
_BIG = {"value_x_unit_mean", "brand_x_unit_mean", "value_x_brand", "unit_brand_interaction"}


def _rx(c: str) -> Column:
    return rnd(c, 2 if c in _BIG else 6)


_IX = ["value_x_unit_mean", "brand_x_unit_mean", "pack_x_value", "value_x_brand", "unit_brand_interaction",
       "estimated_unit_price", "estimated_brand_premium", "brand_to_unit_ratio", "value_to_pack_ratio"]


def _interactions_sql() -> str:
    ctes, select = _oof_parts(rounded=False)
    enc = _with(*ctes, "enc AS (SELECT fo.sample_id, fo.value, fo.pack_qty, " + select + ")")
    return enc.rstrip("\n") + f""",
vm AS (SELECT median(value) AS vm FROM cat_a),
gmall AS (SELECT avg(price) AS gm FROM catalog),
x AS (SELECT enc.*, COALESCE(enc.value, vm.vm) AS v FROM enc, vm)
SELECT sample_id,
  round(v * unit_mean_price, 2) AS value_x_unit_mean,
  round(brand_mean_price * unit_mean_price, 2) AS brand_x_unit_mean,
  round(pack_qty * v, 6) AS pack_x_value,
  round(v * brand_mean_price, 2) AS value_x_brand,
  round(unit_mean_price * brand_mean_price, 2) AS unit_brand_interaction,
  round({O.ieee_divide('unit_mean_price', 'v + 1')}, 6) AS estimated_unit_price,
  round({O.ieee_divide('brand_mean_price', 'gm + 1')}, 6) AS estimated_brand_premium,
  round({O.ieee_divide('brand_mean_price', 'unit_mean_price + 1')}, 6) AS brand_to_unit_ratio,
  round({O.ieee_divide('v', 'pack_qty + 1')}, 6) AS value_to_pack_ratio
FROM x, gmall"""


@register("interactions", lambda: _interactions_sql())
def q_interactions(spark, sf):
    feats, _ = FA.AdvancedFeatures().fit_transform(catalog(spark, sf))
    return feats.select("sample_id", *[_rx(c).alias(c) for c in _IX])


def _le_sql(train_where: str, rows_where: str) -> str:
    ctes = [CAT, CAT_B]
    for c in ("unit", "brand"):
        ctes.append(f"codes_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
                    f"FROM (SELECT DISTINCT COALESCE({c}, 'Unknown') AS v FROM cat_b WHERE {train_where}))")
    return _with(*ctes) + f"""
SELECT sample_id, COALESCE(cu.code, -1) AS unit_encoded, COALESCE(cb.code, -1) AS brand_encoded
FROM (SELECT * FROM cat_b WHERE {rows_where}) r
LEFT JOIN codes_unit cu ON cu.v = COALESCE(r.unit, 'Unknown')
LEFT JOIN codes_brand cb ON cb.v = COALESCE(r.brand, 'Unknown')"""


@register("label_encode", lambda: _le_sql("true", "true"))
def q_label_encode(spark, sf):
    f = FB.extract_catalog_features(catalog(spark, sf, with_price=False))
    return LabelEncoder(("unit", "brand")).fit(f).transform(f).select("sample_id", "unit_encoded", "brand_encoded")


@register("label_encode_unseen", lambda: _le_sql(f"NOT {HOLD}", HOLD))
def q_label_encode_unseen(spark, sf):
    f = FB.extract_catalog_features(catalog(spark, sf, with_price=False))
    h = holdout_flag(F.col("sample_id"))
    return LabelEncoder(("unit", "brand")).fit(f.where(~h)).transform(f.where(h)).select("sample_id", "unit_encoded", "brand_encoded")


# --- A9 / C5: robust scaling over lineitem ------------------------------------------

_SC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("robust_scale", lambda: "WITH q AS (SELECT " + ", ".join(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS q_{c}" for c in _SC) + " FROM lineitem)\n"
          "SELECT l_orderkey, l_linenumber, " + ", ".join(
              f"round(({c} - q_{c}[2]) / (CASE WHEN q_{c}[3] - q_{c}[1] = 0 THEN 1.0 ELSE q_{c}[3] - q_{c}[1] END), 6) AS {c}" for c in _SC)
          + " FROM lineitem, q")
def q_robust_scale(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *_SC)
    model = RobustScaler(_SC).fit(li)
    return _rounded(model.transform(li), ["l_orderkey", "l_linenumber"], _SC)


@register("scaler_quartiles", lambda: "SELECT feature, round(q[1], 6) AS q25, round(q[2], 6) AS q50, round(q[3], 6) AS q75 FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, quantile_cont({c}, [0.25, 0.5, 0.75]) AS q FROM lineitem" for c in _SC) + ")")
def q_scaler_quartiles(spark, sf):
    li = table(spark, sf, "lineitem")
    return _rounded(RobustScaler(_SC).fit(li).table(spark), ["feature"], ["q25", "q50", "q75"])


# --- V: TF-IDF over documents --------------------------------------------------------

TFIDF_A = dict(max_features=150, ngram_range=(1, 3), min_df=3, max_df=0.85, strip_accents=True, stop_words="english", sublinear_tf=True)
TFIDF_B = dict(max_features=100, ngram_range=(1, 2), min_df=5, max_df=1.0, strip_accents=False, stop_words="english", sublinear_tf=False)


def _vocab_sql(p) -> str:
    return "WITH " + O.tfidf_vocab_sql("documents", "doc_id", "text", p["max_features"], p["ngram_range"], p["min_df"], p["max_df"],
                                       p["strip_accents"], p["stop_words"] is not None)


@register("tfidf_vocab", lambda: _vocab_sql(TFIDF_A) + "\nSELECT term, idx, df, total_tf, round(idf, 6) AS idf FROM vocab")
def q_tfidf_vocab(spark, sf):
    m = TfidfVectorizer(**TFIDF_A).fit(table(spark, sf, "documents"), "doc_id", "text")
    return m.vocab.select("term", "idx", "df", "total_tf", r6("idf").alias("idf"))


@register("tfidf_vocab_b", lambda: _vocab_sql(TFIDF_B) + "\nSELECT term, idx, df, total_tf, round(idf, 6) AS idf FROM vocab")
def q_tfidf_vocab_b(spark, sf):
    m = TfidfVectorizer(**TFIDF_B).fit(table(spark, sf, "documents"), "doc_id", "text")
    return m.vocab.select("term", "idx", "df", "total_tf", r6("idf").alias("idf"))


@register("tfidf_transform", lambda: _vocab_sql(TFIDF_A) + """,
w AS (SELECT tf._id AS doc_id, vocab.idx, (1.0 + ln(tf.tf)) * vocab.idf AS w FROM tf JOIN vocab USING (term))
SELECT doc_id, idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_tfidf_transform(spark, sf):
    v = TfidfVectorizer(**TFIDF_A)
    docs = v.written_tokens(table(spark, sf, "documents"), "doc_id", "text")
    m = v.fit(docs, "doc_id", "text")
    return m.transform_long(docs, "doc_id", "text").select("doc_id", "idx", r6("weight").alias("weight"))


# --- M / Q: ensembles and metrics over lineitem predictions -----------------------------

PREDS_SQL = """preds AS (SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS a,
  l_extendedprice / l_quantity * (1 - l_discount) AS p1,
  l_extendedprice / l_quantity * (1 + l_tax) AS p2,
  l_extendedprice / (l_quantity + 1) AS p3 FROM lineitem)"""


def preds(spark, sf) -> DataFrame:
    """Three formula predictors of the unit price of every line item."""
    li = table(spark, sf, "lineitem")
    a = F.col("l_extendedprice") / F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber", a.alias("a"), (a * (1 - F.col("l_discount"))).alias("p1"),
                     (a * (1 + F.col("l_tax"))).alias("p2"), (F.col("l_extendedprice") / (F.col("l_quantity") + 1)).alias("p3"))


@register("blend_clamp", lambda: "WITH " + PREDS_SQL + """
SELECT l_orderkey, l_linenumber, round(0.33 * p1 + 0.33 * p2 + 0.34 * p3, 6) AS blend,
       round(greatest(0.33 * p1 + 0.33 * p2 + 0.34 * p3 - 5.0, 0.01), 6) AS clamped FROM preds""")
def q_blend_clamp(spark, sf):
    p = preds(spark, sf)
    b = E.blend(F.col("p1"), F.col("p2"), F.col("p3"))
    return p.select("l_orderkey", "l_linenumber", r6(b).alias("blend"), r6(E.clamp(b - F.lit(5.0))).alias("clamped"))


_GRID = "grid AS (SELECT a AS w1, b AS w2, 100 - a - b AS w3 FROM range(25, 56) t1(a), range(25, 56) t2(b) WHERE 100 - a - b BETWEEN 15 AND 50)"
_GRID_SCORES = ("scores AS (SELECT w1, w2, w3, 100 * avg(CASE WHEN (abs(a) + abs(pr)) / 2 = 0 THEN 0 ELSE abs(a - pr) / ((abs(a) + abs(pr)) / 2) END) AS smape "
                "FROM (SELECT w1, w2, w3, a, (w1 * p1 + w2 * p2 + w3 * p3) / 100.0 AS pr FROM preds, grid) GROUP BY w1, w2, w3)")


@register("weight_grid_scores", lambda: _with(PREDS_SQL, _GRID, _GRID_SCORES) + "SELECT w1, w2, w3, round(smape, 6) AS smape FROM scores")
def q_weight_grid_scores(spark, sf):
    s = E.weight_scores(preds(spark, sf), "a", "p1", "p2", "p3")
    return s.select("w1", "w2", "w3", r6("smape").alias("smape"))


@register("weight_grid_best", lambda: _with(PREDS_SQL, _GRID, _GRID_SCORES) + "SELECT w1, w2, w3, round(smape, 6) AS smape FROM scores ORDER BY round(smape, 9), w1, w2 LIMIT 1")
def q_weight_grid_best(spark, sf):
    s = E.weight_scores(preds(spark, sf), "a", "p1", "p2", "p3").withColumn("smape", rnd("smape", 9))
    return E.best_weights(s).select("w1", "w2", "w3", r6("smape").alias("smape"))


@register("smape_metrics", lambda: "WITH " + PREDS_SQL + """
SELECT round(100 * avg(CASE WHEN (abs(a) + abs(p3)) / 2 = 0 THEN 0 ELSE abs(a - p3) / ((abs(a) + abs(p3)) / 2) END), 6) AS smape_guarded,
       round(100 * avg(CASE WHEN (abs(a) + abs(p3)) / 2 = 0 THEN NULL ELSE abs(p3 - a) / ((abs(a) + abs(p3)) / 2) END), 6) AS smape_unguarded
FROM preds""")
def q_smape_metrics(spark, sf):
    r = V.smape_report(preds(spark, sf), "a", "p3")
    return r.select(r6("smape_guarded").alias("smape_guarded"), r6("smape_unguarded").alias("smape_unguarded"))


@register("evaluate", lambda: "WITH " + PREDS_SQL + """, b AS (SELECT a, 0.33 * p1 + 0.33 * p2 + 0.34 * p3 AS p FROM preds)
SELECT round(avg(abs(a - p)), 6) AS mae, round(sqrt(avg((a - p) * (a - p))), 6) AS rmse,
       round(1 - sum((a - p) * (a - p)) / (var_pop(a) * count(a)), 6) AS r2,
       round(100 * avg(CASE WHEN (abs(a) + abs(p)) / 2 = 0 THEN NULL ELSE abs(p - a) / ((abs(a) + abs(p)) / 2) END), 6) AS smape
FROM b""")
def q_evaluate(spark, sf):
    p = preds(spark, sf).withColumn("p", E.blend(F.col("p1"), F.col("p2"), F.col("p3")))
    r = V.evaluate(p, "a", "p")
    return r.select(*[r6(c).alias(c) for c in ("mae", "rmse", "r2", "smape")])


def _ridge_sql(select: str | None = None) -> str:
    """Gaussian elimination on the centred normal equations (the Spark side uses determinants)."""
    s = ("a0 AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(a) AS my, avg(p1) AS m0, avg(p2) AS m1, avg(p3) AS m2, "
         "covar_pop(p1, p1) AS v00, covar_pop(p1, p2) AS v01, covar_pop(p1, p3) AS v02, covar_pop(p2, p2) AS v11, "
         "covar_pop(p2, p3) AS v12, covar_pop(p3, p3) AS v22, covar_pop(p1, a) AS v0, covar_pop(p2, a) AS v1, covar_pop(p3, a) AS v2 FROM preds)")
    a = ("a1 AS (SELECT *, n*v00 + 1.0 AS a00, n*v01 AS a01, n*v02 AS a02, n*v11 + 1.0 AS a11, n*v12 AS a12, n*v22 + 1.0 AS a22, "
         "n*v0 AS b0, n*v1 AS b1, n*v2 AS b2 FROM a0)")
    e1 = ("e1 AS (SELECT *, a11 - a01*a01/a00 AS d11, a12 - a01*a02/a00 AS d12, a22 - a02*a02/a00 AS d22, "
          "b1 - a01*b0/a00 AS f1, b2 - a02*b0/a00 AS f2 FROM a1)")
    e2 = "e2 AS (SELECT *, (f2 - d12*f1/d11) / (d22 - d12*d12/d11) AS c3 FROM e1)"
    e3 = "e3 AS (SELECT *, (f1 - d12*c3) / d11 AS c2 FROM e2)"
    e4 = "e4 AS (SELECT *, (b0 - a01*c2 - a02*c3) / a00 AS c1 FROM e3)"
    ic = "ic AS (SELECT my - (c1*m0 + c2*m1 + c3*m2) AS intercept, c1, c2, c3 FROM e4)"
    sc = ("sc AS (SELECT 100 * avg(CASE WHEN (abs(a) + abs(st)) / 2 = 0 THEN 0 ELSE abs(a - st) / ((abs(a) + abs(st)) / 2) END) AS stack_smape "
          "FROM (SELECT a, intercept + c1*p1 + c2*p2 + c3*p3 AS st FROM preds, ic))")
    return _with(PREDS_SQL, s, a, e1, e2, e3, e4, ic, sc) + (select or
        "SELECT round(intercept, 6) AS intercept, round(c1, 6) AS c1, round(c2, 6) AS c2, "
        "round(c3, 6) AS c3, round(stack_smape, 6) AS stack_smape FROM ic, sc")


@register("ridge_stack", lambda: _ridge_sql())
def q_ridge_stack(spark, sf):
    r = E.ridge_stack_report(preds(spark, sf), "a", ("p1", "p2", "p3"))
    return r.select(*[r6(c).alias(c) for c in ("intercept", "c1", "c2", "c3", "stack_smape")])


# --- S: outputs, checks, images ----------------------------------------------------------

def catalog_predictions(spark, sf) -> DataFrame:
    """A simple prediction table per sample: clamp(blend of the in-sample unit,
    brand and pack-size group means)."""
    keys = ("unit", "brand", "pack_qty")
    # extracted and written once: each mean and the rows read it
    f = materialize(FA.extract(catalog(spark, sf)).select("sample_id", *keys, "price"), "prediction_input")
    out = f
    for k in keys:
        means, n = fitted_table(f.groupBy(k).agg(F.avg("price").alias(f"m_{k}")), f"means_{k}")
        out = join_dim(out, means, k, "left", known_rows=n)
    b = E.blend(F.col("m_unit"), F.col("m_brand"), F.col("m_pack_qty"))
    return out.select("sample_id", E.clamp(b).alias("price"))


PRED_SQL = _with(CAT, CAT_A, *[f"m_{k} AS (SELECT {k}, avg(price) AS m_{k} FROM cat_a GROUP BY {k})" for k in ("unit", "brand", "pack_qty")],
                 "pr AS (SELECT sample_id, greatest(0.33 * m_unit + 0.33 * m_brand + 0.34 * m_pack_qty, 0.01) AS price "
                 "FROM cat_a LEFT JOIN m_unit USING (unit) LEFT JOIN m_brand USING (brand) LEFT JOIN m_pack_qty USING (pack_qty))")


@register("contract_check", lambda: PRED_SQL + """
SELECT (SELECT count(*) FROM catalog) AS n_in, count(*) AS n_out, count(DISTINCT sample_id) AS n_out_keys,
       count(*) FILTER (WHERE price IS NULL OR isnan(price)) AS n_null_values,
       (SELECT count(*) FROM catalog c WHERE NOT EXISTS (SELECT 1 FROM pr WHERE pr.sample_id = c.sample_id)) AS n_missing_keys,
       (SELECT count(*) FROM pr WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE pr.sample_id = c.sample_id)) AS n_extra_keys
FROM pr""")
def q_contract_check(spark, sf):
    return V.contract_report(catalog(spark, sf, with_price=False), catalog_predictions(spark, sf))


@register("prediction_summary", lambda: PRED_SQL + """
SELECT count(price) AS n, round(min(price), 6) AS min_price, round(max(price), 6) AS max_price,
       round(avg(price), 6) AS mean_price, round(median(price), 6) AS median_price FROM pr""")
def q_prediction_summary(spark, sf):
    s = V.prediction_summary(catalog_predictions(spark, sf))
    return s.select("n", *[r6(c).alias(c) for c in ("min_price", "max_price", "mean_price", "median_price")])


@register("preview", lambda: PRED_SQL + "SELECT sample_id, round(price, 6) AS price FROM pr ORDER BY sample_id LIMIT 10")
def q_preview(spark, sf):
    return V.preview(catalog_predictions(spark, sf)).select("sample_id", r6("price").alias("price"))


@register("image_manifest", lambda: """
SELECT min(url) AS image_link, regexp_extract(url, '([^/]+)/*$', 1) AS filename, false AS "exists"
FROM pages WHERE url IS NOT NULL GROUP BY regexp_extract(url, '([^/]+)/*$', 1)""")
def q_image_manifest(spark, sf):
    return I.manifest(table(spark, sf, "pages"), "url")


# files that are there already: those of every third page
_THERE = "page_id % 3 = 0"


@register("images_to_fetch", lambda: f"""
SELECT min(url) AS image_link, regexp_extract(url, '([^/]+)/*$', 1) AS filename
FROM pages WHERE url IS NOT NULL AND regexp_extract(url, '([^/]+)/*$', 1) NOT IN
  (SELECT regexp_extract(url, '([^/]+)/*$', 1) FROM pages WHERE {_THERE} AND url IS NOT NULL)
GROUP BY regexp_extract(url, '([^/]+)/*$', 1)""")
def q_images_to_fetch(spark, sf):
    """The manifest without the files that exist."""
    pages = table(spark, sf, "pages")
    return I.to_fetch(pages, "url", I.manifest(pages.where(_THERE), "url"))


@register("log_target", lambda: _with(CAT) + "SELECT sample_id, round(ln(1 + price), 6) AS label, round(exp(ln(1 + price)) - 1, 6) AS price FROM catalog")
def q_log_target(spark, sf):
    """M1 + M2: the log label and back."""
    t = with_log_label(catalog(spark, sf).select("sample_id", "price"))
    return t.select("sample_id", r6("label").alias("label"), r6(F.expm1("label")).alias("price"))


@register("stack_switch", lambda: _ridge_sql("""
SELECT t.threshold, round(blend, 6) AS blend_smape, round(stack_smape, 6) AS stack_smape, (blend > threshold AND stack_smape < blend) AS stacked
FROM (VALUES (1.0), (5.0), (1000.0)) t(threshold), sc,
     (SELECT 100 * avg(CASE WHEN (abs(a) + abs(p)) / 2 = 0 THEN 0 ELSE abs(a - p) / ((abs(a) + abs(p)) / 2) END) AS blend
      FROM (SELECT a, 0.33 * p1 + 0.33 * p2 + 0.34 * p3 AS p FROM preds)) b"""))
def q_stack_switch(spark, sf):
    """Whether the stack replaces the blend, for several targets."""
    p = preds(spark, sf)
    blend = p.agg(E.smape(F.col("a"), E.blend(F.col("p1"), F.col("p2"), F.col("p3"))).alias("s")).first()["s"]
    stack = E.ridge_stack_report(p, "a", ("p1", "p2", "p3")).first()["stack_smape"]
    rows = [(t, float(blend), float(stack), E.use_stacking(blend, stack, t)) for t in (1.0, 5.0, 1000.0)]
    out = spark.createDataFrame(rows, "threshold double, blend_smape double, stack_smape double, stacked boolean")
    return out.select("threshold", r6("blend_smape").alias("blend_smape"), r6("stack_smape").alias("stack_smape"), "stacked")


# --- S1 / S4: product CSV round trip ---------------------------------------------------------

@register("csv_roundtrip", lambda: _with(CAT) + "SELECT sample_id, catalog_content, image_link, round(price, 6) AS price FROM catalog")
def q_csv_roundtrip(spark, sf):
    """Write the catalog as product CSV (multi-line quoted text) into the
    shared checkpoint folder and read it back with the product reader."""
    from ..session import scratch_path
    from ..sources.files import read_products, write_products

    path = scratch_path(spark, "catalog_csv")
    write_products(catalog(spark, sf), path)
    back = read_products(spark, path)
    return back.select("sample_id", "catalog_content", "image_link", r6("price").alias("price"))


def shuffled_products(spark, sf) -> DataFrame:
    """The catalog as product CSV in the order of a hash of its keys, read back
    by ranges with the place of each row."""
    from ..session import scratch_path
    from ..sources.files import read_products, write_products

    path = scratch_path(spark, "shuffled_csv")
    write_products(catalog(spark, sf).orderBy(F.md5(F.col("sample_id").cast("string")), "sample_id"), path)
    return read_products(spark, path, position="row_pos", splittable=True)


@register("csv_record_places", lambda: _with(CAT) + """
SELECT sample_id, catalog_content, image_link, round(price, 6) AS price,
       row_number() OVER (ORDER BY md5(CAST(sample_id AS VARCHAR)), sample_id) - 1 AS row_pos FROM catalog""")
def q_csv_record_places(spark, sf):
    back = shuffled_products(spark, sf)
    return back.select("sample_id", "catalog_content", "image_link", r6("price").alias("price"), "row_pos")


@register("contract_order", lambda: PRED_SQL + """
SELECT written, n AS n_in, n AS n_out, n AS n_out_keys, CAST(0 AS BIGINT) AS n_null_values, CAST(0 AS BIGINT) AS n_missing_keys,
       CAST(0 AS BIGINT) AS n_extra_keys, CAST(CASE written WHEN 'in order' THEN 0 ELSE n - n % 2 END AS BIGINT) AS n_out_of_order
FROM (SELECT count(*) AS n FROM pr), (VALUES ('in order'), ('backwards')) AS w(written)""")
def q_contract_order(spark, sf):
    """Predictions written in the order of the input, and backwards; both files
    read back and held against the input place by place."""
    from ..session import scratch_path
    from ..sources.files import read_predictions, write_predictions

    inputs = shuffled_products(spark, sf).select("sample_id", "row_pos")
    scored = materialize(join_rows(catalog_predictions(spark, sf), inputs, "sample_id"), "placed_predictions")
    reports = []
    for name, order in (("in order", F.col("row_pos")), ("backwards", -F.col("row_pos"))):
        path = scratch_path(spark, "ordered_csv")
        write_predictions(scored.withColumn("place", order), path, order="place")
        back = read_predictions(spark, path)
        reports.append(V.contract_report(inputs, back, position="row_pos").withColumn("written", F.lit(name)))
    return reports[0].unionByName(reports[1])


# --- P1: the whole variant A feature frame ------------------------------------------------------

_FLAG_COLS = [f"has_{k}" for k in PREMIUM_KEYWORDS] + [f"cat_{k}" for k in CATEGORIES]
_A_INT = {"value_missing", "pack_qty", "catalog_length", "name_length", "word_count", "unique_words", "bullet_points",
          "special_chars", "digit_count", "uppercase_count", "unit_count", "brand_count", "pack_qty_count"}


def _a_frame_out(df):
    cols = FA.NUMERIC_COLS + _FLAG_COLS
    return df.select("sample_id", *[F.col(c) if (c in _A_INT or c in _FLAG_COLS) else _rx(c).alias(c) for c in cols])


def _a_frame_sql(train: bool) -> str:
    ctes = [CAT, CAT_A]
    if train:
        ctes += [f"fo AS (SELECT *, {O.fold('sample_id')} AS fold FROM cat_a)", "hs AS (SELECT * FROM range(5) t(h))",
                 "rep AS (SELECT hs.h, fo.* FROM fo JOIN hs ON fo.fold <> hs.h)",
                 "gm AS (SELECT h, avg(price) AS g FROM rep GROUP BY h)",
                 "vm AS (SELECT median(value) AS vm FROM cat_a)", "gall AS (SELECT avg(price) AS gm FROM cat_a)"]
        src, on_fold = "fo", True
    else:
        ctes += [f"tr AS (SELECT * FROM cat_a WHERE NOT {HOLD})", f"te AS (SELECT * FROM cat_a WHERE {HOLD})",
                 "g AS (SELECT avg(price) AS gm, median(price) AS gmed FROM tr)", "vm AS (SELECT median(value) AS vm FROM tr)",
                 "gall AS (SELECT gm FROM g)"]
        src, on_fold = "te", False
    sel, joins = [], []
    for c in FA.ENCODED_COLS:
        grp = "h, " if on_fold else ""
        frm = "rep" if on_fold else "tr"
        ctes.append(f"st_{c} AS (SELECT {grp}CAST({c} AS VARCHAR) AS cat, avg(price) AS m, median(price) AS md, "
                    f"stddev_samp(price) AS sd, count(price) AS n FROM {frm} GROUP BY {grp}CAST({c} AS VARCHAR))")
        cond = f"st_{c}.h = {src}.fold AND " if on_fold else ""
        joins.append(f"LEFT JOIN st_{c} ON {cond}st_{c}.cat = CAST({src}.{c} AS VARCHAR)")
        mean, med, std, cnt = te_names(c)
        if on_fold:
            sel += [f"COALESCE((st_{c}.m * st_{c}.n + gm.g * 10.0) / (st_{c}.n + 10.0), 0.0) AS {mean}",
                    f"COALESCE(st_{c}.md, 0.0) AS {med}"]
        else:
            sel += [f"CASE WHEN st_{c}.n IS NULL THEN g.gm ELSE (st_{c}.m * st_{c}.n + g.gm * 10.0) / (st_{c}.n + 10.0) END AS {mean}",
                    f"CASE WHEN st_{c}.n IS NULL THEN g.gmed ELSE st_{c}.md END AS {med}"]
        sel += [f"COALESCE(st_{c}.sd, 0.0) AS {std}", f"CAST(COALESCE(st_{c}.n, 0) AS BIGINT) AS {cnt}"]
    extra = "LEFT JOIN gm ON gm.h = fo.fold " if on_fold else ", g "
    ctes.append(f"enc AS (SELECT {src}.*, " + ", ".join(sel) + f" FROM {src} {extra}" + " ".join(joins) + ")")
    ctes.append("x AS (SELECT enc.*, COALESCE(enc.value, vm.vm) AS v, gall.gm AS gmean FROM enc, vm, gall)")
    out = {
        "value_filled": "v", "value_missing": "CAST(value IS NULL AS INTEGER)", "pack_qty": "pack_qty",
        "catalog_length": "catalog_length", "name_length": "name_length", "word_count": "word_count",
        "unique_words": "unique_words", "avg_word_length": "avg_word_length", "unique_ratio": "unique_ratio",
        "bullet_points": "bullet_points", "special_chars": "special_chars", "digit_count": "digit_count",
        "uppercase_count": "uppercase_count", "value_per_pack": O.ieee_divide("v", "pack_qty"),
        "value_squared": "v * v", "value_log": "ln(1 + v)", "value_sqrt": "sqrt(v)", "value_cubed": "v * v * v",
        "pack_value_interaction": "pack_qty * v",
    }
    for c in FA.ENCODED_COLS:
        for n in te_names(c):
            out[n] = n
    out.update({
        "value_x_unit_mean": "v * unit_mean_price", "brand_x_unit_mean": "brand_mean_price * unit_mean_price",
        "pack_x_value": "pack_qty * v", "value_x_brand": "v * brand_mean_price",
        "unit_brand_interaction": "unit_mean_price * brand_mean_price",
        "estimated_unit_price": O.ieee_divide("unit_mean_price", "v + 1"),
        "estimated_brand_premium": O.ieee_divide("brand_mean_price", "gmean + 1"),
        "brand_to_unit_ratio": O.ieee_divide("brand_mean_price", "unit_mean_price + 1"),
        "value_to_pack_ratio": O.ieee_divide("v", "pack_qty + 1"),
    })
    cols = [f"{out[c]} AS {c}" if (c in _A_INT) else f"round({out[c]}, {2 if c in _BIG else 6}) AS {c}" for c in FA.NUMERIC_COLS]
    cols += _FLAG_COLS
    return _with(*ctes) + "SELECT sample_id, " + ", ".join(cols) + " FROM x"


@register("features_a_train", lambda: _a_frame_sql(True))
def q_features_a_train(spark, sf):
    feats, _ = FA.AdvancedFeatures().fit_transform(catalog(spark, sf))
    return _a_frame_out(feats)


@register("features_a_test", lambda: _a_frame_sql(False))
def q_features_a_test(spark, sf):
    cat = catalog(spark, sf)
    h = holdout_flag(F.col("sample_id"))
    _, model = FA.AdvancedFeatures().fit_transform(cat.where(~h))
    return _a_frame_out(model.transform(cat.where(h).drop("price")))


# --- P2-P5, P9, P10: the variant B matrix (without TF-IDF) ------------------------------------------

_B_INT = {"item_name_length", "item_name_word_count", "catalog_length", "unit_encoded", "brand_encoded"}


def _b_matrix_sql() -> str:
    ctes = _b8_ctes("true", "true")
    for c in ("unit", "brand"):
        ctes.append(f"codes_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code "
                    f"FROM (SELECT DISTINCT COALESCE({c}, 'Unknown') AS v FROM cat_b))")
    ctes.append(
        "m AS (SELECT b.sample_id, b.value_filled, b.pack_quantity, b.catalog_length, b.item_name_length, b.item_name_word_count, "
        f"{O.ieee_divide('b.value_filled', 'b.pack_quantity')} AS value_pack_ratio, "
        "CAST(b.item_name_length AS DOUBLE) / CAST(b.item_name_word_count + 1 AS DOUBLE) AS avg_word_length, "
        "COALESCE(cu.code, -1) AS unit_encoded, COALESCE(cb.code, -1) AS brand_encoded, "
        + ", ".join(f"CAST(j.{c} AS DOUBLE) AS {c}" for c in _B8)
        + " FROM cat_b b JOIN j USING (sample_id) LEFT JOIN codes_unit cu ON cu.v = COALESCE(b.unit, 'Unknown') "
        "LEFT JOIN codes_brand cb ON cb.v = COALESCE(b.brand, 'Unknown'))"
    )
    filled = []
    for c in FB.BASE_FEATURES:
        e = f"COALESCE({c}, (SELECT median({c}) FROM m))"
        filled.append(f"{e} AS {c}" if c in _B_INT else f"round({e}, 6) AS {c}")
    return _with(*ctes) + "SELECT sample_id, " + ", ".join(filled) + " FROM m"


@register("features_b_matrix", lambda: _b_matrix_sql())
def q_features_b_matrix(spark, sf):
    ex = FB.ProductFeatureExtractor()
    feats = ex.fit_transform(catalog(spark, sf), use_tfidf=False)
    names = ex.get_feature_names(use_tfidf=False)
    from ..operators.assemble import align_columns, clean_median

    X = clean_median(align_columns(feats, names, keep=["sample_id"]), names)
    return X.select("sample_id", *[F.col(c) if c in _B_INT else r6(c).alias(c) for c in names])


@register("tfidf_item_names", lambda: "WITH " + CAT + ",\n" + O.extract_b_cte() + ",\n" + O.tfidf_vocab_sql(
    "cat_b", "sample_id", "item_name", 100, (1, 2), 5, 1.0, False, True)
    + """,
w AS (SELECT tf._id AS sample_id, vocab.idx, tf.tf * vocab.idf AS w FROM tf JOIN vocab USING (term))
SELECT sample_id, idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY sample_id)), 6) AS weight FROM w""")
def q_tfidf_item_names(spark, sf):
    """V1-V12 as variant B applies them: TF-IDF of the extracted item names."""
    v = TfidfVectorizer(**TFIDF_B)
    f = v.written_tokens(FB.extract_catalog_features(catalog(spark, sf, with_price=False)), "sample_id", "item_name")
    m = v.fit(f, "sample_id", "item_name")
    return m.transform_long(f, "sample_id", "item_name").select("sample_id", "idx", r6("weight").alias("weight"))


def _b_transform_sql() -> str:
    tf = dict(ngram=(1, 2), strip_accents=False, stop=True)
    return ("WITH " + CAT + ",\n" + O.extract_b_cte() + f""",
cat_tr AS (SELECT * FROM cat_b WHERE NOT {HOLD}),
cat_te AS (SELECT * FROM cat_b WHERE {HOLD}),
""" + O.tfidf_vocab_sql("cat_tr", "sample_id", "item_name", 100, (1, 2), 5, 1.0, False, True) + ",\n"
            + O.tfidf_terms_cte("cat_te", "sample_id", "item_name", name="ht", **tf) + """,
htf AS (SELECT _id, term, count(*) AS tf FROM ht GROUP BY _id, term),
w AS (SELECT htf._id AS sample_id, vocab.idx, htf.tf * vocab.idf AS w FROM htf JOIN vocab USING (term))
SELECT sample_id, idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY sample_id)), 6) AS weight FROM w""")


@register("features_b_transform", lambda: _b_transform_sql())
def q_features_b_transform(spark, sf):
    """P7 + P8 with TF-IDF: fitted on the training rows, applied to the hold-out:
    the non-zero ``tfidf_`` columns by position."""
    cat = catalog(spark, sf)
    h = holdout_flag(F.col("sample_id"))
    ex = FB.ProductFeatureExtractor()
    ex.fit_transform(cat.where(~h))
    names = [n for n in ex.get_feature_names() if n.startswith("tfidf_")]
    feats = ex.transform(cat.where(h)).select("sample_id", F.posexplode(F.array(*names)).alias("idx", "weight"))
    return feats.where(F.col("weight") > 0).select("sample_id", "idx", r6("weight").alias("weight"))


# --- P4 ratio features and A4 category list ---------------------------------------------------------

@register("ratio_features", lambda: _with(CAT, CAT_B) + f"""
SELECT sample_id, round({O.ieee_divide('value_filled', 'pack_quantity')}, 6) AS value_pack_ratio,
       round(CAST(item_name_length AS DOUBLE) / CAST(item_name_word_count + 1 AS DOUBLE), 6) AS avg_word_length,
       concat_ws('_', unit, brand) AS unit_brand
FROM cat_b""")
def q_ratio_features(spark, sf):
    f = FB.create_ratio_features(FB.extract_catalog_features(catalog(spark, sf, with_price=False)))
    return f.select("sample_id", r6("value_pack_ratio").alias("value_pack_ratio"), r6("avg_word_length").alias("avg_word_length"), "unit_brand")


@register("category_values", lambda: _with(CAT, CAT_A) + """
SELECT 'unit' AS col, unit AS cat FROM (SELECT DISTINCT unit FROM cat_a)
UNION ALL SELECT 'brand', brand FROM (SELECT DISTINCT brand FROM cat_a)
UNION ALL SELECT 'pack_qty', CAST(pack_qty AS VARCHAR) FROM (SELECT DISTINCT pack_qty FROM cat_a)""")
def q_category_values(spark, sf):
    from ..operators.stats import distinct_values

    f = FA.extract(catalog(spark, sf, with_price=False))
    parts = [distinct_values(f, c).select(F.lit(c).alias("col"), F.col(c).cast("string").alias("cat")) for c in FA.ENCODED_COLS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- exact quantiles on large / hot groups ------------------------------------------------------

@register("unit_price_quartiles", lambda: """
WITH u AS (SELECT l_returnflag, l_extendedprice / l_quantity AS up FROM lineitem)
SELECT 'all' AS grp, round(quantile_cont(up, 0.25), 6) AS q25, round(quantile_cont(up, 0.5), 6) AS q50,
       round(quantile_cont(up, 0.75), 6) AS q75 FROM u
UNION ALL
SELECT l_returnflag, round(quantile_cont(up, 0.25), 6), round(quantile_cont(up, 0.5), 6), round(quantile_cont(up, 0.75), 6)
FROM u GROUP BY l_returnflag""")
def q_unit_price_quartiles(spark, sf):
    """A9 at scale: the whole-table group (and the largest flag group at larger
    scales) exceeds the one-pass bound and is resolved by histogram refinement."""
    from ..operators.quantiles import exact_quantiles

    li = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_extendedprice") / F.col("l_quantity")).alias("up"))
    probs = [0.25, 0.5, 0.75]
    allq = exact_quantiles(li, "up", probs).select(F.lit("all").alias("grp"), "q")
    per = exact_quantiles(li, "up", probs, ["l_returnflag"]).select(F.col("l_returnflag").alias("grp"), "q")
    out = allq.unionByName(per)
    return out.select("grp", *[r6(F.col("q")[i]).alias(n) for i, n in enumerate(["q25", "q50", "q75"])])


# --- S12: dataset shape report --------------------------------------------------------------------

@register("shape_report", lambda: "WITH " + CAT + ",\n" + O.extract_a_cte() + ",\n" + O.tfidf_vocab_sql(
    "cat_a", "sample_id", "item_name", 150, (1, 3), 3, 0.85, True, True) + """
SELECT (SELECT count(*) FROM catalog) AS n_rows, 40 AS n_numeric, 16 AS n_keyword, 7 AS n_category,
       (SELECT CAST(count(*) AS INTEGER) FROM vocab) AS n_text,
       63 + (SELECT CAST(count(*) AS INTEGER) FROM vocab) AS n_features""")
def q_shape_report(spark, sf):
    """Rows and feature counts by group of the variant A matrix."""
    from ..operators.assemble import by_prefix
    from ..operators.evaluation import shape_report

    feats, _ = FA.AdvancedFeatures().fit_transform(catalog(spark, sf))
    # the vocabulary and the report read the features several times: written once, without the raw text
    feats = materialize(feats.drop("catalog_content", "image_link"), "features_train")
    tf = TfidfVectorizer(**TFIDF_A).fit(feats, "sample_id", "item_name")
    groups = {"n_numeric": FA.NUMERIC_COLS, "n_keyword": by_prefix(feats, ("has_",)), "n_category": by_prefix(feats, ("cat_",)),
              "n_text": [f"text_{i}" for i in range(tf.size())]}
    rep = shape_report(feats, groups)
    row = (rep["rows"], *[rep[k] for k in groups], sum(rep[k] for k in groups))
    return spark.createDataFrame([row], "n_rows long, n_numeric int, n_keyword int, n_category int, n_text int, n_features int")


# --- V12 + N24: named dense TF-IDF columns bound to every row by key --------------------------------

_DENSE_K = TFIDF_A["max_features"]


def _dense_sql() -> str:
    cols = ", ".join(f"round(COALESCE(max(CASE WHEN w.idx = {i} THEN w.weight END), 0.0), 6) AS text_{i}" for i in range(_DENSE_K))
    return _vocab_sql(TFIDF_A) + """,
wt AS (SELECT tf._id AS doc_id, vocab.idx, (1.0 + ln(tf.tf)) * vocab.idf AS w FROM tf JOIN vocab USING (term)),
wl AS (SELECT doc_id, idx, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM wt)
SELECT d.doc_id, """ + cols + """
FROM documents d LEFT JOIN wl w ON w.doc_id = d.doc_id GROUP BY d.doc_id"""


@register("tfidf_dense", lambda: _dense_sql())
def q_tfidf_dense(spark, sf):
    """Every document with ``text_0..text_{k-1}`` (vocabulary order), zeros
    where a term is absent; the vocabulary holds ``max_features`` terms at
    every scale of the driver tables."""
    v = TfidfVectorizer(**TFIDF_A)
    docs = v.written_tokens(table(spark, sf, "documents"), "doc_id", "text")
    m = v.fit(docs, "doc_id", "text")
    out, names = m.transform_columns(docs, "doc_id", "text", prefix="text_", size=_DENSE_K)
    return out.select("doc_id", *[r6(n).alias(n) for n in names])
