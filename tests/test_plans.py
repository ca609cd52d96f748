"""Plan shape: no Python UDF on feature paths, bounded broadcasts, TF-IDF
fit shuffles terms (not document-term pairs)."""

from fennec.plans import features_a as FA
from fennec.plans.catalog_queries import QUERIES
from fennec.sources.catalog import catalog

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plans_have_no_python_udf(spark):
    for name in ["extract_advanced", "extract_basic", "text_measures", "keyword_flags", "target_encode_oof",
                 "interactions", "group_stats_join", "label_encode", "tfidf_transform", "robust_scale"]:
        p = plan(QUERIES[name](spark, SF))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_scan_is_pruned(spark):
    df = FA.extract(catalog(spark, SF)).select("sample_id", "unit")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "p_retailprice" not in p  # unused column never read


def test_tfidf_fit_aggregates_by_term_only(spark):
    from fennec.operators.tfidf import TfidfVectorizer
    from fennec.sources.tables import table

    docs = table(spark, SF, "documents")
    v = TfidfVectorizer()
    # one tokenization feeds one explode and one aggregation keyed by the term alone
    stats = v._term_stats(v.grams(docs, "doc_id", "text"), "_grams")
    p = plan(stats)
    assert p.count("regexp_extract_all") == 1 and p.count("Generate explode") == 1 and "Union" not in p
    assert "HashAggregate(keys=[term" in p and p.count("Exchange hashpartitioning(term") == 1 and "doc_id" not in p.split("Exchange")[0]


def test_weight_grid_has_no_cartesian_product(spark):
    p = plan(QUERIES["weight_grid_best"](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_state_lookups_are_broadcast(spark):
    from pyspark.sql import functions as F

    from fennec.operators.label_encoder import LabelEncoder
    from fennec.operators.splits import holdout_flag
    from fennec.operators.target_encoding import KFoldTargetEncoder

    f = FA.extract(catalog(spark, SF))
    h = holdout_flag(F.col("sample_id"))
    model = KFoldTargetEncoder().fit(f.where(~h))
    assert model.stats_rows is not None and model.stats_rows > 0
    p = plan(model.transform(f.where(h).drop("price")))
    assert p.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in p
    codes = LabelEncoder(("unit", "brand")).fit(f)
    assert all(n > 0 for n in codes.rows.values())
    assert "SortMergeJoin" not in plan(codes.transform(f))


def test_tfidf_transform_is_map_only(spark):
    from fennec.operators.tfidf import TfidfVectorizer
    from fennec.sources.tables import table

    docs = table(spark, SF, "documents")
    m = TfidfVectorizer().fit(docs, "doc_id", "text")
    for df in (m.transform_long(docs, "doc_id", "text"), m.transform_dense(docs, "doc_id", "text")):
        p = plan(df)
        assert "Exchange" not in p and "PythonUDF" not in p
