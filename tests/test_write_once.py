"""Inputs that are read several times are written once, and tables that grow with
the input are never broadcast."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fennec.operators import boosting as B
from fennec.operators.evaluation import contract_report, prediction_summary
from fennec.operators.joins import join_rows
from fennec.plans import catalog_queries as Q
from fennec.plans import features_a as FA
from fennec.sources.catalog import catalog

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def counted(spark, monkeypatch):
    """Counts the texts that are extracted."""
    seen, extract = spark.sparkContext.accumulator(0), FA.extract

    @F.udf("string")
    def passed(text):
        seen.add(1)
        return text

    monkeypatch.setattr(FA, "extract", lambda df, c="catalog_content": extract(df.withColumn(c, passed.asNondeterministic()(c)), c))
    return seen


def test_catalog_prices_are_not_broadcast(spark):
    priced = catalog(spark, SF).where(F.col("price").isNotNull() & (F.length("catalog_content") > 0))
    assert "BroadcastHashJoin" not in plan(priced)


def test_join_of_growing_sides_is_not_broadcast(spark):
    a, b = spark.range(10).select("id", (F.col("id") * 2).alias("x")), spark.range(5)
    assert "Broadcast" not in plan(join_rows(a, b, "id"))
    assert sorted(r["x"] for r in join_rows(a, b, "id").collect()) == [0, 2, 4, 6, 8]
    assert join_rows(a, b, "id", "left_anti").count() == 5


def test_contract_report_is_not_broadcast(spark):
    rows = spark.createDataFrame([(1, 2.0, 0), (2, 3.0, 1)], "sample_id long, price double, at long")
    report = contract_report(rows, rows, position="at")
    text = report._jdf.queryExecution().optimizedPlan().toString()
    assert "leftHint=(strategy=broadcast)" not in text and text.count("strategy=merge") >= 3
    assert report.first()["n_missing_keys"] == 0


@pytest.mark.parametrize("name", ["group_stats_unit", "group_stats_brand", "group_stats_pack", "prediction_summary", "features_a_train", "shape_report", "contract_order"])
def test_texts_are_extracted_once(spark, monkeypatch, name):
    seen = counted(spark, monkeypatch)
    Q.QUERIES[name](spark, SF).collect()
    assert seen.value == catalog(spark, SF, with_price=False).count()


def test_prediction_summary_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def passed(x):
        seen.add(1)
        return x

    df = spark.range(100).select(passed.asNondeterministic()(F.col("id").cast("double")).alias("price"))
    r = prediction_summary(df).first()
    assert (r["n"], r["min_price"], r["max_price"], r["median_price"]) == (100, 0.0, 99.0, 49.5)
    assert seen.value == 100


def test_borders_of_many_features_without_sorting(spark):
    """More features than an aggregation can have groups without sorting: the borders
    are those of each feature by itself."""
    n, width = 300, 230
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(n, width)), 1)
    x[:, 7], x[3, 5], x[:, 9] = 2.0, np.nan, np.nan
    df = spark.createDataFrame([(row.tolist(),) for row in x], "features array<double>")
    found = B.find_borders(df, "features", 8)
    assert len(found) == width
    for f in (0, 5, 7, 9, 113, 229):
        values = np.sort(x[~np.isnan(x[:, f]), f])
        want = np.unique([values[int(np.ceil(i / 8 * len(values))) - 1] for i in range(1, 8)]) if len(values) else np.zeros(0)
        assert np.array_equal(found[f], want[want < values[-1]] if len(values) else want)


@pytest.mark.parametrize("name", ["tfidf_dense", "tfidf_transform"])
def test_tfidf_texts_are_tokenized_once(spark, monkeypatch, name):
    """The fit and the transform read the same written tokens."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def passed(text):
        seen.add(1)
        return text

    rows = [(i, None if i == 7 else f"red apple tree {'caf\u00e9' if i % 2 else 'bread'} number{i % 3}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text", passed.asNondeterministic()("text"))
    monkeypatch.setattr(Q, "table", lambda spark, sf, table: docs)
    out = Q.QUERIES[name](spark, SF).collect()
    assert {r["doc_id"] for r in out} == set(range(20)) - ({7} if name == "tfidf_transform" else set())
    assert seen.value == 20
