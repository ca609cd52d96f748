"""The refinement quantiles equal Spark's exact percentile, whatever path runs."""

import random

import pytest
from pyspark.sql import functions as F

from fennec.operators.quantiles import column_quantiles, complement_medians, exact_quantiles

PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = [("hot", rnd.random() * 1000) for _ in range(20000)]  # one group holding most rows
    rows += [("dup", 5.0)] * 3000  # one value repeated
    rows += [(f"g{i % 200}", float(rnd.randint(0, 40))) for i in range(8000)]
    rows += [("empty", None)] * 5 + [("one", 3.0), ("two", 1.0), ("two", 2.0)]
    return spark.createDataFrame(rows, "k string, v double")


@pytest.mark.parametrize("small,bins", [(50_000, 4096), (100, 64), (3, 8)])
def test_grouped_matches_percentile(skewed, small, bins):
    got = {r.k: r.q for r in exact_quantiles(skewed, "v", PROBS, ["k"], bins=bins, small=small).collect()}
    ref = {r.k: r.q for r in skewed.groupBy("k").agg(F.percentile("v", PROBS).alias("q")).collect() if r.q is not None}
    assert set(got) == set(ref)
    for k in ref:
        assert got[k] == pytest.approx(ref[k], rel=1e-12, abs=1e-12), k


def test_global_and_columns(skewed, spark):
    ref = skewed.agg(F.percentile("v", PROBS)).first()[0]
    assert exact_quantiles(skewed, "v", PROBS, small=10, bins=16).first().q == pytest.approx(ref, rel=1e-12)
    two = skewed.withColumn("w", F.col("v") * 2)
    q = column_quantiles(two, ["v", "w"], [0.5])
    assert q["w"][0] == pytest.approx(2 * q["v"][0])


def test_encoder_refined_equals_one_pass(spark, monkeypatch):
    from fennec.operators import quantiles as Q
    from fennec.operators.target_encoding import KFoldTargetEncoder
    from fennec.plans import features_a as FA
    from fennec.sources.catalog import catalog

    f = FA.extract(catalog(spark, "/root/testdata/sf0.001"))
    cols = ["sample_id", "unit_median_price", "brand_median_price", "pack_qty_median_price", "unit_mean_price", "brand_std_price"]
    one_pass, _ = KFoldTargetEncoder(quantiles="aggregate").fit_transform(f)
    monkeypatch.setattr(Q, "DEFAULT_SMALL", 3)  # every group above 3 values goes through refinement
    monkeypatch.setattr(Q, "DEFAULT_BINS", 4)
    refined, model = KFoldTargetEncoder().fit_transform(f)
    a = sorted(map(tuple, one_pass.select(*cols).collect()))
    b = sorted(map(tuple, refined.select(*cols).collect()))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x == pytest.approx(y, rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("bins", [4, 64, 4096])
def test_infinities_and_wide_ranges(spark, bins):
    inf = float("inf")
    values = [10.0 ** k for k in range(-300, 300, 7)] + [-(10.0 ** k) for k in range(-300, 300, 11)] + [0.0] * 9
    values += [5e-324, -5e-324, 1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.7e308, -1.7e308]
    for name, extra in (("plus", [inf] * 40), ("minus", [-inf] * 40), ("both", [inf, -inf]), ("none", [])):
        rows = [(name, v) for v in values + extra]
        df = spark.createDataFrame(rows, "k string, v double")
        n = len(rows)
        probs = [i / (n - 1) for i in (0, 1, n // 3, n // 2, n - 2, n - 1)]
        got = exact_quantiles(df, "v", probs, ["k"], small=2, bins=bins).first().q
        want = df.agg(F.percentile("v", probs)).first()[0]
        assert got == pytest.approx(want, rel=1e-12)


def test_values_are_not_shuffled_by_key(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
        df = exact_quantiles(li, "l_extendedprice", [0.5], ["l_returnflag"], small=1000, write_input=False)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        got = {r.l_returnflag: r.q[0] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "strategy=broadcast" in plan
    want = {r[0]: r[1] for r in li.groupBy("l_returnflag").agg(F.median("l_extendedprice")).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("small,bins", [(50_000, 4096), (100, 64), (3, 8)])
def test_complements_match_statistics_of_copied_rows(skewed, small, bins):
    from fennec.operators.target_encoding import complement_moments

    df = skewed.withColumn("f", F.when(F.col("k") == "one", 2).otherwise(F.pmod(F.xxhash64("v", F.monotonically_increasing_id()), F.lit(4)))).cache()
    copied = df.withColumn("h", F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(3)), F.col("f").cast("int"))))
    ref = {(r.k, r.h): r for r in copied.groupBy("k", "h").agg(
        F.median("v").alias("median"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.count("v").alias("cnt")).collect()}
    got = {(r.k, r.h): r["median"] for r in complement_medians(df, "v", "f", ["k"], 4, bins=bins, small=small).collect()}
    assert got == pytest.approx({x: r["median"] for x, r in ref.items() if r["median"] is not None}, rel=1e-12)
    assert ("one", 2) not in got and ("one", 0) in got
    moments = {(r.k, r.h): r for r in complement_moments(df, "v", "f", ["k"], 4).collect()}
    assert set(moments) == set(ref)
    for x, r in ref.items():
        assert moments[x].cnt == r.cnt
        for name in ("mean", "std"):
            assert moments[x][name] == (None if r[name] is None else pytest.approx(r[name], rel=1e-9, abs=1e-12)), (x, name)


@pytest.mark.parametrize("bins", [4, 4096])
def test_complements_of_infinities_and_wide_ranges(spark, bins):
    inf = float("inf")
    values = [s * 10.0 ** k for k in range(-300, 300, 9) for s in (1, -1)] + [0.0] * 9 + [inf] * 30 + [-inf] * 20 + [5e-324, 1.0 + 2**-52]
    df = spark.createDataFrame([("a", i * 7 % 3, v) for i, v in enumerate(values)], "k string, f int, v double")
    got = {r.h: r["median"] for r in complement_medians(df, "v", "f", ["k"], 3, bins=bins, small=2).collect()}
    want = {h: df.where(F.col("f") != h).agg(F.median("v")).first()[0] for h in range(3)}
    assert got == pytest.approx(want, rel=1e-12)


def test_out_of_fold_rows_are_not_copied(spark):
    from fennec.operators.target_encoding import KFoldTargetEncoder
    from fennec.operators import target_encoding as T

    seen = []
    old = T.fitted_table
    T.fitted_table = lambda df, name: seen.append(df) or old(df, name)
    try:
        rows = [(i, f"u{i % 3}", "b", i % 2, float(i % 97)) for i in range(2000)]
        KFoldTargetEncoder().oof_stats(spark.createDataFrame(rows, "sample_id int, unit string, brand string, pack_qty int, price double"))
    finally:
        T.fitted_table = old
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    # explodes stand above the aggregates only: each line of the scan side is a relation, a projection or a filter
    depth = [line for line in plan.splitlines() if "Generate" in line or "Aggregate" in line]
    assert any("Generate" in x for x in depth) and "Aggregate" in depth[-1]
