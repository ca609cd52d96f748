"""Sketches merge to those of the whole, and a stream's scores do not depend on its micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from fennec.operators.sketches import RANK_ERROR, column_sketches, merge_sketches, sketch_medians
from fennec.plans.jobs import fit_scoring_bundle
from fennec.session import scratch_path
from fennec.sources.catalog import catalog
from fennec.streaming.scoring import last_sketches, score_stream


def medians_of(parts, cols):
    merged = None
    for p in parts:
        s = column_sketches(p, cols)
        merged = s if merged is None else merge_sketches(merged.unionByName(s))
    return sketch_medians(merged)


def test_medians_within_the_rank_error_however_rows_are_parted(spark):
    n = 200_000
    df = spark.range(n).select("id", F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("a"), F.lit(None).cast("double").alias("none"),
                               F.when(F.col("id") % 3 == 0, F.lit(float("nan"))).when(F.col("id") % 3 == 1, 7.0).alias("seven"))
    values = sorted(r.a for r in df.select("a").collect())
    for parts in (1, 4):
        got = medians_of([df.where(F.pmod("id", F.lit(parts)) == i) for i in range(parts)], ["a", "none", "seven"])
        rank = sum(v <= got["a"] for v in values) / n
        assert abs(rank - 0.5) <= 2 * RANK_ERROR
        assert got["seven"] == 7.0 and "none" not in got


def test_few_values_are_exact(spark):
    rng = random.Random(1)
    values = [rng.random() for _ in range(1001)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    for parts in (1, 7):
        got = medians_of([df.where(F.col("id") % parts == i) for i in range(parts)], ["v"])
        assert got == {"v": sorted(values)[500]}
    assert sketch_medians(column_sketches(df.limit(0), ["v"])) == {}


@pytest.fixture(scope="module")
def bundle(spark):
    rows = catalog(spark, "/root/testdata/sf0.01")
    train, test = rows.where("sample_id % 3 > 0"), rows.where("sample_id % 3 = 0")
    d = scratch_path(spark, "stream-medians")
    fit_scoring_bundle(spark, train, f"{d}/models", max_iter=2, overrides={"maxDepth": 2})
    # ranges of texts, rows without a text first, so that the micro-batches differ
    test.select("sample_id", "catalog_content", "image_link").repartitionByRange(4, "catalog_content").write.parquet(f"{d}/incoming")
    return d


def scores(spark, d, name, **kw):
    score_stream(spark, f"{d}/models", f"{d}/incoming", f"{d}/{name}", f"{d}/{name}-checkpoint", **kw).awaitTermination()
    out = spark.read.parquet(f"{d}/{name}").collect()
    return {r.sample_id: r.price for r in out}, len({r.batch_id for r in out})


def test_scores_do_not_depend_on_the_micro_batches(spark, bundle):
    whole, one = scores(spark, bundle, "whole")
    split, many = scores(spark, bundle, "split", max_files_per_trigger=1)
    assert one == 1 and many > 1 and len(whole) == spark.read.parquet(f"{bundle}/incoming").count()
    assert split == pytest.approx(whole, rel=1e-12)
    # the state of the last batch holds the sketches of all rows
    n = F.kll_sketch_get_n_double("sketch")
    rows = [{r["name"]: r.n for r in last_sketches(spark, f"{bundle}/{x}-checkpoint/median_sketches").select("name", n.alias("n")).collect()}
            for x in ("whole", "split")]
    assert rows[0] == rows[1] and rows[0]["value"] > 0
