"""Sources/sinks, image fetch, jobs and the streaming scorer (rows-level checks)."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fennec.operators import images as I
from fennec.operators.evaluation import assert_contract, contract_report, folder_not_empty
from fennec.operators.splits import holdout_flag
from fennec.plans.jobs import TrainConfig, fit_scoring_bundle, score_job, train_job, write_output
from fennec.sources.catalog import catalog
from fennec.sources.files import TEST_SCHEMA, read_predictions, read_products, write_predictions, write_products

SF = "/root/testdata/sf0.001"


def scratch():
    return tempfile.mkdtemp(prefix="fennec-test-")


def test_csv_roundtrip_multiline(spark):
    cat = catalog(spark, SF)
    d = scratch()
    write_products(cat, f"{d}/train")
    back = read_products(spark, f"{d}/train")
    assert back.count() == cat.count()
    a = {r.sample_id: r.catalog_content for r in cat.collect()}
    b = {r.sample_id: r.catalog_content for r in back.collect()}
    assert a == b  # newlines inside quoted fields survive; NULL stays NULL
    write_predictions(cat.select("sample_id", "price"), f"{d}/out")
    out = spark.read.option("header", True).schema("sample_id long, price double").csv(f"{d}/out")
    assert out.count() == cat.count()


def test_na_spellings_are_null(spark):
    d = scratch()
    with open(f"{d}/t.csv", "w") as fh:
        fh.write('sample_id,catalog_content,image_link\n1,"NA",n/a\n2,"Item Name: x\nValue: 2",http://a/b.jpg\n')
    df = read_products(spark, f"{d}/t.csv", TEST_SCHEMA).orderBy("sample_id").collect()
    assert df[0].catalog_content is None and df[0].image_link is None
    assert df[1].catalog_content == "Item Name: x\nValue: 2"


def test_contract_check_raises(spark):
    cat = catalog(spark, SF, with_price=False)
    bad = cat.limit(5).select("sample_id", F.lit(None).cast("double").alias("price"))
    with pytest.raises(AssertionError):
        assert_contract(contract_report(cat, bad))


TRICKY = ['plain', 'two\nlines', 'a, "quoted" word', 'CR\r\nLF', '""', '\n\nblank lines\n', ' edges ', 'x' * 3000 + '\n' + 'y' * 3000,
          'only "', '\n"\n"\n', 'tab\tand é ü 漢字', None, ',,,', 'sample_id,catalog_content,image_link']


def csv_text(rows, end):
    def cell(v):
        return "" if v is None else '"' + v.replace('"', '""') + '"' if any(c in v for c in '",\n\r') else v
    return end.join(["sample_id,catalog_content,image_link"] + [f"{i},{cell(t)},http://a/{i}.jpg" for i, t in rows])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", [200, 1 << 20])
def test_one_file_read_by_ranges(spark, end, split):
    rows = [(i, TRICKY[i * 7 % len(TRICKY)]) for i in range(60)]
    d = scratch()
    for name, part in (("b.csv", rows[40:]), ("a.csv", rows[:40])):
        with open(f"{d}/{name}", "w", newline="", encoding="utf-8") as fh:
            fh.write(csv_text(part, end) + (end if name == "a.csv" else ""))
    # ranges of `split` bytes: far smaller than a record in the first case
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        assert spark.read.option("lineSep", "\n").text(d).rdd.getNumPartitions() > (1 if split > 5000 else 20)
        got = read_products(spark, d, TEST_SCHEMA, "row_pos", splittable=True).collect()
        whole = read_products(spark, d, TEST_SCHEMA, "row_pos").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [(r.sample_id, r.row_pos) for r in sorted(got, key=lambda r: r.row_pos)] == [(i, i) for i in range(60)]
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole), key=lambda r: r[0])
    assert {r.sample_id: r.catalog_content for r in got} == dict(rows)


def test_ranges_check_the_header(spark):
    d = scratch()
    with open(f"{d}/a.csv", "w") as fh:
        fh.write("sample_id,catalog,image_link\n1,x,y\n")
    with pytest.raises(ValueError, match="header"):
        read_products(spark, d, TEST_SCHEMA, splittable=True)


def test_output_in_the_order_of_the_input(spark):
    keys = [(k * 37 % 101, k) for k in range(101)] + [(500, 101), (None, 102)]
    inputs = spark.createDataFrame(keys, "sample_id long, row_pos long").repartition(5)
    for order, wrong in (("row_pos", 0), ("sample_id", None)):
        for single in (False, True):
            path = f"{scratch()}/out"
            write_predictions(inputs.withColumn("price", F.lit(1.0)), path, single, order)
            report = contract_report(inputs, read_predictions(spark, path), position="row_pos")
            assert (report.first().n_out_of_order == 0) == (wrong == 0)
    good = inputs.where("sample_id is not null").withColumn("price", F.lit(1.0))
    swapped = good.withColumn("row_pos", F.when(F.col("row_pos") == 3, 4).when(F.col("row_pos") == 4, 3).otherwise(F.col("row_pos")))
    assert_contract(contract_report(good, good, position="row_pos"))
    with pytest.raises(AssertionError, match="2 rows are not in the order"):
        assert_contract(contract_report(good, swapped, position="row_pos"))
    short = good.where("row_pos <> 7")
    assert contract_report(good, short, position="row_pos").first().n_out_of_order == 1


def test_jobs_write_in_the_order_of_the_input(spark):
    test = spark.createDataFrame([(k * 37 % 101, k) for k in range(101)], "sample_id long, row_pos long")
    out = test.select("sample_id", F.lit(2.0).alias("price")).orderBy("sample_id")
    path = f"{scratch()}/out"
    write_output(out, test, path, "sample_id", "row_pos")
    assert {r.row_pos: r.sample_id for r in read_predictions(spark, path).collect()} == {k: k * 37 % 101 for k in range(101)}
    write_output(out, test.drop("row_pos"), path, "sample_id", "row_pos")  # without places: any order
    assert spark.read.option("header", True).csv(path).count() == 101


def test_image_manifest_and_fetch(spark):
    src = scratch()
    for i in range(3):
        with open(f"{src}/img{i}.jpg", "w") as fh:
            fh.write("x" * (i + 1))
    links = spark.createDataFrame([(f"file://{src}/img{i}.jpg",) for i in range(3)] + [(None,), (f"file://{src}/missing.jpg",)], "image_link string")
    dest = f"{scratch()}/images"
    todo = I.to_fetch(links, existing=I.existing_files(spark, dest))
    assert todo.count() == 4
    status = {r.filename: r.status for r in I.fetch(todo, dest, partitions=2).collect()}
    assert status["missing.jpg"] == "failed" and status["img0.jpg"] == "ok"
    assert folder_not_empty(spark, dest)
    again = I.to_fetch(links, existing=I.existing_files(spark, dest))
    assert {r.filename for r in again.collect()} == {"missing.jpg"}


@pytest.fixture(scope="module")
def split(spark):
    cat = catalog(spark, SF)
    h = holdout_flag(F.col("sample_id"), 0.25, seed=7)
    return cat.where(~h), cat.where(h)


def test_train_job(spark, split):
    train, test = split
    rep = train_job(spark, train, test.drop("price"), f"{scratch()}/out", TrainConfig(max_iter=4, patience=2, member_overrides={"maxDepth": 3, "stepSize": 0.3}))
    assert rep["predictions"].count() == test.count()
    assert rep["summary"]["min_price"] >= 0.01
    assert len(rep["weights"]) == 3 and abs(sum(rep["weights"]) - 1) < 1e-9


def test_score_job_and_stream(spark, split):
    train, test = split
    d = scratch()
    fit_scoring_bundle(spark, train, f"{d}/models", max_iter=3, overrides={"maxDepth": 3})
    r = score_job(spark, f"{d}/models", test, f"{d}/pred")
    assert r["predictions"].count() == test.count()
    assert r["metrics"].first().smape >= 0

    from fennec.streaming.scoring import score_stream

    src = f"{d}/incoming"
    test.drop("price").repartition(2).write.parquet(src)
    q = score_stream(spark, f"{d}/models", src, f"{d}/stream_out", f"{d}/ckpt")
    q.awaitTermination(300)
    out = spark.read.parquet(f"{d}/stream_out")
    assert out.select("sample_id").distinct().count() == test.count()
    assert os.path.isdir(f"{d}/ckpt")


def test_extractor_state_round_trip(spark, split):
    from fennec.plans.features_b import ProductFeatureExtractor
    from fennec.sources.state import load_extractor, save_extractor

    train, test = split
    ex = ProductFeatureExtractor()
    ex.fit_transform(train)
    d = scratch()
    save_extractor(ex, f"{d}/state")
    back = load_extractor(spark, f"{d}/state")
    names = ex.get_feature_names()
    assert back.get_feature_names() == names
    a = sorted(map(tuple, ex.transform(test).select("sample_id", *names).collect()))
    b = sorted(map(tuple, back.transform(test).select("sample_id", *names).collect()))
    assert a == b
    with pytest.raises(ValueError):
        ProductFeatureExtractor().transform(test)


def test_fit_transform_keeps_input_columns(spark, split):
    from fennec.plans.features_b import ProductFeatureExtractor

    train, test = split
    ex = ProductFeatureExtractor()
    a = ex.fit_transform(train)
    b = ex.transform(test)
    for c in ("sample_id", "catalog_content", "image_link"):
        assert c in a.columns and c in b.columns
    assert set(ex.get_feature_names()) <= set(a.columns) & set(b.columns)
