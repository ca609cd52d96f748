"""Properties of the operators (folds, encodings, TF-IDF, metrics, clamp)."""

import math

from pyspark.sql import functions as F

from fennec.functions.metrics import smape
from fennec.operators import ensemble as E
from fennec.operators.splits import hash_fold, holdout_flag
from fennec.operators.stats import fill_with_frame_median
from fennec.operators.target_encoding import KFoldTargetEncoder
from fennec.operators.tfidf import TfidfVectorizer
from fennec.plans import features_a as FA
from fennec.sources.catalog import catalog
from fennec.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_folds_partition_rows(spark):
    part = table(spark, SF, "part")
    f = part.select(hash_fold(F.col("p_partkey")).alias("fold"))
    counts = {r.fold: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(counts) == {0, 1, 2, 3, 4}
    assert sum(counts.values()) == part.count()
    h = part.where(holdout_flag(F.col("p_partkey"))).count()
    assert 0 < h < part.count()


def test_oof_stats_ignore_own_target(spark):
    f = FA.extract(catalog(spark, SF))
    base, _ = KFoldTargetEncoder().fit_transform(f)
    # change one row's price: its own encodings must stay the same
    sid = base.orderBy("sample_id").first().sample_id
    changed = f.withColumn("price", F.when(F.col("sample_id") == sid, F.col("price") * 1000).otherwise(F.col("price")))
    after, _ = KFoldTargetEncoder().fit_transform(changed)
    cols = ["unit_mean_price", "unit_median_price", "brand_mean_price", "pack_qty_count"]
    a = base.where(F.col("sample_id") == sid).select(*cols).first()
    b = after.where(F.col("sample_id") == sid).select(*cols).first()
    assert a == b


def test_smoothed_mean_between_group_and_global(spark):
    f = FA.extract(catalog(spark, SF))
    model = KFoldTargetEncoder().fit(f)
    st = model.stats.where("col = 'unit'").collect()
    g = model.scalars.first().global_mean
    for r in st:
        sm = (r["mean"] * r["cnt"] + g * 10) / (r["cnt"] + 10)
        assert min(r["mean"], g) - 1e-9 <= sm <= max(r["mean"], g) + 1e-9


def test_unseen_category_defaults(spark):
    f = FA.extract(catalog(spark, SF))
    model = KFoldTargetEncoder().fit(f)
    probe = spark.createDataFrame([(1, "no-such-unit", "no-such-brand", 12345)], "sample_id long, unit string, brand string, pack_qty int")
    r = model.transform(probe).first()
    g = model.scalars.first()
    assert math.isclose(r.unit_mean_price, g.global_mean)
    assert math.isclose(r.brand_median_price, g.global_median)
    assert r.pack_qty_std_price == 0.0 and r.unit_count == 0


def test_tfidf_rows_are_unit_norm(spark):
    docs = table(spark, SF, "documents")
    m = TfidfVectorizer().fit(docs, "doc_id", "text")
    norms = m.transform_long(docs, "doc_id", "text").groupBy("doc_id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("n"))
    assert all(abs(r.n - 1.0) < 1e-9 for r in norms.collect())
    assert m.size() <= 150


def test_tfidf_dense_matches_long(spark):
    docs = table(spark, SF, "documents")
    m = TfidfVectorizer(max_features=20).fit(docs, "doc_id", "text")
    dense = m.transform_dense(docs, "doc_id", "text", "v").select("doc_id", "v")
    long = {(r.doc_id, r.idx): r.weight for r in m.transform_long(docs, "doc_id", "text").collect()}
    for r in dense.collect():
        for i, w in enumerate(r.v):
            assert abs(w - long.get((r.doc_id, i), 0.0)) < 1e-12


def test_smape_symmetric_and_bounded(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 0.0), (5.0, 0.0), (3.0, 3.0)], "a double, p double")
    s1 = df.agg(smape(F.col("a"), F.col("p"))).first()[0]
    s2 = df.agg(smape(F.col("p"), F.col("a"))).first()[0]
    assert math.isclose(s1, s2) and 0 <= s1 <= 200
    un = df.agg(smape(F.col("a"), F.col("p"), guarded=False)).first()[0]
    assert un > s1  # the 0/0 row is skipped instead of counted as 0


def test_clamp_and_weight_grid(spark):
    df = spark.createDataFrame([(-3.0,), (None,), (2.5,)], "p double")
    got = [r[0] for r in df.select(E.clamp(F.col("p"))).collect()]
    assert got == [0.01, 0.01, 2.5]
    assert len(E.WeightGrid().points()) == 636


def test_ridge_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 3)) * [1, 2, 3] + 10
    y = X @ [0.5, -1.0, 2.0] + rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(t)) for (a, b, c), t in zip(X, y)], "p1 double, p2 double, p3 double, y double")
    c = E.ridge_coefficients(df, "y", ("p1", "p2", "p3"), alpha=1.0).first()
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + np.eye(3), Xc.T @ yc)
    assert np.allclose([c.c1, c.c2, c.c3], w, atol=1e-8)
    assert math.isclose(c.intercept, y.mean() - X.mean(0) @ w, abs_tol=1e-8)


def test_frame_median_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (10.0,)], "x double")
    got = sorted(r.x for r in fill_with_frame_median(df, ["x"]).collect())
    assert got == [1.0, 3.0, 3.0, 10.0]


def test_transform_deterministic(spark):
    cat = catalog(spark, SF)
    feats, model = FA.AdvancedFeatures().fit_transform(cat)
    a = sorted(map(tuple, model.transform(cat.drop("price")).select("sample_id", "unit_mean_price").collect()))
    b = sorted(map(tuple, model.transform(cat.drop("price")).select("sample_id", "unit_mean_price").collect()))
    assert a == b
    # out-of-fold (train) and lookup (transform) encodings differ on the same rows
    c = sorted(map(tuple, feats.select("sample_id", "unit_mean_price").collect()))
    assert a != c


def test_align_columns_adds_zero_columns(spark):
    from fennec.operators.assemble import align_columns, by_prefix

    df = spark.createDataFrame([(1, 2.0, 1)], "sample_id long, a double, has_x int")
    out = align_columns(df, ["a", "missing", "has_x"], keep=["sample_id"])
    assert out.columns == ["sample_id", "a", "missing", "has_x"]
    assert out.first().missing == 0
    assert by_prefix(df, ("has_",)) == ["has_x"]


def test_tfidf_pruning_is_exact(spark, monkeypatch):
    from fennec.operators import tfidf as T

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    for params in (dict(max_features=30), dict(max_features=40, ngram_range=(1, 2), min_df=5, max_df=1.0, strip_accents=False, sublinear_tf=False)):
        v = T.TfidfVectorizer(**params)
        assert v._pruned_stats(docs.select(F.col("doc_id").alias("_id"), v.tokens(F.col("text")).alias("_toks")),
                               docs.agg(F.count(F.lit(1)).cast("double")).scalar()) is not None  # pruning engages
        pruned = sorted(map(tuple, v.fit(docs, "doc_id", "text").vocab.collect()))
        with monkeypatch.context() as m:
            m.setattr(T.TfidfVectorizer, "_pruned_stats", lambda self, toks, n: None)
            full = sorted(map(tuple, v.fit(docs, "doc_id", "text").vocab.collect()))
        assert pruned == full


def test_tfidf_pruning_with_frequent_tokens_that_are_not_eligible(spark, monkeypatch):
    """The most frequent tokens occur in one document alone (and tie), so that
    more of them must be tried until enough are eligible; letters outside the
    basic plane stay whole."""
    from fennec.operators import tfidf as T

    rare = " ".join(f"rare{i}" for i in range(60))
    texts = [" ".join([rare] * 9)] + [f"\U00010330\U00010331 \U00010332\U00010333 walks home{i % 4} by road{i % 5}" for i in range(8)] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    v = T.TfidfVectorizer(max_features=12, ngram_range=(1, 3), min_df=3, max_df=1.0, strip_accents=False)
    n = docs.agg(F.count(F.lit(1)).cast("double")).scalar()
    assert v._pruned_stats(v.token_frame(docs, "doc_id", "text"), n) is not None
    pruned = v.fit(docs, "doc_id", "text")
    with monkeypatch.context() as m:
        m.setattr(T.TfidfVectorizer, "_pruned_stats", lambda self, toks, n: None)
        full = v.fit(docs, "doc_id", "text")
    assert sorted(map(tuple, pruned.vocab.collect())) == sorted(map(tuple, full.vocab.collect()))
    assert "\U00010330\U00010331 \U00010332\U00010333 walks" in {r["term"] for r in pruned.vocab.collect()}
    written = v.written_tokens(docs, "doc_id", "text")
    assert sorted(map(tuple, v.fit(written, "doc_id", "text").vocab.collect())) == sorted(map(tuple, full.vocab.collect()))
    a, b = (sorted(map(tuple, full.transform_long(d, "doc_id", "text").collect())) for d in (docs, written))
    assert a == b and len(a) > 8


def test_marked_ngrams_are_the_ngrams_of_kept_tokens(spark):
    from fennec.functions.text import marked_ngrams, marked_tokens, ngrams

    rows = [([],), (["a1"],), (["a1", "b1", "c1", "a1", "b1"],), (["x1", "a1", "x1", "b1", "c1", "x1"],), (["\U00010330\U00010331", "a1", "x1", "c1", "b1", "a1"],)]
    keep = ["a1", "b1", "c1", "\U00010330\U00010331"]
    df = spark.createDataFrame(rows, "t array<string>").select("t", marked_tokens(F.col("t"), keep).alias("m"))
    for r in df.select("t", *[c for n in (1, 2, 3) for c in (marked_ngrams(F.col("m"), n).alias(f"m{n}"), ngrams(F.col("t"), n).alias(f"n{n}"))]).collect():
        for n in (1, 2, 3):
            assert r[f"m{n}"] == [g for g in r[f"n{n}"] if set(g.split(" ")) <= set(keep)]


def test_weight_grid_skips_null_terms(spark):
    df = spark.createDataFrame([(10.0, 9.0, 11.0, 10.0), (5.0, None, 5.0, 5.0), (8.0, 8.0, 8.0, 8.0)], "a double, p1 double, p2 double, p3 double")
    got = {(r.w1, r.w2): r.smape for r in E.weight_scores(df, "a", "p1", "p2", "p3").collect()}
    ref = {}
    for r in df.collect():
        for (w1, w2, w3) in E.WeightGrid().points():
            if r.p1 is None:
                continue
            p = (w1 * r.p1 + w2 * r.p2 + w3 * r.p3) / 100.0
            d = (abs(r.a) + abs(p)) / 2
            ref.setdefault((w1, w2), []).append(0.0 if d == 0 else abs(r.a - p) / d)
    for k, terms in ref.items():
        assert math.isclose(got[k], 100 * sum(terms) / len(terms), rel_tol=1e-9, abs_tol=1e-9)


def test_accent_folding_matches_nfkd_rule(spark):
    import unicodedata

    from fennec.functions.text import fold_accents, fold_text_frame

    texts = ["café ½ ĳssel ǅemal ﬁne", "Ölçü Ñandú", "ｆｕｌｌ", "㎏ ℃", "plain", "", "a￿b"]

    def rule(t):
        return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    one = [r[0] for r in df.orderBy("i").select(fold_accents(F.col("t"))).collect()]
    staged = [r["_t"] for r in fold_text_frame(df.orderBy("i"), F.col("t"), [F.col("i")], lowercase=False).orderBy("i").collect()]
    assert one == staged == [rule(t) for t in texts]


def test_accent_folding_of_every_code_point(spark):
    import unicodedata

    from fennec.functions.text import fold_accents

    def rule(t):
        return "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    # eight code points a row, each between letters; and words of several syllables
    assigned = [chr(c) for c in range(1, 0x110000) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    texts = ["x" + "x".join(assigned[i:i + 8]) for i in range(0, len(assigned), 8)] + ["한글 테스트 각", "𝐀𝐁 ﬃ 한½", "𝕏é한"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8).select("t", fold_accents(F.col("t")).alias("f")).collect()
    wrong = [(r.t, r.f, rule(r.t)) for r in got if r.f != rule(r.t)]
    assert len(assigned) > 140_000 and not wrong, wrong[:5]


def test_numeric_missing_spellings_are_null(spark, tmp_path):
    from fennec.sources.files import read_products

    path = tmp_path / "in.csv"
    cells = ["NA", "None", "NaN", "nan", "", "n/a", " 12.5 ", "7"]
    path.write_text("sample_id,catalog_content,image_link,price\n" + "".join(f'{i},"a\nb",u,{c}\n' for i, c in enumerate(cells)))
    rows = read_products(spark, str(path)).orderBy("sample_id").collect()
    assert [r.price for r in rows] == [None] * 6 + [12.5, 7.0] and rows[0].catalog_content == "a\nb"
    bad = tmp_path / "bad.csv"
    bad.write_text("sample_id,catalog_content,image_link,price\n1,a,u,cheap\n")
    try:
        read_products(spark, str(bad))
        raise AssertionError("a price that is no number must fail")
    except Exception as ex:
        assert "cheap" in str(ex)


def test_label_codes_for_any_partitioning(spark):
    from fennec.operators.label_encoder import dense_index

    values = [f"v{i * 7919 % 1000:04d}" for i in range(3000)] + [None]
    df = spark.createDataFrame([(v,) for v in values], "c string")
    want = {v: i for i, v in enumerate(sorted({v for v in values if v}))}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "8", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert {r.c: r.code for r in dense_index(df, "c").collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_ridge_keeps_its_digits_far_from_zero(spark):
    import numpy as np

    from fennec.operators.ensemble import ridge_coefficients

    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = x @ [0.5, -1.0, 2.0] + rng.normal(size=2000) * 0.1
    shift = 1e7
    df = spark.createDataFrame([(float(a + shift), float(b + shift), float(c + shift), float(t + shift)) for (a, b, c), t in zip(x, y)],
                               "p1 double, p2 double, p3 double, y double")
    got = ridge_coefficients(df, "y", ("p1", "p2", "p3")).first()
    xc = x - x.mean(axis=0)
    want = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ (y - y.mean()))
    assert np.allclose([got.c1, got.c2, got.c3], want, atol=1e-6)
