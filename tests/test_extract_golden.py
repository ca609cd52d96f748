"""Golden rows for the extractors."""

import math

from pyspark.sql import functions as F

from fennec.functions import extract as X
from fennec.functions import measures as M

ROWS = [
    "Item Name: The Acme® Café Organic Tea, 6-Pack (Pack of 12)\nBullet Point 1: Gluten Free\nBullet Point 2: fresh\nValue: 12.5\nUnit: Fluid Ounce\n",
    None,
    "",
    "Value: 12.5.3\nUnit: Kilogram\nItem Name: an  Örgänic-Mix  24 ct",
    "Item Name: ®™ deluxe\nUnit:\nValue: 3\n",
    "Value: .\nUnit:  Count \nItem Name:   ",
    "Item Name: 500-Count Swabs 30pk\nValue: 500.0\nUnit: Count",
    "Pack of 99999999999999999999",
    "Item Name: A\nValue: 0\nUnit: Some Very Long Unit Name Here",
    "item name: lower\nvalue: 4\nunit: Ounce",
    "Item Name: Pack of 0 snack_bar\nValue: 8\nUnit: Milliliter",
    "Item Name: Zoë's 8 Count Bar\nValue: 1,000\nUnit: ",
    "Item Name: O'Neil 5 Packs 6 Count\nUnit: lb",
]
N = None
# value, unit raw, unit, item name, pack, pack simple, brand raw, brand,
# cat len, name len, words, uniq, bullets, special, digits, upper
EXPECTED = [
    (12.5, "Fluid Ounce", "fl_oz", "The Acme® Café Organic Tea, 6-Pack (Pack of 12)", 12, 12, "The", "acme", 139, 47, 9, 9, 2, 5, 3, 7),
    (N, "Unknown", "unknown", "", 1, 1, "Unknown", "unknown", 0, 0, 0, 0, 0, 0, 0, 0),
    (N, "Unknown", "unknown", "", 1, 1, "Unknown", "unknown", 0, 0, 0, 0, 0, 0, 0, 0),
    (N, "Kilogram", "g", "an  Örgänic-Mix  24 ct", 24, 1, "an", "rgnicmix", 62, 22, 4, 4, 0, 1, 2, 2),
    (3.0, "Value: 3", "value: 3", "®™ deluxe", 1, 1, "Unknown", "unknown", 36, 9, 2, 2, 0, 2, 0, 0),
    (N, "Count", "count", "", 1, 1, "Unknown", "unknown", 36, 0, 0, 0, 0, 0, 0, 0),
    (500.0, "Count", "count", "500-Count Swabs 30pk", 100, 1, "500Count", "500count", 56, 20, 3, 3, 0, 1, 5, 2),
    (N, "Unknown", "unknown", "", 100, 99999999999999999999, "Unknown", "unknown", 28, 0, 0, 0, 0, 0, 0, 0),
    (0.0, "Some Very Long Unit Name Here", "some very long unit ", "A", 1, 1, "A", "a", 57, 1, 1, 1, 0, 0, 0, 1),
    (N, "Unknown", "unknown", "", 1, 1, "Unknown", "unknown", 37, 0, 0, 0, 0, 0, 0, 0),
    (8.0, "Milliliter", "ml", "Pack of 0 snack_bar", 0, 0, "Pack", "pack", 56, 19, 4, 4, 0, 1, 1, 1),
    (1.0, "Unknown", "", "Zoë's 8 Count Bar", 8, 1, "Zoës", "zos", 48, 17, 4, 4, 0, 1, 1, 3),
    (N, "lb", "lb", "O'Neil 5 Packs 6 Count", 5, 1, "ONeil", "oneil", 42, 22, 5, 5, 0, 1, 2, 4),
]


def test_golden_rows(spark):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(ROWS)], "id int, c string")
    c = F.col("c")
    name = X.item_name(c)
    out = (
        df.select("id", c, name.alias("name"))
        .select(
            "id",
            X.value(c).alias("value"),
            X.unit_raw(c).alias("unit_raw"),
            X.unit_normalized(c).alias("unit"),
            F.col("name"),
            X.pack_quantity(c, "A").alias("pack"),
            X.pack_quantity(c, "B").alias("pack_simple"),
            X.brand_raw(F.col("name")).alias("brand_raw"),
            X.brand_normalized(F.col("name")).alias("brand"),
            M.char_length(c).alias("cat_len"),
            M.char_length(F.col("name")).alias("name_len"),
            M.word_count(F.col("name")).alias("words"),
            M.unique_words(F.col("name")).alias("uniq"),
            M.bullet_points(c).alias("bullets"),
            M.special_chars(F.col("name")).alias("special"),
            M.digit_count(F.col("name")).alias("digits"),
            M.uppercase_count(F.col("name")).alias("upper"),
        )
        .orderBy("id")
        .collect()
    )
    assert len(out) == len(EXPECTED)
    for row, exp in zip(out, EXPECTED):
        got = tuple(row)[1:]
        for j, (g, e) in enumerate(zip(got, exp)):
            if isinstance(e, float) or isinstance(g, float):
                if e is None:
                    assert g is None, (row.id, j, g, e)
                else:
                    assert math.isclose(g, e, rel_tol=1e-12), (row.id, j, g, e)
            else:
                assert g == e, (row.id, j, g, e)


def test_strict_value_fails_on_bad_number(spark):
    import pytest
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    df = spark.createDataFrame([("Value: 12.5.3",)], "c string")
    assert df.select(X.value(F.col("c"))).first()[0] is None
    with pytest.raises((PySparkException, Py4JJavaError)):
        df.select(X.value(F.col("c"), strict=True)).collect()
