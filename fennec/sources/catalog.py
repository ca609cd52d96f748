"""The ``catalog`` view: product records with labelled catalog text, derived
deterministically from ``part`` and ``lineitem`` so that Spark and the SQL
oracle see identical input.

* ``sample_id``       = ``p_partkey``
* ``catalog_content`` = ``Item Name: <article><brand> <name><pack>\\n<bullets>
  <value line>Unit: <unit>\\n``, whose parts vary with ``p_partkey`` (tables
  below) so that every extraction rule decides some rows: all pack spellings
  and none, a pack of 0, all unit words, leading articles, accents, bullet
  lines, numbers that are none.  NULL for the parts of size 1 (about 2% of
  the rows at every scale), to exercise the missing-text defaults (no row is
  dropped)
* ``image_link``      = a URL built from the key
* ``price``           = average unit price ``l_extendedprice / l_quantity`` of
  the part's line items (one partial-aggregated shuffle over ``lineitem``)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# parts of this size get NULL catalog text
NULL_TEXT_SIZE = 1
# variants by p_partkey modulo the list's length; {n} is p_size, {t} is p_type
ARTICLES = ["", "The ", "", "A ", "", "An ", "Café ", "", "Ñandú® "]
PACKS = [" (Pack of {n})", " {n}-Pack", " {n} ct", " (Pack of {n})", " {n} Count", " {n}-Count", " {n} Pack", " {n}pk", " (Pack of 0)",
         " pack of {n}", "", " 500 count", " (Pack of {n})"]
BULLETS = ["", "Bullet Point 1: Gluten Free\n", "Bullet Point 1: organic\nBullet Point 2: 3 sizes, premium!\n", "", ""]
VALUES = ["Value: {n}.5\n", "Value: {n}\n", "Value: {n}.5\n", "Value: 12.5.3\n", "Value: {n}.25\n", "Value: 0\n", "", "Value: .\n", "Value: {n}.5\n", "Value: 1,000\n"]
UNITS = ["{t}", "Fluid Ounce", "Ounce", "{t}", "Pound", "Count", "{t}", "Gram", "Kilogram", "Milliliter", "Liter", "{t}",
         " Some Very Long Unit Name Here", "", "lb", "{t}"]


def _chosen(variants: list[str]) -> Column:
    return F.get(F.array(*map(F.lit, variants)), (F.col("p_partkey") % len(variants)).cast("int"))


def _chosen_sql(variants: list[str]) -> str:
    items = ", ".join("'" + v.replace("'", "''") + "'" for v in variants)
    return f"[{items}][CAST(p.p_partkey % {len(variants)} AS INTEGER) + 1]"


def catalog(spark: SparkSession, sf_dir: str, with_price: bool = True) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    if with_price:
        li = table(spark, sf_dir, "lineitem")
        price = li.groupBy(F.col("l_partkey").alias("p_partkey")).agg(
            F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
        )
        # every part has line items; a left join keeps parts without any (price NULL).
        # The texts are made after it, by the tasks of the join.  Neither side is broadcast:
        # both grow with the input.  A price is one short row a part, so the hash table of a partition is small.
        # Rows come in the order of their keys, on which the last bits of sums over them depend
        part = part.join(price.hint("shuffle_hash"), "p_partkey", "left").sortWithinPartitions("p_partkey")
    text = F.concat(
        F.lit("Item Name: "), _chosen(ARTICLES), F.col("p_brand"), F.lit(" "), F.col("p_name"), _chosen(PACKS), F.lit("\n"),
        _chosen(BULLETS), _chosen(VALUES), F.lit("Unit: "), _chosen(UNITS), F.lit("\n"),
    )
    text = F.replace(F.replace(text, F.lit("{n}"), F.col("p_size").cast("string")), F.lit("{t}"), F.col("p_type"))
    return part.select(
        F.col("p_partkey").alias("sample_id"),
        F.when(F.col("p_size") != NULL_TEXT_SIZE, text).alias("catalog_content"),
        F.concat(F.lit("https://img.example.com/p/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("image_link"),
        *(["price"] if with_price else []),
    )


CATALOG_SQL = f"""
SELECT p.p_partkey AS sample_id,
       CASE WHEN p.p_size <> {NULL_TEXT_SIZE} THEN
         replace(replace('Item Name: ' || {_chosen_sql(ARTICLES)} || p.p_brand || ' ' || p.p_name || {_chosen_sql(PACKS)} || chr(10) ||
         {_chosen_sql(BULLETS)} || {_chosen_sql(VALUES)} || 'Unit: ' || {_chosen_sql(UNITS)} || chr(10),
         '{{n}}', CAST(p.p_size AS VARCHAR)), '{{t}}', p.p_type)
       END AS catalog_content,
       'https://img.example.com/p/' || CAST(p.p_partkey AS VARCHAR) || '.jpg' AS image_link,
       lp.price
FROM part p
LEFT JOIN (SELECT l_partkey, avg(l_extendedprice / l_quantity) AS price FROM lineitem GROUP BY l_partkey) lp
  ON lp.l_partkey = p.p_partkey
"""
