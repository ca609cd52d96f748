"""Product files (S1-S4) and written tables.

CSV product files carry multi-line text.  With ``multiLine`` a file is one task;
``splittable=True`` finds the records by quote parity over ranges of any size
(``csv_records``), so that one large file is read by many tasks.  Either way the
file is read once and landed as parquet.  The missing value spellings a pandas
reader treats as NaN are mapped to NULL explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

TRAIN_SCHEMA = "sample_id BIGINT, catalog_content STRING, image_link STRING, price DOUBLE"
TEST_SCHEMA = "sample_id BIGINT, catalog_content STRING, image_link STRING"
PREDICTION_SCHEMA = "sample_id BIGINT, price DOUBLE"

# The default missing-value spellings of the pandas CSV reader.
NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


CSV_OPTIONS = {"multiLine": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}


def read_products(spark: SparkSession, path: str, schema: str = TRAIN_SCHEMA, position: str | None = None,
                  splittable: bool = False) -> DataFrame:
    """Header CSV with quoted multi-line text; names are checked
    against the schema (``enforceSchema=False``).

    Every column is read as text first: missing-value spellings (``NA``,
    ``None``, ``NaN`` ..) become NULL in numeric columns as in text ones, and
    anything else that is no number fails.  The file is landed as parquet, so
    later passes don't parse it again.

    ``position`` names a column for each row's place in the input, from 0 (files
    in order of their names).  ``splittable`` reads one file by many tasks; it
    asks for quotes as the CSV standard has them (a field with a quote in it is
    quoted, and the quote doubled) and lines that end in LF or CRLF."""
    types = T.StructType.fromDDL(schema)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in types.fields])
    if splittable:
        raw = _parsed_records(csv_records(spark, path), texts)
    else:
        raw = spark.read.schema(texts).options(header=True, enforceSchema=False, **CSV_OPTIONS).csv(path).select("*", *_place("_metadata"))

    def value(f: T.StructField):
        if isinstance(f.dataType, T.StringType):
            return F.when(~F.col(f.name).isin(NA_VALUES), F.col(f.name))
        return F.when(~F.trim(F.col(f.name)).isin(NA_VALUES), F.trim(F.col(f.name))).cast(f.dataType)

    values = [value(f).alias(f.name) for f in types.fields]
    if position is None:
        return materialize(raw.select(*values), "products")
    return _numbered(raw.select(*values, *PLACE), position)


#: What orders rows as they lie in files: folder, number of the part, file, byte range, row.
PLACE = ("_folder", "_part", "_file", "_block", "_row")


def _place(meta: str) -> list:
    file = F.col(f"{meta}.file_path")
    part = F.regexp_extract(file, r"/part-(\d+)[^/]*$", 1)
    return [F.regexp_replace(file, "[^/]*$", "").alias("_folder"), F.when(part != "", part).cast("bigint").alias("_part"), file.alias("_file"),
            F.col(f"{meta}.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")]


def _numbered(df: DataFrame, position: str) -> DataFrame:
    from ..operators.label_encoder import global_position

    return global_position(df, list(PLACE), position).drop(*PLACE)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(_folder, _part, _file, _block, _row, _text)``: the records of CSV files,
    whose fields may hold line ends, header included.

    The lines of a byte range are counted under both assumptions, that the range
    begins outside quotes and that it begins inside; the parity of the quotes of
    all ranges before it (one small row a range) says which holds, and where the
    record begins that its first lines belong to.  No task holds more than a range
    or a record."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("_text"), *_place("_metadata"))
    quotes = F.length("_text") - F.length(F.replace("_text", F.lit('"'), F.lit("")))
    at = ["_folder", "_part", "_file", "_block"]
    w = Window.partitionBy(*at).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("_q", (quotes % 2).cast("int"))
    lines = lines.withColumn("_odd", (F.sum("_q").over(w) - F.col("_q")) % 2)  # quotes of the range before this line
    # written once: the ranges and their lines must come from the very same splits
    lines = materialize(lines.select(*at, "_row", "_text", "_q", "_odd", F.sum(1 - F.col("_odd")).over(w).alias("_n0"), F.sum("_odd").over(w).alias("_n1")),
                        "csv_lines")
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = lines.groupBy("_file", "_block").agg((F.sum("_q") % 2).alias("_q"), F.max("_n0").alias("_n0"), F.max("_n1").alias("_n1"))
    ranges = ranges.withColumn("_in", F.coalesce(F.sum("_q").over(before), F.lit(0)) % 2)
    ends = F.struct(F.col("_block").alias("b"), F.when(F.col("_in") == 0, F.col("_n0")).otherwise(F.col("_n1")).alias("n"))
    ranges = materialize(ranges.select("_file", "_block", "_in", F.last(F.when(ends["n"] > 0, ends), True).over(before).alias("_open")), "csv_ranges")
    from ..operators.joins import join_dim

    d = join_dim(lines, ranges, ["_file", "_block"], "inner", known_rows=ranges.count())
    n = F.when(F.col("_in") == 0, F.col("_n0")).otherwise(F.col("_n1"))
    own = F.struct(F.col("_block").alias("b"), n.alias("n"))
    d = d.withColumn("_rec", F.when(n > 0, own).otherwise(F.col("_open")))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_block", "_row", "_text"))), lambda x: x["_text"]), "\n")
    d = d.groupBy("_folder", "_part", "_file", "_rec").agg(F.regexp_replace(whole, r"\r\z", "").alias("_text"))
    return d.select("_folder", "_part", "_file", F.col("_rec.b").alias("_block"), F.col("_rec.n").alias("_row"), "_text")


def _parsed_records(records: DataFrame, texts: T.StructType) -> DataFrame:
    """Records parsed by Spark's own CSV parser; the first of each file is its header."""
    header = (F.col("_block") == 0) & (F.col("_row") == 1)
    text = F.when(header, F.regexp_replace("_text", "^\ufeff", "")).otherwise(F.col("_text"))
    # written once: the header check and the rows read the same parsed records
    parsed = materialize(records.where(F.col("_text") != "").select(
        *PLACE, header.alias("_header"), F.from_csv(text, texts.simpleString()[7:-1].replace(":", " "), CSV_OPTIONS).alias("_v")), "csv_records")
    names = F.array(*[F.trim(F.col(f"_v.{f}")) for f in texts.names])
    bad = parsed.where(F.col("_header") & ~names.eqNullSafe(F.array(*map(F.lit, texts.names)))).select("_file", names.alias("n")).first()
    if bad:
        raise ValueError(f"header of {bad['_file']} is {bad['n']}, not {texts.names}")
    return parsed.where(~F.col("_header")).select("_v.*", *PLACE)


def read_predictions(spark: SparkSession, path: str, position: str = "row_pos") -> DataFrame:
    """What ``write_predictions`` wrote, each row with its place in the files."""
    d = spark.read.schema(PREDICTION_SCHEMA).options(header=True, enforceSchema=False).csv(path)
    return _numbered(d.select("*", *_place("_metadata")), position)


def write_predictions(df: DataFrame, path: str, single_file: bool = False, order: str | None = None) -> None:
    """``sample_id, price`` with a header, no index; a folder of parts
    unless ``single_file`` (which funnels all rows through one task).  With
    ``order``, rows are in the order of that column, parts in that of their numbers."""
    if single_file:
        df = df.coalesce(1) if order is None else df.repartition(1).sortWithinPartitions(order)
    elif order is not None:
        df = df.orderBy(order)
    out = df.select(F.col("sample_id").cast("bigint"), F.col("price").cast("double"))
    out.write.mode("overwrite").option("header", True).csv(path)


def write_products(df: DataFrame, path: str) -> None:
    """Product rows as header CSV that ``read_products`` reads back unchanged
    (the CSV writer trims surrounding whitespace of values unless told not to)."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def land(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet and read it back: cuts lineage and survives
    executor loss (the files live in a shared folder)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``land`` into a fresh folder under the session's checkpoint folder."""
    return land(df, scratch_path(df.sparkSession, name))
