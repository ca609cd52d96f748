"""A corpus pipeline of five training-data operators.

Each stage takes all documents its predecessor kept (written as Parquet and
read again) and returns a DataFrame; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fennec.llm import crf_language, line_chunks, lsh_forest, nbest, winnowing
from fennec.session import scratch_path
from fennec.sources.tables import table

#: A document whose best language has a smaller share of its words is rejected.
MIN_LANGUAGE_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one language: those without letters, and those in which no
    language has half of the words, go."""
    model = crf_language.train(docs)
    found = crf_language.identify(docs, model, keep=docs.columns, out=("__lang", "__share"))
    return found.where((F.col("__lang") != crf_language.UNDETERMINED) & (F.col("__share") >= MIN_LANGUAGE_SHARE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines leave the texts.  A document all of whose text is removed, a copy
    of others' lines, goes; all others stay, null and blank texts as they are."""
    found = line_chunks.dedup_lines(docs).where((F.col("__removed") == 0) | F.col("text").rlike(r"\S"))
    return found.withColumn("n_chars", F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one of least id (null
    first); of repeated rows one stays.  Texts without words are similar to nothing and stay."""
    return lsh_forest.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go; null and empty texts have none and stay."""
    return winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ``N_BEST`` best segmentations of every text: ``doc_id``, ``lang``, of the best
    one ``n_pieces``, ``score`` and ``ids``, and whether these decode to the text
    (``round_trip``); of all, by rank, ``scores`` and ``ids_crc32``.  Null and empty
    texts have no pieces; every document stays."""
    found = nbest.digests(docs, nbest.N_BEST, keep=["lang"], with_ids=True)
    return found.select("doc_id", "lang", F.col("n_pieces")[0].alias("n_pieces"), F.col("scores")[0].alias("score"), "ids",
                        "round_trip", "n_found", "scores", "ids_crc32")


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL has neither the field's marginals nor the lattice; tests compare the stages with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
