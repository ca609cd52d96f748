"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Upper and lower case of the ASCII letters (for ``translate``).
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: the optimizer cannot copy
    a lambda's argument into inner lambdas, where it would run per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def row_key(*cols: Column) -> Column:
    """128 bits over the given columns; equal rows share a key, which is
    harmless wherever a row's result depends on these columns alone."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit("fennec"), *reversed(cols)).alias("b"))


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``docs`` with numbered column names, so that no name of the caller's can
    clash with one of the operator's; the new name of each old one; and the
    columns that give the old names back."""
    new = [f"__c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*new), dict(zip(docs.columns, new)), [F.col(n).alias(c) for n, c in zip(new, docs.columns)]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back:
    cuts the lineage, survives lost executors and runs the plan once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
