"""Image manifest and fetch.

S8a manifest: links that are strings, file name = last non-empty path part of
the URL (query and fragment kept, as a path basename keeps them), one link per
file name, anti-joined with the files that already exist.
S8b fetch: ``mapInPandas`` over the manifest; each task fetches its rows with
a caller-supplied function and reports ``(image_link, filename, status,
error)``.  Failures are reported, never raised; files appear atomically
(fetched under a unique name, then renamed), so retried or speculative tasks
are safe.  The destination must be a folder every executor can write (a
shared mount on a cluster).
"""

from __future__ import annotations

import os
import urllib.request
import uuid
from typing import Callable

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASENAME = r"([^/]+)/*$"


def file_name(url):
    return F.regexp_extract(url, BASENAME, 1)


def manifest(links: DataFrame, link_col: str = "image_link", existing: DataFrame | None = None) -> DataFrame:
    """``(image_link, filename, exists)``, one row per distinct file name
    (the smallest link wins, for determinism)."""
    m = (
        links.where(F.col(link_col).isNotNull())
        .select(F.col(link_col).alias("image_link"), file_name(F.col(link_col)).alias("filename"))
        .groupBy("filename")
        .agg(F.min("image_link").alias("image_link"))
    )
    if existing is None:
        return m.select("image_link", "filename", F.lit(False).alias("exists"))
    ex = existing.select(F.col("filename").alias("_f")).distinct().withColumn("_e", F.lit(True))
    return (
        m.join(ex, m.filename == ex._f, "left")
        .select("image_link", "filename", F.coalesce(F.col("_e"), F.lit(False)).alias("exists"))
    )


def to_fetch(links: DataFrame, link_col: str = "image_link", existing: DataFrame | None = None) -> DataFrame:
    """The manifest rows whose file does not exist yet (left anti join)."""
    m = manifest(links, link_col, None).drop("exists")
    if existing is None:
        return m
    return m.join(existing.select("filename"), "filename", "left_anti")


def existing_files(spark: SparkSession, folder: str) -> DataFrame:
    """File names already in ``folder`` (binaryFile listing, names only)."""
    try:
        df = spark.read.format("binaryFile").load(folder).select("path")
    except AnalysisException as ex:
        if ex.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "filename string")
    return df.select(F.regexp_extract("path", BASENAME, 1).alias("filename"))


def _default_fetch(url: str, dest: str) -> None:
    urllib.request.urlretrieve(url, dest)


def fetch(manifest_df: DataFrame, folder: str, fetcher: Callable[[str, str], None] | None = None, partitions: int | None = None) -> DataFrame:
    """Fetch every manifest row into ``folder``; returns the status table."""
    get = fetcher or _default_fetch

    def run(batches):
        os.makedirs(folder, exist_ok=True)
        for pdf in batches:
            status, error = [], []
            for link, name in zip(pdf["image_link"], pdf["filename"]):
                dest = os.path.join(folder, name)
                if os.path.exists(dest):
                    status.append("exists")
                    error.append(None)
                    continue
                # fetch into a task-unique name, then rename: a task lost half-way
                # never leaves a partial file that a retry would take as done
                part = f"{dest}.part-{uuid.uuid4().hex}"
                try:
                    get(link, part)
                    os.replace(part, dest)
                    status.append("ok")
                    error.append(None)
                except Exception as ex:  # noqa: BLE001 - reported per row, like a warning
                    if os.path.exists(part):
                        os.remove(part)
                    status.append("failed")
                    error.append(str(ex))
            yield pd.DataFrame({"image_link": pdf["image_link"], "filename": pdf["filename"], "status": status, "error": error})

    src = manifest_df.select("image_link", "filename")
    if partitions:
        src = src.repartition(partitions, "filename")
    return src.mapInPandas(run, "image_link string, filename string, status string, error string")
