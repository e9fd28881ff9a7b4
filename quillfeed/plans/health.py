"""Entry 4: feed freshness health check (SRC10 -> AGG8 -> SNK9)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed.operators import quality


def expected_feed_files(spark: SparkSession, locales: list[str]) -> DataFrame:
    """One published file per source list: ``feed.json`` for the default list,
    ``feed.<locale>.json`` for the others."""
    names = [("feed.json" if not loc else f"feed.{loc}.json",) for loc in locales]
    return spark.createDataFrame(names, "file string")


def health_status(spark: SparkSession, published_dir: str, locales: list[str], as_of: _dt.datetime) -> DataFrame:
    """Per expected file ``expired`` plus the overall status (success when at
    least floor(80 %) of the files are fresh); missing files count as 24 h old."""
    files = quality.file_freshness(spark, [published_dir]).withColumn(
        "file", F.regexp_extract("file", r"([^/]+)$", 1))
    return quality.freshness_status(files, expected_feed_files(spark, locales), as_of)


def status_document(status: DataFrame) -> DataFrame:
    """SNK9 shape: one row {status, files: {name: {expired}}}."""
    return status.groupBy("status").agg(
        F.map_from_entries(F.collect_list(F.struct("file", F.struct("expired")))).alias("files"))
