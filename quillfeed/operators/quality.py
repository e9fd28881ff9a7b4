"""Run reports, report checks, freshness and error counters (AGG6-8, AGG13, SRC10)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions.scoring import seconds_between, ts_literal
from quillfeed.functions.urls import host_label


def run_report(items: DataFrame, kept: DataFrame | None = None, key: str = "feed_url",
               max_entries_col: str = "max_entries", group_cols: tuple = ()) -> DataFrame:
    """AGG6: per feed ``size_after_get`` (entries parsed) and ``size_after_insert``
    (entries attempted = the first max_entries, counted whether or not they
    survive cleaning, T8); ``size_kept`` (articles kept) when ``kept`` is given."""
    me = F.coalesce(F.col(max_entries_col), F.lit(config.DEFAULT_MAX_ENTRIES)) if max_entries_col in items.columns \
        else F.lit(config.DEFAULT_MAX_ENTRIES)
    keys = [*group_cols, key]
    rep = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("size_after_get"), F.max(me).alias("_me")).select(
        *keys, "size_after_get", F.least(F.col("size_after_get"), F.col("_me").cast("long")).alias("size_after_insert"))
    if kept is not None:
        k = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("size_kept"))
        rep = rep.join(k, keys, "left").withColumn("size_kept", F.coalesce("size_kept", F.lit(0)))
    return rep


def report_violations(report: DataFrame, key: str = "feed_url") -> DataFrame:
    """AGG7: one row per broken rule (empty frame = report passes)."""
    g, i = F.col("size_after_get"), F.col("size_after_insert")
    checks = F.array(
        F.when(i > g, F.lit("inserted more than downloaded")),
        F.when(g == 0, F.lit("no posts downloaded")),
        F.when(i == 0, F.lit("no posts inserted")),
    )
    return report.select(key, "size_after_get", "size_after_insert", F.explode(checks).alias("violation")) \
        .where(F.col("violation").isNotNull())


def report_passes(report: DataFrame) -> bool:
    """Driver-side verdict of AGG7 (one tiny ``limit(1)`` action)."""
    return len(report_violations(report).limit(1).collect()) == 0


def file_freshness(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SRC10: last-modified time of each published file, from the ``binaryFile``
    listing columns (path, modificationTime); the file content is not read."""
    df = spark.read.format("binaryFile").load(paths).select(
        F.col("path").alias("file"), F.col("modificationTime").alias("last_modified"))
    return df


def freshness_status(files: DataFrame, expected: DataFrame, as_of: _dt.datetime,
                     max_age_hours: int = config.FRESHNESS_HOURS, fraction: float = config.FRESHNESS_FRACTION) -> DataFrame:
    """AGG8: every expected file with ``expired`` (age > max_age_hours; a
    missing file counts as modified 24 h ago) and the overall ``status``:
    success when fresh files >= floor(fraction * total)."""
    now = ts_literal(as_of)
    j = expected.select("file").distinct().join(files.select("file", "last_modified"), "file", "left")
    lm = F.coalesce(F.col("last_modified").cast("timestamp"), now - F.expr("INTERVAL 24 HOURS"))
    per_file = j.select("file", (seconds_between(now, lm) > max_age_hours * 3600).alias("expired"))
    counts = per_file.agg(F.count(F.lit(1)).alias("total"), F.count_if("expired").alias("n_expired"))
    total = counts.select("total").scalar()
    n_exp = counts.select("n_expired").scalar()
    status = F.when(F.abs(total - n_exp) >= F.floor(total * F.lit(fraction)), F.lit("success")).otherwise(F.lit("expired"))
    return per_file.withColumn("status", status)


def error_counters(failures: DataFrame, url_col: str = "feed_url", kind_col: str = "kind") -> DataFrame:
    """AGG13: failed downloads / empty feeds per host label and kind."""
    return failures.groupBy(host_label(F.col(url_col)).alias("host_label"), F.col(kind_col).alias("kind")) \
        .agg(F.count(F.lit(1)).alias("n"))

