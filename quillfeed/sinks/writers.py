"""Sinks (SNK1-10): JSON feeds per locale, lookup/list files, snapshot publishing.

Writes go through Spark's commit protocol (task output is committed
atomically per job). SNK2's "write a temp file then copy over the final one"
becomes: write a new snapshot directory, then point readers at it by writing
a small ``_CURRENT`` marker; the directory being read is never overwritten.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillfeed.functions.timeparse import format_utc
from quillfeed.operators.windows import group_row_number


def json_safe(df: DataFrame) -> DataFrame:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss`` (PRJ14) and non-finite doubles as
    NULL (T9: 2**k overflow is written as null)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = format_utc(c)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_locale_feeds(feed: DataFrame, path: str, order=("pos_ts", "pos_ord")) -> None:
    """SNK1 + SNK10: one JSON-lines feed per locale (``locale=xx/`` folders), in
    feed order. Range-partitioned by (locale, position) so each locale's order
    survives in its part files; every locale is written by the same job."""
    ordered = feed.repartitionByRange(F.col("locale"), F.col(order[0]).desc(), F.col(order[1])) \
        .sortWithinPartitions("locale", F.col(order[0]).desc(), F.col(order[1]))
    json_safe(ordered).write.mode("overwrite").partitionBy("locale").json(path)


def write_sorted_json(df: DataFrame, path: str, sort_cols, cols=None) -> None:
    """SNK3/SNK5/SNK6/SNK7/SNK8/SNK9: include-list projection, sorted, JSON lines."""
    out = df.select(*cols) if cols else df
    json_safe(out.orderBy(*sort_cols)).write.mode("overwrite").json(path)


def publish_snapshot(df: DataFrame, base: str, fmt: str = "parquet", stamp: str | None = None) -> str:
    """SNK2: write ``base/snap=<stamp>`` then record it in ``base/_CURRENT``.

    Readers resolve the current snapshot through ``read_current``; the old
    snapshot stays readable until it is cleaned up by retention."""
    stamp = stamp or _dt.datetime.utcnow().strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    target = f"{base.rstrip('/')}/snap={stamp}"
    df.write.mode("errorifexists").format(fmt).save(target)
    point_to(df.sparkSession, base, target)
    return target


def publish_locale_feeds(feed: DataFrame, base: str, stamp: str, order=("pos_ts", "pos_ord")) -> str:
    """SNK1 + SNK2 + SNK10: every locale's ordered feed as the snapshot ``stamp``, then the pointer."""
    target = f"{base.rstrip('/')}/snap={stamp}"
    write_locale_feeds(feed, target, order)
    point_to(feed.sparkSession, base, target)
    return target


def point_to(spark, base: str, target: str) -> None:
    """Make ``target`` the current snapshot of ``base``: one small file, put in place by its name."""
    pointer = f"{base.rstrip('/')}/_CURRENT"
    spark.createDataFrame([(target,)], "path string").coalesce(1).write.mode("overwrite").text(pointer)


def read_lines(spark, path: str) -> DataFrame:
    """The lines of a published JSON-lines folder with their ``line`` number from 0, in
    the order of the part files, per locale where there are locale folders. Files are
    numbered in ranges, so a locale of any size is read by many tasks."""
    rows = spark.read.option("basePath", path).text(path)
    keys = ["locale"] if "locale" in rows.columns else []
    if not keys:
        rows = rows.withColumn("locale", F.lit(""))
    rows = rows.withColumn("_file", F.col("_metadata.file_name")).withColumn("_start", F.col("_metadata.file_block_start"))
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    out = group_row_number(rows, ["locale"], ["_file", "_start", "_at"], out="line").withColumn("line", F.col("line") - 1)
    return out.select(*keys, "line", "value")


def read_current(spark, base: str, fmt: str = "parquet") -> DataFrame:
    """Read the snapshot ``_CURRENT`` points to."""
    target = spark.read.text(f"{base.rstrip('/')}/_CURRENT").first()[0]
    return spark.read.format(fmt).load(target)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, mode: str = "overwrite") -> DataFrame:
    """Save a store table bucketed (and sorted) by its key, e.g. the article
    table by ``article_key``. Joins between tables bucketed the same way on the
    key - the upsert's full outer join, the known/new split - then read
    matching buckets side by side instead of shuffling the large table each
    run. Returns the catalog table."""
    df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)
