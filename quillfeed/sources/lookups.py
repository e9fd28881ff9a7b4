"""JSON lookups (SRC5, SRC6, SRC11) and the size-checked broadcast helper.

Lookup files are JSON objects keyed by a string (feed URL, domain). They are
read with ``from_json`` into a map and exploded to rows, so downstream they are
ordinary join sides.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def read_json_map(spark: SparkSession, path: str, value_type: T.DataType, key_name: str = "key") -> DataFrame:
    """Read one JSON object file ``{key: value, ...}`` as rows (key_name, value fields).

    The whole file is one record (``wholetext``); ``from_json`` parses it into a
    map which ``explode`` turns into rows. Missing file -> empty frame."""
    schema = T.StructType([T.StructField(key_name, T.StringType())] + (
        list(value_type.fields) if isinstance(value_type, T.StructType) else [T.StructField("value", value_type)]
    ))
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    raw = spark.read.option("wholetext", "true").text(path)
    m = raw.select(F.from_json("value", T.MapType(T.StringType(), value_type)).alias("m"))
    rows = m.select(F.explode("m").alias(key_name, "_v"))
    if isinstance(value_type, T.StructType):
        return rows.select(key_name, *[F.col(f"_v.{f.name}").alias(f.name) for f in value_type.fields])
    return rows.select(key_name, F.col("_v").alias("value"))


def _exists(spark: SparkSession, path: str) -> bool:
    if "://" not in path:
        return os.path.exists(path)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


FEED_SOURCE_VALUE = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("default", T.BooleanType()),
    T.StructField("publisher_name", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("publisher_domain", T.StringType()),
    T.StructField("publisher_id", T.StringType()),
    T.StructField("max_entries", T.IntegerType()),
    T.StructField("og_images", T.BooleanType()),
    T.StructField("feed_url", T.StringType()),
    T.StructField("site_url", T.StringType()),
    T.StructField("creative_instance_id", T.StringType()),
    T.StructField("destination_domains", T.StringType()),
    T.StructField("channels", T.ArrayType(T.StringType())),
])

COVER_VALUE = T.StructType([
    T.StructField("cover_url", T.StringType()),
    T.StructField("background_color", T.StringType()),
])

REPORT_VALUE = T.StructType([
    T.StructField("size_after_get", T.LongType()),
    T.StructField("size_after_insert", T.LongType()),
])


def read_feed_sources(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: feed_url -> publisher record."""
    return read_json_map(spark, path, FEED_SOURCE_VALUE, key_name="feed_key")


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def read_favicons(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: domain -> favicon_url; empty frame when the file is missing. A folder is
    read as JSON lines, one row per domain (as SNK7 writes them), by many tasks."""
    if _is_folder(spark, path):
        return spark.read.schema("domain string, favicon_url string").json(path)
    return read_json_map(spark, path, T.StringType(), key_name="domain").withColumnRenamed("value", "favicon_url")


def read_covers(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: domain -> {cover_url, background_color}; empty when missing; a folder is
    read as JSON lines."""
    if _is_folder(spark, path):
        return spark.read.schema(T.StructType([T.StructField("domain", T.StringType()), *COVER_VALUE.fields])).json(path)
    return read_json_map(spark, path, COVER_VALUE, key_name="domain")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """SRC11: run report ``{"feed_stats": {feed: {size_after_get, size_after_insert}}}``."""
    schema = T.StructType([T.StructField("feed_stats", T.MapType(T.StringType(), REPORT_VALUE))])
    raw = spark.read.option("wholetext", "true").text(path)
    parsed = raw.select(F.from_json("value", schema).alias("r"))
    rows = parsed.select(F.explode("r.feed_stats").alias("feed", "s"))
    return rows.select("feed", "s.size_after_get", "s.size_after_insert")


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """SRC7: one category path per line, trimmed, blank lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where(F.col("value") != "")
