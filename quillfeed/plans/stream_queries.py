"""Registered queries of the streaming operators (STR3-6, SET7, SET11, FLT8, FLT14).

Each query deals a driver table into parts in the shared folder, one after the
other, and runs a stream that reads one part a batch, so that batches, watermarks
and replays behave as they do in a series of scheduled runs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions.timeparse import format_utc
from quillfeed.functions.urls import url_hash
from quillfeed.operators import store as ST
from quillfeed.plans import standins as S
from quillfeed.plans.registry import register
from quillfeed.sources.tables import read_table
from quillfeed.streaming import incremental as STRM
from quillfeed.streaming import keyed_store


def _write_files(part: DataFrame, folder: str, files: int) -> None:
    """``part`` as exactly ``files`` files, written by as many tasks. A task without
    rows writes none; copies of a file without rows stand for those."""
    spark = part.sparkSession
    part.repartition(files, *part.columns).write.option("maxRecordsPerFile", 0).parquet(folder)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")
    fs = pattern.getFileSystem(conf)
    written = {f.getPath().getName() for f in fs.globStatus(pattern)}
    if len(written) < files:
        part.limit(0).coalesce(1).write.mode("append").parquet(folder)
        [empty] = [f.getPath() for f in fs.globStatus(pattern) if f.getPath().getName() not in written]
        for k in range(files - len(written) - 1):
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, empty, fs, jvm.org.apache.hadoop.fs.Path(f"{folder}/part-empty-{k:05d}.parquet"), False, conf)


def dealt_stream(parts: list[DataFrame], path: str) -> DataFrame:
    """The ``parts`` as a stream that reads one of them a batch, in their order. Each
    is written as the same number of files, that of the shuffle partitions, and a
    batch takes so many: no task holds a whole part."""
    spark = parts[0].sparkSession
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for k, part in enumerate(parts):
        _write_files(part, f"{path}/part={k:03d}", files)
    schema = spark.read.parquet(f"{path}/part=000").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{path}/part=*")


# --- STR3 + SET7: upsert of three batches onto a filled store ------------------------
UPSERT_CUTS = ("1998-03-01", "1998-06-01")  # incoming orders before, between and after are batches 0, 1, 2
UPSERT_AS_OF = _dt.datetime(2002, 1, 1)  # batch b runs b days later
STORE_AS_OF = _dt.datetime(1998, 1, 1)
BUCKETS = 16

STREAM_UPSERT_SQL = f"""
WITH k AS (SELECT *, sha256(url) || sha256(trim(title)) AS article_key,
                  CASE WHEN stored THEN -1 WHEN publish_time < TIMESTAMP '{UPSERT_CUTS[0]}' THEN 0
                       WHEN publish_time < TIMESTAMP '{UPSERT_CUTS[1]}' THEN 1 ELSE 2 END AS batch
           FROM ({S.ORDER_ARTICLES_SQL})),
b AS (SELECT article_key, batch, arg_max(title, ord) AS title, arg_max(publish_time, ord) AS publish_time, arg_max(img, ord) AS img,
             arg_max(description, ord) AS description, arg_max(pop_score, ord) AS pop_score, arg_max(feed_id, ord) AS feed_id
      FROM k GROUP BY article_key, batch)
SELECT article_key, arg_max(title, batch) AS title, strftime(arg_max(publish_time, batch), '%Y-%m-%d %H:%M:%S') AS publish_time,
       coalesce(arg_max(img, batch) FILTER (img <> ''), '') AS img, arg_max(description, batch) AS description,
       round(arg_max(pop_score, batch), 6) AS pop_score, any_value(feed_id) AS feed_id,
       CASE WHEN min(batch) < 0 THEN '1998-01-01 00:00:00' ELSE '2002-01-0' || CAST(min(batch) + 1 AS VARCHAR) || ' 00:00:00' END AS created,
       CASE WHEN max(batch) < 0 THEN '1998-01-01 00:00:00' ELSE '2002-01-0' || CAST(max(batch) + 1 AS VARCHAR) || ' 00:00:00' END AS modified
FROM b GROUP BY article_key"""


def _keyed_orders(spark: SparkSession, base: str, incoming: bool) -> DataFrame:
    a = S.order_articles(spark, base, incoming=incoming)
    return ST.with_article_key(a.withColumn("url_hash", url_hash(F.col("url"))).withColumn("padded_img", F.col("img")))


@register("stream_article_upsert", STREAM_UPSERT_SQL)
def stream_article_upsert(spark: SparkSession, base: str) -> DataFrame:
    """Orders before 1998 fill the keyed article table; later ones arrive in three
    batches. Each rewrites only the buckets its keys fall into; then the last batch
    is sent again, which changes nothing."""
    feeds = S.customer_feeds(spark, base)
    out = STRM.shared_dir(spark, "upsert")
    stored = ST.upsert_articles(None, _keyed_orders(spark, base, incoming=False), feeds, STORE_AS_OF)
    keyed_store.create(stored, f"{out}/table", ["article_key"], BUCKETS)
    late = _keyed_orders(spark, base, incoming=True)
    cuts = [F.lit(c).cast("timestamp_ntz") for c in UPSERT_CUTS]
    ts = F.col("publish_time")
    parts = [late.where(ts < cuts[0]), late.where((ts >= cuts[0]) & (ts < cuts[1])), late.where(ts >= cuts[1])]
    stream = dealt_stream(parts, f"{out}/drop")

    def as_of(batch: int) -> _dt.datetime:
        return UPSERT_AS_OF + _dt.timedelta(days=batch)

    STRM.upsert_batches(stream, f"{out}/table", feeds, as_of, f"{out}/ckpt", buckets=BUCKETS).awaitTermination()
    again = spark.read.schema(stream.schema).parquet(f"{out}/drop/part=002")
    keyed_store.merge_batch(again, f"{out}/table", "articles", 2, lambda old, new: ST.upsert_articles(old, new, feeds, as_of(9)))
    t = keyed_store.read(spark, f"{out}/table")
    return t.select("article_key", "title", format_utc(F.col("publish_time")).alias("publish_time"), "img", "description",
                    F.round("pop_score", 6).alias("pop_score"), "feed_id",
                    format_utc(F.col("created")).alias("created"), format_utc(F.col("modified")).alias("modified"))


# --- STR6 + FLT8 + FLT14: file drop with dead letters ---------------------------------
LIMIT = 4_000  # bytes of a document in this query
DEAD_LETTERS_SQL = """
SELECT event_id AS doc_ord, 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/rss' AS feed_url,
       CASE event_type WHEN 'click' THEN 'unparsable' WHEN 'purchase' THEN 'oversize' WHEN 'signup' THEN 'empty'
                       WHEN 'error' THEN 'no_entries' ELSE 'entries' END AS outcome,
       CASE WHEN event_type IN ('click', 'purchase', 'signup', 'error') THEN 0 ELSE 1 END AS n_entries
FROM events"""


def faulty_documents(spark: SparkSession, base: str) -> DataFrame:
    """``feed_documents`` with one fault per event type: cut off in the middle, far
    too long, blank, or without its item. A feed has good and bad documents."""
    e = read_table(spark, base, "events").select(F.col("event_id").alias("doc_ord"), "event_type")
    d = S.feed_documents(spark, base).join(e, "doc_ord")
    c, kind = F.col("content"), F.col("event_type")
    content = (F.when(kind == "click", F.expr("left(content, length(content) - 20)"))
               .when(kind == "purchase", F.concat(c, F.lit("<!--"), F.repeat(F.lit("x"), LIMIT), F.lit("-->")))
               .when(kind == "signup", F.lit(" \n"))
               .when(kind == "error", F.regexp_replace("content", r"(?s)<item>.*</item>", "")).otherwise(c))
    return d.select("doc_ord", "feed_url", content.alias("content"))


@register("dead_letters", DEAD_LETTERS_SQL)
def dead_letters(spark: SparkSession, base: str) -> DataFrame:
    """Feed documents in three parts streamed into entries and dead letters; every
    document is in exactly one of the two, a bad one with its own kind."""
    out = STRM.shared_dir(spark, "drop")
    docs = faulty_documents(spark, base)
    stream = dealt_stream([docs.where(F.col("doc_ord") % 3 == k) for k in range(3)], f"{out}/drop")
    STRM.ingest_documents(stream, f"{out}/entries", f"{out}/failures", f"{out}/ckpt", max_bytes=LIMIT)
    entries, failures = (spark.read.parquet(f"{out}/{x}") for x in ("entries", "failures"))
    good = entries.groupBy(F.shiftright("ord", 20).alias("doc_ord"), "feed_url").agg(F.count(F.lit(1)).cast("int").alias("n_entries"))
    return good.select("doc_ord", "feed_url", F.lit("entries").alias("outcome"), "n_entries").unionByName(
        failures.select("doc_ord", "feed_url", F.col("kind").alias("outcome"), F.lit(0).alias("n_entries")))


# --- STR5: daily windows ------------------------------------------------------------
STREAM_DAILY_SQL = """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
FROM events GROUP BY ALL"""


@register("stream_daily_counts", STREAM_DAILY_SQL)
def stream_daily_counts(spark: SparkSession, base: str) -> DataFrame:
    """UTC-day windows per event type in update mode: changed windows are merged by
    key into a table, and closed ones leave the state by the watermark. The events
    arrive in three parts by time."""
    out = STRM.shared_dir(spark, "daily")
    e = read_table(spark, base, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    day = F.dayofmonth("ts")
    stream = dealt_stream([e.where(day <= 10), e.where((day > 10) & (day <= 20)), e.where(day > 20)], f"{out}/drop")
    counts = STRM.daily_counts(stream, "ts", ["event_type"])
    counts = counts.select(F.col("window.start").alias("window_start"), "event_type", "n")
    STRM.update_keyed(counts, f"{out}/table", ["window_start", "event_type"], f"{out}/ckpt", buckets=4)
    t = keyed_store.read(spark, f"{out}/table")
    return t.select(format_utc(F.col("window_start")).alias("window_start"), "event_type", "n")


# --- STR4 + SET11: high-water mark ----------------------------------------------------
RUNS = ("2024-02-03 00:00:00", "2024-02-01 00:00:00", "2024-02-02 00:00:00")  # batch k holds event_id % 3 = k
STREAM_HIGH_WATER_SQL = f"""
WITH e AS (SELECT user_id AS feed_id, ts, CASE event_id % 3 WHEN 0 THEN TIMESTAMP '{RUNS[0]}' WHEN 1 THEN TIMESTAMP '{RUNS[1]}'
                  ELSE TIMESTAMP '{RUNS[2]}' END AS run_at FROM events),
m AS (SELECT feed_id, max(ts) AS t FROM e GROUP BY feed_id)
SELECT m.feed_id, strftime(m.t, '%Y-%m-%d %H:%M:%S') AS last_build_time,
       round((epoch_us(min(run_at)) - epoch_us(m.t)) / 1e6, 3) AS last_build_timedelta
FROM m JOIN e ON e.feed_id = m.feed_id AND e.ts = m.t GROUP BY m.feed_id, m.t"""


@register("stream_high_water", STREAM_HIGH_WATER_SQL)
def stream_high_water(spark: SparkSession, base: str) -> DataFrame:
    """The largest build time per feed and its lag as keyed state, from batches that
    do not come in the order of time: older builds change nothing."""
    out = STRM.shared_dir(spark, "water")
    e = read_table(spark, base, "events").select(F.col("user_id").alias("feed_id"), F.col("ts").cast("timestamp").alias("last_build_time"), "event_id")
    parts = [e.where(F.col("event_id") % 3 == k).withColumn("run_at", F.lit(RUNS[k]).cast("timestamp")) for k in range(3)]
    marks = STRM.feed_high_water_stream(dealt_stream(parts, f"{out}/drop"), run="run_at")
    STRM.update_keyed(marks, f"{out}/table", ["feed_id"], f"{out}/ckpt", buckets=4)
    t = keyed_store.read(spark, f"{out}/table")
    return t.select("feed_id", format_utc(F.col("last_build_time")).alias("last_build_time"),
                    F.round("last_build_timedelta", 3).alias("last_build_timedelta"))
