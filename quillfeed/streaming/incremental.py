"""Structured Streaming forms of the incremental steps (STR1-6).

The reference is a batch job re-run on a schedule with state in a database.
Here the same steps run as streams over a file drop (``availableNow`` gives
the scheduled-run behaviour), with Spark's state store keeping what the
database kept. Checkpoints and outputs live under the cluster's shared
``spark.checkpoint.dir`` (never a machine-local folder), so a lost executor
or a restarted driver resumes from the last committed batch.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillfeed import config
from quillfeed.operators import clean, quality, store
from quillfeed.session import cut_lineage, ensure_checkpoint_dir
from quillfeed.sources import feeds
from quillfeed.streaming import keyed_store


BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one stream."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/quillfeed-{name}-{uuid.uuid4().hex[:12]}"


def feed_file_stream(spark: SparkSession, path: str) -> DataFrame:
    """STR6: new feed documents dropped into ``path`` -> (feed_url, length, content).
    A file over the size limit (FLT14) comes without its content, by its listed length.
    Spark's file reader passes over files of no bytes at all; they reach no sink."""
    s = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).load(path)
    return s.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("feed_url"), "length",
                    F.when(F.col("length") <= config.MAX_FEED_BYTES, F.decode("content", "UTF-8")).alias("content"))


def stream_entries(docs: DataFrame) -> DataFrame:
    """SRC4 on a stream (``from_xml`` + ``posexplode`` are stateless)."""
    return feeds.parse_feeds(docs)


def in_window(df: DataFrame, as_of: _dt.datetime, ts: str = "publish_time", content_type: str = "content_type") -> DataFrame:
    """STR2: the late-data rule of FLT6 (60 days back, 1 h ahead, products exempt)."""
    ct = F.col(content_type) if content_type in df.columns else F.lit("article")
    return df.where(clean.in_time_window(F.col(ts), ct, as_of))


def dedup_within_watermark(df: DataFrame, key: str = "article_key", ts: str = "publish_time",
                           delay: str = f"{config.MAX_AGE_DAYS} days") -> DataFrame:
    """STR1: skip articles whose key was already seen; state is kept only as
    long as an article could still pass the time window (the watermark delay)."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def daily_counts(df: DataFrame, ts: str, by: list[str], delay: str = "1 day") -> DataFrame:
    """STR5: tumbling one-day windows (UTC midnight to midnight) per key. In update
    mode (``update_keyed``) a window leaves the state once the watermark passes it."""
    return df.withWatermark(ts, delay).groupBy(F.window(ts, "1 day"), *by).agg(F.count(F.lit(1)).alias("n"))


def feed_high_water_stream(df: DataFrame, feed: str = "feed_id", ts: str = "last_build_time", run: str | None = None) -> DataFrame:
    """STR4 + SET11: the largest build time per feed (update mode). With ``run``, the
    column of a row's run time, the state also keeps the run that brought the
    largest build first, and the lag between them in seconds; builds that are older
    or equal change neither, in whatever order they come."""
    if run is None:
        return df.groupBy(feed).agg(F.max(ts).alias(ts))
    brought = F.struct(F.col(ts).alias("t"), (-F.unix_micros(run)).alias("r"))
    best = df.groupBy(feed).agg(F.max(brought).alias("b"))
    lag = (-F.col("b.r") - F.unix_micros("b.t")) / 1e6
    return best.select(feed, F.col("b.t").alias(ts), lag.alias("last_build_timedelta"))


def upsert_batches(incoming: DataFrame, table_dir: str, feed: DataFrame, as_of, checkpoint: str,
                   trigger_once: bool = True, buckets: int = 16, writer: str = "articles"):
    """STR3: the article upsert (SET7) of every micro-batch into the keyed table at
    ``table_dir``, which is made by the first batch where it is not there yet.

    Only the buckets that a batch touches are read and rewritten, and a batch that
    is replayed changes nothing (``keyed_store``). ``as_of`` is a time, or gives one
    for a batch number. ``writer`` names the stream: its batch numbers are its own."""
    spark = incoming.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        now = as_of(batch_id) if callable(as_of) else as_of
        if not keyed_store.exists(spark, f"{table_dir}/layout"):
            empty = store.upsert_articles(None, batch.limit(0), feed, now)
            keyed_store.create(empty, table_dir, ["article_key"], buckets)
        keyed_store.merge_batch(batch, table_dir, writer, batch_id, lambda old, new: store.upsert_articles(old, new, feed, now))

    w = incoming.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()


def update_keyed(changes: DataFrame, table_dir: str, keys: list[str], checkpoint: str, buckets: int = 16,
                 writer: str = "changes"):
    """The changed rows of an aggregation in update mode, merged by key into the
    keyed table at ``table_dir``. The state store keeps only what the watermark
    still lets change; closed windows live in the table. Returns the ended query."""
    spark = changes.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not keyed_store.exists(spark, f"{table_dir}/layout"):
            keyed_store.create(batch.limit(0), table_dir, keys, buckets)
        keyed_store.merge_batch(batch, table_dir, writer, batch_id, keyed_store.replace_by_key(keys))

    query = changes.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest_documents(docs: DataFrame, entries_dir: str, failures_dir: str, checkpoint: str,
                     max_bytes: int = config.MAX_FEED_BYTES) -> None:
    """STR6: one stream of feed documents into two sinks. Each batch is parsed once;
    its entries go to ``entries_dir`` and its documents without any (FLT8, FLT14) to
    the dead letters in ``failures_dir``, each with its kind. A batch writes folders
    of its own number, so a replayed batch replaces what it wrote."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        parsed = cut_lineage(feeds.parse_documents(batch, max_bytes))
        feeds.entries_of(parsed).write.mode("overwrite").parquet(f"{entries_dir}/batch={batch_id}")
        feeds.failures_of(parsed).write.mode("overwrite").parquet(f"{failures_dir}/batch={batch_id}")

    query = docs.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_to_parquet(df: DataFrame, out_dir: str, checkpoint: str, mode: str = "append", keys: list[str] | None = None) -> None:
    """Drive a stream to completion (``availableNow``) into parquet via
    ``foreachBatch``. append: each batch is a folder ``batch=<id>`` of its own. complete: each batch is the
    whole result. update: each batch holds only changed rows, merged by
    ``keys`` into the previous result (anti join + union) as ``v=<batch_id>``.
    A re-run of a failed batch rewrites its own folder (idempotent)."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if mode == "append":
            batch.write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")
            return
        nxt = batch
        if mode == "update" and batch_id > 0:
            prev = spark.read.parquet(f"{out_dir}/v={batch_id - 1}")
            nxt = prev.join(batch.select(*keys), keys, "left_anti").unionByName(batch)
        nxt.write.mode("overwrite").parquet(f"{out_dir}/v={batch_id}")
        spark.createDataFrame([(f"{out_dir}/v={batch_id}",)], "p string") \
            .coalesce(1).write.mode("overwrite").text(f"{out_dir}/_LATEST")

    if mode == "update" and not keys:
        raise ValueError("update mode needs the key columns")
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(out_dir)
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).mkdirs(folder)  # a run without batches is an empty result
    q = df.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()


def read_result(spark: SparkSession, out_dir: str, mode: str, schema: T.StructType | None = None) -> DataFrame:
    if mode == "append":
        found = spark.read.schema(schema) if schema is not None else spark.read
        df = found.parquet(out_dir)  # a missing folder is an error, not an empty result
        return df.drop("batch")
    latest = spark.read.text(f"{out_dir}/_LATEST").first()[0]
    return spark.read.parquet(latest)
