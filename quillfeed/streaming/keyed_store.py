"""A keyed table on plain parquet that batches are merged into (STR3, SET7).

Rows lie in ``<path>/data/bucket=<k>``, k a hash of the key. A batch reads and
rewrites only the buckets its keys fall into; the rest of the table is neither
read nor written. The steps of one batch:

1. the merged buckets are written to ``<path>/staging/<writer>-<id>``;
2. they replace their buckets (dynamic partition overwrite);
3. ``<path>/commits/<writer>-<id>`` records the batch, and the staging goes.

A batch that is already recorded changes nothing. One that broke off after step 1
is finished from its staging, which holds whole buckets, so a bucket that was lost
half-way through step 2 comes back. One writer at a time merges into a table.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillfeed.session import cut_lineage

BUCKET = "bucket"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.hash(*keys), F.lit(buckets))


def _write(rows: DataFrame, path: str, dynamic: bool = False) -> None:
    w = rows.write.mode("overwrite").partitionBy(BUCKET)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def create(rows: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """A new table of ``rows``, one row per key."""
    spark = rows.sparkSession
    if exists(spark, f"{path}/data"):
        raise ValueError(f"{path} holds a table already")
    _write(rows.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(BUCKET), f"{path}/data")
    layout = spark.createDataFrame([(keys, buckets, rows.schema.json())], "keys array<string>, buckets int, columns string")
    layout.coalesce(1).write.parquet(f"{path}/layout")


def _table(spark: SparkSession, path: str) -> tuple[DataFrame, list[str], int]:
    """The rows with their bucket, the key columns and the number of buckets."""
    layout = spark.read.parquet(f"{path}/layout").first()
    schema = T.StructType.fromJson(json.loads(layout["columns"])).add(BUCKET, T.IntegerType())
    return spark.read.schema(schema).parquet(f"{path}/data"), list(layout["keys"]), layout["buckets"]


def read(spark: SparkSession, path: str) -> DataFrame:
    return _table(spark, path)[0].drop(BUCKET)


def committed(spark: SparkSession, path: str, writer: str, batch_id: int) -> bool:
    return exists(spark, f"{path}/commits/{writer}-{batch_id}/_SUCCESS")


def merge_batch(batch: DataFrame, path: str, writer: str, batch_id: int,
                merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
    """Merge ``batch`` into the table and return the buckets that were rewritten.
    ``merge(current, batch)`` gets the current rows of the batch's buckets and
    returns their next rows; it must not move a row to another key."""
    spark = batch.sparkSession
    if committed(spark, path, writer, batch_id):
        return []
    table, keys, buckets = _table(spark, path)
    staging = f"{path}/staging/{writer}-{batch_id}"
    if not exists(spark, f"{staging}/_SUCCESS"):
        batch = cut_lineage(batch)
        # At most ``buckets`` numbers, however large the batch is.
        touched = [r[0] for r in batch.select(bucket_of(keys, buckets).alias(BUCKET)).distinct().collect()]
        if touched:
            current = table.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
            after = merge(current, batch).withColumn(BUCKET, bucket_of(keys, buckets))
            _write(after.repartition(BUCKET), staging)
        else:
            _write(table.limit(0), staging)
    done = spark.read.schema(table.schema).parquet(staging)
    rewritten = sorted(r[0] for r in done.select(BUCKET).distinct().collect())
    _write(done, f"{path}/data", dynamic=True)
    spark.createDataFrame([(writer, batch_id)], "writer string, batch long").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/commits/{writer}-{batch_id}")
    _remove(spark, staging)
    return rewritten


def replace_by_key(keys: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A merge in which the batch's rows replace those with the same key."""

    def merge(current: DataFrame, batch: DataFrame) -> DataFrame:
        kept = current.join(batch.select(*keys), keys, "left_anti")
        return kept.unionByName(batch.select(*kept.columns))

    return merge
